"""Axes, sizes and summary of a cell table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: coordinates shown from each end of an axis.
PREVIEW = 3


def variables(df: DataFrame, dims) -> list[str]:
    """Columns that are not dimensions; read from the schema."""
    return [c for c in df.columns if c not in dims]


def get_variable(df: DataFrame, dims, name: str) -> DataFrame:
    if name not in variables(df, dims):
        raise KeyError(f"No variable named {name}.")
    return df.select(*dims, name)


def axis(df: DataFrame, dim: str) -> DataFrame:
    """Distinct values of one dimension; only that column is read."""
    return df.select(dim).where(F.col(dim).isNotNull()).distinct()


def sizes(df: DataFrame, dims, axes: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row with the length of every axis; known axes spare the cells."""
    axes = axes or {}
    if dims and all(d in axes for d in dims):
        lengths = [axes[d].agg(F.count_distinct(d)).scalar().alias(d) for d in dims]
        return df.sparkSession.range(1).select(*lengths)
    return df.agg(*[F.count_distinct(d).alias(d) for d in dims])


def is_dataset_empty(df: DataFrame, dims) -> bool:
    """No variables at all, or no cells."""
    return not variables(df, dims) or df.isEmpty()


def emptiness(df: DataFrame, dims, keys: list[str], wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` with ``is_empty``: whether the table has no cells with these values
    of ``keys``, and ``is_dataset_empty``: or no variables.

    One grouped existence test for any number of selections: the cells are reduced to their
    distinct keys where they lie, and one join marks the rows. NULL keys name no cells.
    """
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    held = df.select(*(F.col(k).alias(n) for k, n in names.items())).distinct()
    rows = wanted.select(F.struct(*(F.col(f"`{c}`") for c in wanted.columns)).alias("row"), *(F.col(k).alias(n) for k, n in names.items()))
    marked = rows.join(held.withColumn("_here", F.lit(True)), list(names.values()), "left")
    empty = F.col("_here").isNull()
    return marked.select(
        *(F.col("row").getField(c).alias(c) for c in wanted.columns),
        empty.alias("is_empty"),
        (empty | F.lit(not variables(df, dims))).alias("is_dataset_empty"),
    )


def as_text(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        fraction = F.rtrim(F.date_format(column, ".SSSSSS"), F.lit("0"))
        return F.concat(whole, F.when(fraction == ".", "").otherwise(fraction))
    return column.cast("string")


#: Values of an axis that one aggregation may hold as a set. Longer axes, as a sketch tells, are
#: made distinct in tables of their own.
SET_VALUES = 200_000


def short_axes(df: DataFrame, dims) -> set[str]:
    """Dimensions with few enough values, by sketches of all of them in one small job."""
    if not dims:
        return set()
    guess = df.agg(*[F.approx_count_distinct(d, 0.02).alias(d) for d in dims]).first()
    return {d for d in dims if guess[d] <= 0.9 * SET_VALUES}


def _value(df: DataFrame, name: str) -> Column:
    """The present values; minus zero is zero, as it is where values are grouped."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        value = (value + F.lit(0.0)).cast(df.schema[name].dataType)
    return F.when(_present(df, name), value)


@dataclass(frozen=True)
class AxisSummary:
    """Columns that tell an axis' number of values, its extremes and its ends, over one row."""

    size: Column
    low: Column
    high: Column
    first: Column
    last: Column


def _axis_summaries(df: DataFrame, dims, count: int, axes: dict[str, DataFrame] | None) -> tuple[list[Column], dict[str, AxisSummary]]:
    """Aggregates over the cells, and a summary of each dimension in terms of them.

    All short axes come from one aggregation: a task reduces its cells to a set of values for each
    axis, and sets merge, so that no cell is copied per axis and both ends are read off the same set.
    Known and long axes are scalar subqueries on tables of their distinct values.
    """
    known = axes or {}
    short = short_axes(df, [d for d in dims if d not in known])
    aggs, found = [], {}
    for i, dim in enumerate(dims):
        if dim in short:
            aggs.append(F.array_sort(F.collect_set(_value(df, dim))).alias(f"s{i}"))
            values = F.col(f"s{i}")
            n = F.size(values)
            found[dim] = AxisSummary(
                n.cast("long"),
                F.get(values, F.lit(0)),
                F.get(values, n - 1),
                F.slice(values, 1, count),
                F.slice(values, F.greatest(n - count + 1, F.lit(1)), F.lit(count)),
            )
            continue
        table = known.get(dim, df)
        values = table.select(_value(table, dim).alias(dim)).where(F.col(dim).isNotNull()).distinct()
        one = lambda c, rows=values: rows.agg(c).scalar()
        ends = [values.orderBy(o).limit(count) for o in (F.col(dim).asc(), F.col(dim).desc())]
        found[dim] = AxisSummary(
            one(F.count("*")),
            one(F.min(dim)),
            one(F.max(dim)),
            *[F.coalesce(e.agg(F.array_sort(F.collect_list(dim))).scalar(), F.array()) for e in ends],
        )
    return aggs, found


def coord_preview(df: DataFrame, dims, count: int = PREVIEW, axes: dict[str, DataFrame] | None = None) -> DataFrame:
    """The first and last values of every axis, as text, with their positions."""
    aggs, found = _axis_summaries(df, dims, count, axes)
    summary = df.agg(*aggs) if aggs else df.sparkSession.range(1)
    # The ends are settled as columns before they are exploded: a lambda cannot hold a subquery.
    ends = summary.select(
        *[c.alias(f"{side}{i}") for i, d in enumerate(dims) for side, c in (("first", found[d].first), ("last", found[d].last))]
    )
    parts = []
    for i, dim in enumerate(dims):
        for side in ("first", "last"):
            texts = F.transform(F.col(f"{side}{i}"), _as_text_of(df.schema[dim].dataType))
            parts.append(F.transform(texts, _placed(dim, side)))
    rows = ends.select(F.explode(F.concat(*parts)).alias("r"))
    return rows.select("r.dim", "r.side", "r.position", "r.value")


def _as_text_of(dtype: T.DataType):
    return lambda v: as_text(v, dtype)


def _placed(dim: str, side: str):
    return lambda v, i: F.struct(F.lit(dim).alias("dim"), F.lit(side).alias("side"), i.alias("position"), v.alias("value"))


def _present(df: DataFrame, name: str) -> Column:
    here = F.col(name).isNotNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        here = here & ~F.isnan(name)
    return here


def describe_dataset(
    df: DataFrame, dims, preview: bool = False, axes: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One row per dimension and variable: kind, type, size, range, attributes.

    ``size`` counts distinct values of a dimension and present values of a
    variable. Known axes spare the cells; all else comes from a single
    aggregation, after one of sketches. ``preview=True`` adds the axis ends as text.
    """
    names = [*dims, *variables(df, dims)]
    aggs, found = _axis_summaries(df, dims, PREVIEW, axes)
    for i, name in enumerate(names):
        if name not in dims:
            here = _value(df, name)
            aggs += [F.count(here).alias(f"n{i}"), F.min(here).alias(f"a{i}"), F.max(here).alias(f"z{i}")]
    told = []
    for i, name in enumerate(names):
        dtype = df.schema[name].dataType
        one = found.get(name) or AxisSummary(F.col(f"n{i}"), F.col(f"a{i}"), F.col(f"z{i}"), F.array(), F.array())
        told += [
            one.size.alias(f"size{i}"),
            as_text(one.low, dtype).alias(f"low{i}"),
            as_text(one.high, dtype).alias(f"high{i}"),
        ]
        if preview and name in dims:
            told.append(F.concat(one.first, one.last).alias(f"ends{i}"))
    summary = (df.agg(*aggs) if aggs else df.sparkSession.range(1)).select(*told)
    rows = []
    for i, name in enumerate(names):
        attrs = df.schema[name].metadata
        parts = [
            F.lit("dimension" if name in dims else "variable").alias("kind"),
            F.lit(name).alias("name"),
            F.lit(df.schema[name].dataType.simpleString()).alias("dtype"),
            F.col(f"size{i}").alias("size"),
            F.col(f"low{i}").alias("lowest"),
            F.col(f"high{i}").alias("highest"),
            (F.to_json(F.create_map(*_flat(attrs))) if attrs else F.lit("{}")).alias("attrs"),
        ]
        if preview:
            shown = F.lit(None).cast("string")
            if name in dims:
                texts = F.transform(F.array_sort(F.array_distinct(F.col(f"ends{i}"))), _as_text_of(df.schema[name].dataType))
                shown = F.when(F.size(texts) > 0, F.array_join(texts, ", "))
            parts.append(shown.alias("preview"))
        rows.append(F.struct(*parts))
    return summary.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _flat(attrs: dict) -> list[Column]:
    return [F.lit(str(x)) for pair in sorted(attrs.items()) for x in pair]
