"""Variants of one dataset joined into a series without overlaps.

Variants are ordered by priority (none = last, ties keep input order). The
first is taken whole; each further one contributes only what lies strictly
after the last coordinate of those before it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timing import to_comparable

DEFAULT_DIMENSION = "time"


@dataclass(frozen=True)
class VariantCells:
    """Cells of one variant with its place in the concatenation.

    ``axis`` is an optional table of the values of the concatenation dimension,
    from which the variant's end is read instead of from the cells.
    """

    variant: str
    cells: DataFrame
    concat_priority: float | None = None
    concat_dimension: str | None = None
    cid: str | None = None
    axis: DataFrame | None = None


def concat_order(variants: list[VariantCells]) -> list[VariantCells]:
    def rank(v: VariantCells) -> float:
        return float("inf") if v.concat_priority is None else v.concat_priority

    return sorted(variants, key=rank)


def _lowest(dtype: T.DataType) -> Column:
    """Below every value of the axis, so that an empty variant cuts nothing."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.lit(float("-inf")).cast(dtype)
    if isinstance(dtype, T.IntegralType) or isinstance(dtype, T.StringType):
        return F.lit(-(2**63)).cast("long")
    return F.lit("0001-01-01").cast(dtype)


def _axis(df: DataFrame, dim: str) -> Column:
    if dim not in df.columns:
        raise ValueError(f"A variant lacks the column {dim} to join along.")
    return to_comparable(F.col(dim), df.schema[dim].dataType)


def _not_nan(df: DataFrame, dim: str) -> Column:
    """NaN ranks above every number and must not become a cut-off."""
    if isinstance(df.schema[dim].dataType, (T.DoubleType, T.FloatType)):
        return ~F.isnan(dim)
    return F.lit(True)


def concat_variants(variants: list[VariantCells], strict: bool = False) -> DataFrame:
    """One lazy plan for any number of variants.

    Every cut-off is a scalar subquery over the axis column of the preferred
    variants, so it reaches the scan of the variant it trims: files and row
    groups before the cut-off are skipped, and nothing is shuffled or joined.
    """
    if not variants:
        raise ValueError("There are no variants to join.")
    if len(variants) == 1:
        return variants[0].cells
    ordered = concat_order(variants)
    dim = ordered[0].concat_dimension or DEFAULT_DIMENSION
    for v in ordered:
        axis = _axis(v.cells, dim)
        if strict and v.cells.select(axis).isEmpty():
            raise ValueError(f"Variant {v.variant} is empty along {dim}.")
    lowest = _lowest(ordered[0].cells.schema[dim].dataType)
    spark = ordered[0].cells.sparkSession
    kept, last = [ordered[0].cells], None
    for earlier, current in zip(ordered, ordered[1:]):
        known = earlier.cells if earlier.axis is None else earlier.axis
        end = known.where(_not_nan(known, dim)).agg(
            F.coalesce(F.max(_axis(known, dim)), lowest).alias("last")
        )
        # The end of all before is that of the last one and the end before it.
        if last is not None:
            end = spark.range(1).select(F.greatest(last.scalar(), end.scalar()).alias("last"))
        last = end
        cells = current.cells
        axis = _axis(cells, dim)
        kept.append(cells.where((axis > last.scalar()) & _not_nan(cells, dim)))
    return reduce(DataFrame.unionByName, kept)


def concat_keyed(cells: DataFrame, key: str, variants: list[VariantCells], strict: bool = False) -> DataFrame:
    """What ``concat_variants`` gives for variants that one table holds, each under its ``cid``.

    The table is read twice however many variants there are: for their ends, one row each, and for
    the cells, which meet their cut-off in a broadcast table. A content id listed again adds nothing.
    """
    ordered = concat_order(variants)
    dim = ordered[0].concat_dimension or DEFAULT_DIMENSION
    of = cells.where(F.col(key).isin([v.cid for v in ordered]))
    axis, not_nan = _axis(of, dim), _not_nan(of, dim)
    if strict:
        there = {str(r[0]) for r in of.select(key).distinct().collect()}  # the variants of one dataset
        for v in ordered:
            if v.cid not in there:
                raise ValueError(f"Variant {v.variant} is empty along {dim}.")
    first = {v.cid: at for at, v in reversed(list(enumerate(ordered)))}
    places = cells.sparkSession.createDataFrame([(cid, at) for cid, at in first.items()], "_cid string, _at int")
    ends = of.groupBy(F.col(key).alias("_key")).agg(F.max(F.when(not_nan, axis)).alias("_end"))
    end = F.coalesce("_end", _lowest(cells.schema[dim].dataType))
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    cut = places.join(ends, F.col("_cid") == F.col("_key"), "left").select("_cid", "_at", F.max(end).over(before).alias("_last"))
    met = of.join(F.broadcast(cut), F.col(key) == F.col("_cid"))
    return met.where((F.col("_at") == 0) | ((axis > F.col("_last")) & not_nan)).select(*(of[c] for c in of.columns if c != key))


def concat_cutoff(
    tagged: DataFrame,
    variant="variant",
    priority="concat_priority",
    dim=DEFAULT_DIMENSION,
    group: tuple[str, ...] = (),
    order: str | None = None,
) -> DataFrame:
    """Per variant, the last coordinate of all variants preferred to it.

    The window runs over one row per variant of a dataset; the cells are only
    pre-aggregated. ``cutoff`` is NULL for the first variant.
    """
    tie = F.min(order) if order else F.lit(0)
    axis = F.when(_not_nan(tagged, dim), _axis(tagged, dim))
    summary = tagged.groupBy(*group, variant).agg(
        F.min(priority).alias("priority"), tie.alias("tie"), F.max(axis).alias("variant_last")
    )
    return place_variants(summary, group, variant).select(
        *group, variant, "concat_position", "variant_last", "cutoff"
    )


def place_variants(summary: DataFrame, group: tuple[str, ...], *last_tie: str) -> DataFrame:
    """Add ``concat_position`` and ``cutoff`` to one row per variant.

    ``summary`` has the ``group`` columns, ``priority``, ``tie`` and
    ``variant_last``, the last coordinate of the variant.
    """
    place = Window.partitionBy(*group).orderBy(F.col("priority").asc_nulls_last(), "tie", *last_tie)
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(
        "*",
        F.row_number().over(place).alias("concat_position"),
        F.max("variant_last").over(before).alias("cutoff"),
    )


def after_cutoff(cells: DataFrame, dim: str, cutoff: str = "cutoff") -> DataFrame:
    """Cells of a first variant, or strictly after their ``cutoff``."""
    return cells.where(F.col(cutoff).isNull() | (_axis(cells, dim) > F.col(cutoff)))


def variant_ends(cells: DataFrame, key: str, dim: str) -> DataFrame:
    """Last coordinate per ``key``; only these two columns are read."""
    axis = F.when(_not_nan(cells, dim), _axis(cells, dim))
    return cells.groupBy(key).agg(F.max(axis).alias("variant_last"))


def concat_tagged(
    tagged: DataFrame,
    variant="variant",
    priority="concat_priority",
    dim=DEFAULT_DIMENSION,
    group: tuple[str, ...] = (),
    order: str | None = None,
) -> DataFrame:
    """Concatenation of variants kept in one table, for many datasets at once.

    ``group`` names the columns of a dataset. The cut-offs, one row per variant, are
    joined to the cells.
    """
    keys = [*group, variant]
    cutoffs = concat_cutoff(tagged, variant, priority, dim, group, order).select(*keys, F.col("cutoff").alias("_cutoff"))
    return after_cutoff(tagged.join(cutoffs, keys), dim, "_cutoff").select(*tagged.columns)
