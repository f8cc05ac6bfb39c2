"""Nearest value on a coordinate axis.

Nearness is taken per axis, and a tie goes to the lower value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import settle

# Longest axis handled with a broadcast lookup; longer ones are sorted instead.
AXIS_ROWS = 65_536

VALUE = "axis_value"


def axis_values(df: DataFrame, dim: str) -> DataFrame:
    """Distinct values of one numeric dimension, as doubles without gaps."""
    value = F.col(dim).cast("double")
    return df.select(value.alias(VALUE)).where(F.col(VALUE).isNotNull() & ~F.isnan(VALUE)).distinct()


def nearest_value(df: DataFrame, dim: str, target: float, tolerance: float | None = None) -> Column:
    """Scalar subquery: the axis value nearest to ``target``, or NULL.

    Two running extremes, one from each side, so the axis is neither sorted
    nor made distinct; only this column is read.
    """
    value, x = F.col(dim), F.lit(float(target))
    usable = value.isNotNull() & ~F.isnan(value.cast("double"))
    if tolerance is not None:
        usable = usable & (F.abs(value - x) <= F.lit(float(tolerance)))
    sides = df.where(usable).agg(
        F.max(F.when(value <= x, value)).alias("below"),
        F.min(F.when(value >= x, value)).alias("above"),
    )
    below, above = F.col("below"), F.col("above")
    nearest = F.when(above.isNull() | (x - below <= above - x), below).otherwise(above)
    return sides.select(nearest.alias(dim)).scalar()


@dataclass(frozen=True)
class Axis:
    """A settled axis table (one column, distinct values) with its extremes."""

    values: DataFrame
    size: int
    low: float | None
    high: float | None

    @classmethod
    def of(cls, df: DataFrame, dim: str) -> Axis:
        values = settle(axis_values(df, dim))
        size, low, high = values.agg(F.count("*"), F.min(VALUE), F.max(VALUE)).first()
        return cls(values, size, low, high)


def snap(points: DataFrame, column: str, axis: Axis, out: str, axis_rows: int = AXIS_ROWS) -> DataFrame:
    """Add ``out``: the axis value nearest to ``column`` of each point."""
    if axis.size == 0:
        return points.withColumn(out, F.lit(None).cast("double"))
    if axis.size <= axis_rows:
        return _snap_by_lookup(points, column, axis, out)
    return _snap_by_sort(points, column, axis, out)


def _snap_by_lookup(points: DataFrame, column: str, axis: Axis, out: str) -> DataFrame:
    """Binary search in the sorted axis, which every row sees as one array.

    The array is a scalar subquery over a counted-short axis. The steps halve from the highest
    power of two below its length, however unevenly its values lie.
    """
    sorted_axis = axis.values.agg(F.sort_array(F.collect_list(VALUE)).alias("v")).scalar()
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(axis.size.bit_length()))])
    wanted = F.col(column)
    rows = points.withColumn("_axis", sorted_axis)
    at = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get("_axis", at + step - 1) <= wanted, at + step).otherwise(at),
    )
    below, above = F.get("_axis", F.col("_at") - 1), F.get("_axis", F.col("_at"))
    nearest = F.when(above.isNull() | (wanted - below <= above - wanted), below).otherwise(above)
    usable = wanted.isNotNull() & ~F.isnan(wanted)
    return rows.withColumn("_at", F.when(usable, at)).withColumn(out, F.when(usable, nearest)).drop("_axis", "_at")


def _snap_by_sort(points: DataFrame, column: str, axis: Axis, out: str) -> DataFrame:
    """Axis and wanted values in one sorted order, each taking its neighbours.

    Both sides are distinct, so range partitions come out even; the values
    missing at partition edges come from a summary with one row per partition.
    """
    wanted = points.select(F.col(column).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    merged = wanted.distinct().select("v", F.lit(None).cast("double").alias("a")).unionByName(
        axis.values.select(F.col(VALUE).alias("v"), F.col(VALUE).alias("a"))
    )
    # Settled because partition numbers must not change between the two uses.
    ranged = settle(
        merged.repartitionByRange("v").withColumn("part", F.spark_partition_id())
    )
    order = Window.orderBy("part")
    edges = (
        ranged.groupBy("part")
        .agg(F.min("a").alias("least"), F.max("a").alias("most"))
        .select(
            "part",
            F.last("most", True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"),
            F.last("least", True)
            .over(Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1))
            .alias("coming"),
        )
    )
    part = Window.partitionBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sides = (
        ranged.withColumn("below", F.last("a", True).over(part.orderBy("v", F.col("a").asc_nulls_last())))
        .withColumn("above", F.last("a", True).over(part.orderBy(F.desc("v"), F.col("a").asc_nulls_last())))
        .where(F.col("a").isNull())
        .join(F.broadcast(edges), "part")  # one row per partition
    )
    below, above = F.coalesce("below", "carried"), F.coalesce("above", "coming")
    nearest = F.when(
        above.isNull() | (F.col("v") - below <= above - F.col("v")), below
    ).otherwise(above)
    found = sides.select(F.col("v").alias(column), nearest.alias(out))
    return points.join(found, column, "left")
