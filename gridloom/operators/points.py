"""Cells at a list of positions: snap every point to the grid, then equi-join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidSelectionError
from ..plans.nearest import AXIS_ROWS, Axis, snap
from .selection import require_coords

# The only coordinate system, and the default miss tolerance in
# degrees when points must not be snapped.
EPSG_WGS84 = 4326
TOLERANCE = 1e-4

POINT_COLUMNS = ("point_id", "point_latitude", "point_longitude")


def points_table(spark: SparkSession, lats, lons, epsg_crs: int = EPSG_WGS84) -> DataFrame:
    """Point table of two equally long coordinate lists, ids in list order."""
    if not isinstance(lats, (list, tuple)) or not isinstance(lons, (list, tuple)) or len(lats) != len(lons):
        raise InvalidSelectionError("Latitudes and longitudes of points come as two equally long lists.")
    if not lats:
        raise InvalidSelectionError("The list of points is empty.")
    if epsg_crs != EPSG_WGS84:
        raise InvalidSelectionError(f"Coordinates must be in EPSG:{EPSG_WGS84}.")
    schema = T.StructType(
        [
            T.StructField("point_id", T.LongType()),
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
        ]
    )
    rows = [(i, float(lat), float(lon)) for i, (lat, lon) in enumerate(zip(lats, lons))]
    return spark.createDataFrame(rows, schema)


def settled_axis(cells: DataFrame, dim: str, axes: dict[str, DataFrame | Axis] | None = None) -> Axis:
    source = (axes or {}).get(dim, cells)
    return source if isinstance(source, Axis) else Axis.of(source, dim)


def snap_points(
    cells: DataFrame,
    points: DataFrame,
    latitude="latitude",
    longitude="longitude",
    axes: dict[str, DataFrame | Axis] | None = None,
    axis_rows: int = AXIS_ROWS,
) -> DataFrame:
    """One row per point with the nearest latitude and longitude of the grid.

    ``points`` has ``point_id``, ``latitude`` and ``longitude``. The two axes
    are computed once, from ``axes`` where given, else from the cells.
    """
    require_coords(cells, latitude, longitude)
    wanted = points.select(
        "point_id",
        F.col("latitude").cast("double").alias("point_latitude"),
        F.col("longitude").cast("double").alias("point_longitude"),
    )
    lat_axis, lon_axis = (settled_axis(cells, dim, axes) for dim in (latitude, longitude))
    snapped = snap(wanted, "point_latitude", lat_axis, latitude, axis_rows)
    snapped = snap(snapped, "point_longitude", lon_axis, longitude, axis_rows)
    return snapped.select(*POINT_COLUMNS, latitude, longitude)


def _near(latitude: str, longitude: str, tolerance: float | None) -> Column:
    close = F.col(latitude).isNotNull() & F.col(longitude).isNotNull()
    if tolerance is not None:
        limit = F.lit(float(tolerance))
        close = close & (F.abs(F.col(latitude) - F.col("point_latitude")) <= limit)
        close = close & (F.abs(F.col(longitude) - F.col("point_longitude")) <= limit)
    return F.coalesce(close, F.lit(False))


def hits(snapped: DataFrame, latitude="latitude", longitude="longitude", tolerance=None) -> DataFrame:
    """Snapped points that count: all, or those within the tolerance."""
    return snapped.where(_near(latitude, longitude, tolerance))


def misses(snapped: DataFrame, latitude="latitude", longitude="longitude", tolerance=None) -> DataFrame:
    """The other points, as they were asked for."""
    return snapped.where(~_near(latitude, longitude, tolerance)).select(
        "point_id",
        F.col("point_latitude").alias("latitude"),
        F.col("point_longitude").alias("longitude"),
    )


def join_cells(cells: DataFrame, snapped: DataFrame, latitude="latitude", longitude="longitude") -> DataFrame:
    """All cells of every snapped point, by an equi-join on both axes.

    The extremes of the points reach the scan of the cells as values. Few points are broadcast
    by their measured size; a location hot on either side has its partition split.
    """
    near = cells
    for dim in (latitude, longitude):
        low, high = snapped.agg(F.min(dim)).scalar(), snapped.agg(F.max(dim)).scalar()
        near = near.where((F.col(dim) >= low) & (F.col(dim) <= high))
    keys = [latitude, longitude]
    others = [c for c in cells.columns if c not in keys]
    return near.join(snapped, keys).select(*POINT_COLUMNS, *keys, *others)


def points(
    cells: DataFrame,
    wanted: DataFrame,
    snap_to_grid: bool = True,
    tolerance: float = TOLERANCE,
    latitude="latitude",
    longitude="longitude",
    axes=None,
    axis_rows: int = AXIS_ROWS,
) -> DataFrame:
    """Cells of every point: of the nearest grid position however far, or,
    without snapping, only where both axes match within the tolerance.

    Repeated input points stay repeated.
    """
    snapped = snap_points(cells, wanted, latitude, longitude, axes, axis_rows)
    found = hits(snapped, latitude, longitude, None if snap_to_grid else tolerance)
    return join_cells(cells, found, latitude, longitude)


def points_missed(
    cells: DataFrame,
    wanted: DataFrame,
    tolerance: float = TOLERANCE,
    latitude="latitude",
    longitude="longitude",
    axes=None,
    axis_rows: int = AXIS_ROWS,
) -> DataFrame:
    """The points that have no grid position within the tolerance."""
    snapped = snap_points(cells, wanted, latitude, longitude, axes, axis_rows)
    return misses(snapped, latitude, longitude, tolerance)


@dataclass(frozen=True)
class PointCells:
    """Cells at points, kept as what they are made of.

    ``points`` has one row per point with its grid place, ``places`` one per place with the number
    of points on it, and ``cells`` the cells of the places, each once. A million points at one
    place cost its series once, until ``expand`` repeats it for each.
    """

    points: DataFrame
    places: DataFrame
    cells: DataFrame
    keys: tuple[str, str]

    def expand(self) -> DataFrame:
        """A row per point and cell, as ``points`` returns them."""
        others = [c for c in self.cells.columns if c not in self.keys]
        return self.cells.join(self.points, list(self.keys)).select(*POINT_COLUMNS, *self.keys, *others)

    def per_point(self, *aggregates: Column, by: tuple[str, ...] = ()) -> DataFrame:
        """Aggregates of each point's cells (by further columns): made once for each place, then
        joined to its points. Points without cells have no row."""
        made = self.cells.groupBy(*self.keys, *by).agg(*aggregates)
        rest = [c for c in made.columns if c not in self.keys]
        return made.join(self.points, list(self.keys)).select(*POINT_COLUMNS, *self.keys, *rest)

    def totals(self, variable: str, by: tuple[str, ...] = ()) -> DataFrame:
        """Count, sum, mean and extremes of a variable over all points, by columns of the cells.

        A cell counts as often as there are points on its place; no row is repeated for that. NULL
        and NaN are missing.
        """
        value = F.nanvl(F.col(variable).cast("double"), F.lit(None).cast("double"))
        weighed = self.cells.join(self.places, list(self.keys)).withColumn("_v", value).where("_v IS NOT NULL")
        n = F.sum("n_points")
        total = F.sum(F.col("_v") * F.col("n_points"))
        return weighed.groupBy(*by).agg(
            n.alias("n"), total.alias("total"), (total / n).alias("mean"), F.min("_v").alias("lowest"), F.max("_v").alias("highest")
        )


def factorised(cells: DataFrame, snapped: DataFrame, latitude="latitude", longitude="longitude") -> PointCells:
    """Snapped points and the cells of their distinct places."""
    keys = (latitude, longitude)
    # Points are counted where they lie first: a place with most of them is one row from each task.
    places = snapped.groupBy(*keys).agg(F.count("*").alias("n_points"))
    near = cells
    for dim in keys:
        low, high = places.agg(F.min(dim)).scalar(), places.agg(F.max(dim)).scalar()
        near = near.where((F.col(dim) >= low) & (F.col(dim) <= high))
    return PointCells(snapped, places, near.join(places.select(*keys), list(keys), "left_semi"), keys)
