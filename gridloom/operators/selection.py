"""Filters on cell tables: point, rectangle, circle and time range.

Every function maps a cell table to a cell table of the same columns. All but
``circle_masked`` are single narrow filters whose bounds reach the Parquet
scan, and they accept streaming tables as well.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidSelectionError
from ..functions.geo import EARTH_RADIUS_KM, haversine_km
from ..functions.timing import epoch_micros, normalize_time_range, within_time
from ..model import TIME_KEYS, YEAR_PARTITION, infer_coord
from ..plans.nearest import nearest_value

# Degrees added around a circle's box so that rounding cannot drop edge cells.
BOX_MARGIN = 1e-6


def require_coords(df: DataFrame, latitude: str, longitude: str) -> None:
    if latitude not in df.columns or longitude not in df.columns:
        raise InvalidSelectionError(
            f"The dataset has no coordinates {latitude} and {longitude}."
        )


def finite(*values: float) -> None:
    if not all(isinstance(v, (int, float)) and math.isfinite(v) for v in values):
        raise InvalidSelectionError("Coordinates of a selection must be finite numbers.")


def point_exact(df, lat, lon, latitude="latitude", longitude="longitude") -> DataFrame:
    require_coords(df, latitude, longitude)
    return df.where((F.col(latitude) == F.lit(float(lat))) & (F.col(longitude) == F.lit(float(lon))))


def point_nearest(
    df, lat, lon, latitude="latitude", longitude="longitude", tolerance=None, axes=None
) -> DataFrame:
    """Cells at the nearest latitude and the nearest longitude.

    ``axes`` maps a dimension to a table of its values, which spares reading
    the coordinate columns of the cells. With ``tolerance`` both axis values
    must lie that close, ends included.
    """
    require_coords(df, latitude, longitude)
    finite(lat, lon)
    axes = axes or {}
    at_lat = nearest_value(axes.get(latitude, df), latitude, lat, tolerance)
    at_lon = nearest_value(axes.get(longitude, df), longitude, lon, tolerance)
    return df.where((F.col(latitude) == at_lat) & (F.col(longitude) == at_lon))


def check_rectangle(df, min_lat, min_lon, max_lat, max_lon, latitude="latitude", longitude="longitude") -> None:
    if not min_lat < max_lat:
        raise InvalidSelectionError(f"South edge {min_lat} must lie below north edge {max_lat}.")
    if not min_lon < max_lon:
        raise InvalidSelectionError(f"West edge {min_lon} must lie below east edge {max_lon}.")
    require_coords(df, latitude, longitude)


def rectangle(
    df, min_lat, min_lon, max_lat, max_lon, latitude="latitude", longitude="longitude"
) -> DataFrame:
    """Cells inside the box, all four sides included."""
    check_rectangle(df, min_lat, min_lon, max_lat, max_lon, latitude, longitude)
    return df.where(
        F.col(latitude).between(float(min_lat), float(max_lat))
        & F.col(longitude).between(float(min_lon), float(max_lon))
    )


# Ranges in degrees an axis must keep to.
LATITUDE_RANGE = (-90, 90)
LONGITUDE_RANGE = (-180, 180)


def check_axis_ranges(df, latitude="latitude", longitude="longitude", axes=None) -> None:
    """Raise unless both axes hold degrees; known axes spare the cells."""
    axes = axes or {}
    for dim, (least, most) in ((latitude, LATITUDE_RANGE), (longitude, LONGITUDE_RANGE)):
        value = F.col(dim).try_cast("double")
        bad = F.count_if(value.isNull() | F.isnan(value))
        count, low, high, unusable = (
            axes.get(dim, df).agg(F.count("*"), F.min(value), F.max(value), bad).first()
        )
        if count == 0:
            raise InvalidSelectionError(f"The {dim} axis must not be empty.")
        if unusable or low < least or high > most:
            raise InvalidSelectionError(
                f"Values of {dim} must be numbers between {least} and {most}; found {low} to {high}."
            )


def circle_box(lat: Column, lon: Column, center_lat: float, center_lon: float, radius_km: float) -> Column:
    """Cheap superset of a circle made of comparisons a scan can evaluate.

    Distances repeat every 360 degrees of longitude, so the box is repeated
    too; positions outside the regular ranges are left to the exact test.
    """
    reach = radius_km / EARTH_RADIUS_KM
    dlat = math.degrees(reach) + BOX_MARGIN
    box = lat.between(center_lat - dlat, center_lat + dlat)
    touches_pole = abs(center_lat) + dlat >= 90
    if not touches_pole and reach < math.pi / 2:
        ratio = math.sin(reach) / math.cos(math.radians(center_lat))
        dlon = math.degrees(math.asin(min(1.0, ratio))) + BOX_MARGIN
        base = math.remainder(center_lon, 360.0)
        images = [
            lon.between(base + turn - dlon, base + turn + dlon) for turn in (-360.0, 0.0, 360.0)
        ]
        box = box & reduce(or_, [*images, lon < F.lit(-360.0), lon > F.lit(360.0)])
    odd_latitude = (lat < F.lit(-90.0)) | (lat > F.lit(90.0))
    return box | odd_latitude if abs(center_lat) <= 90 else F.lit(True)


def circle_zones(center_lat, center_lon, radius_km, latitude="latitude", longitude="longitude") -> list[dict]:
    """The circle's box as alternatives of bounds, for files of which only the extremes are known."""
    if abs(center_lat) > 90:
        return []
    reach = radius_km / EARTH_RADIUS_KM
    dlat = math.degrees(reach) + BOX_MARGIN
    band = (center_lat - dlat, center_lat + dlat)
    odd = [{latitude: (None, math.nextafter(-90.0, -180.0))}, {latitude: (math.nextafter(90.0, 180.0), None)}]
    if abs(center_lat) + dlat >= 90 or reach >= math.pi / 2:
        return [{latitude: band}, *odd]
    dlon = math.degrees(math.asin(min(1.0, math.sin(reach) / math.cos(math.radians(center_lat))))) + BOX_MARGIN
    base = math.remainder(center_lon, 360.0)
    images = [(base + turn - dlon, base + turn + dlon) for turn in (-360.0, 0.0, 360.0)]
    return [*({latitude: band, longitude: i} for i in (*images, (None, -360.0), (360.0, None))), *odd]


# Bands of latitude that a circle is cut into.
BANDS = 64


@dataclass(frozen=True)
class BandCover:
    """Bands of latitude across a circle, lowest first, each with two half widths in degrees.

    Cells no further from the centre's meridian than ``inner`` are in the circle, those
    further than ``outer`` are not; only between the two does a distance decide.
    """

    low: float
    height: float
    inner: tuple[float, ...]
    outer: tuple[float, ...]


def half_width(lat: float, center_lat: float, reach: float) -> float:
    """Degrees of longitude from the centre's meridian to the circle's edge at a latitude (radians);
    -1 where the circle does not come to it, 180 where it goes all round."""
    left = math.sin(reach / 2) ** 2 - math.sin((lat - center_lat) / 2) ** 2
    if left < 0:
        return -1.0
    narrow = math.cos(lat) * math.cos(center_lat)
    if left >= narrow:
        return 180.0
    return math.degrees(2 * math.asin(math.sqrt(left / narrow)))


def band_cover(center_lat: float, radius_km: float, bands: int = BANDS) -> BandCover | None:
    """None where the widths do not rise to one peak and fall again: then all distances decide."""
    reach = radius_km / EARTH_RADIUS_KM
    if abs(center_lat) > 90 or reach >= math.pi / 2:
        return None
    margin = math.degrees(reach) + BOX_MARGIN
    low, high = max(-90.0, center_lat - margin), min(90.0, center_lat + margin)
    height = (high - low) / bands
    center = math.radians(center_lat)
    peak_sine = math.sin(center) / math.cos(reach)
    peak = math.asin(peak_sine) if abs(peak_sine) <= 1 else None
    inner, outer = [], []
    for k in range(bands):
        # A little more than the band, as rounding may put a cell into the one beside it.
        edges = [math.radians(max(-90.0, low + k * height - BOX_MARGIN)), math.radians(min(90.0, low + (k + 1) * height + BOX_MARGIN))]
        widths = [half_width(e, center, reach) for e in edges]
        top = [half_width(peak, center, reach)] if peak is not None and edges[0] < peak < edges[1] else []
        # Close to the meridian a distance hardly changes with longitude, so it decides there.
        sure = min(widths) - BOX_MARGIN
        inner.append(181.0 if sure >= 180 - 2 * BOX_MARGIN else sure if sure > 1e-3 else -1.0)
        widest = max(*widths, *top)
        # The circle's end may lie within the first and last band, where both edges are outside.
        touches = edges[0] - 1e-9 <= center + reach <= edges[1] + 1e-9 or edges[0] - 1e-9 <= center - reach <= edges[1] + 1e-9
        outer.append(widest + BOX_MARGIN if widest >= 0 else 181.0 if touches else -1.0)
    return BandCover(low, height, tuple(inner), tuple(outer))


def check_circle(df, center_lat, center_lon, radius_km, latitude="latitude", longitude="longitude") -> None:
    if not radius_km > 0:
        raise InvalidSelectionError("A circle needs a radius above zero.")
    finite(center_lat, center_lon, radius_km)
    require_coords(df, latitude, longitude)


def _within(df, center_lat, center_lon, radius_km, latitude, longitude) -> tuple[Column, Column]:
    """A predicate for the scan, and the exact one, which computes distances at the edge only."""
    check_circle(df, center_lat, center_lon, radius_km, latitude, longitude)
    lat, lon = F.col(latitude), F.col(longitude)
    distance = haversine_km(center_lat, center_lon, lat, lon)
    inside = (distance <= F.lit(float(radius_km))) & ~F.isnan(distance)
    cover = band_cover(center_lat, radius_km)
    if cover is not None:
        at = F.least(F.floor((lat - cover.low) / cover.height).cast("int"), F.lit(len(cover.inner) - 1))
        width = lambda widths: F.get(F.array(*map(F.lit, widths)), at)
        off = lon - F.lit(float(center_lon))
        off = F.abs(off - 360.0 * F.rint(off / 360.0))
        in_bands = (lat >= cover.low) & ((off <= width(cover.inner)) | ((off <= width(cover.outer)) & inside))
        inside = F.when(lat.between(-90.0, 90.0), in_bands).otherwise(inside)
    return circle_box(lat, lon, center_lat, center_lon, radius_km), F.coalesce(inside, F.lit(False))


def circle(
    df, center_lat, center_lon, radius_km, latitude="latitude", longitude="longitude"
) -> DataFrame:
    """Cells whose great-circle distance to the centre is within the radius.

    Bands of latitude tell most cells to be in or out by their longitude alone; a distance is
    computed for those at the edge.
    """
    box, inside = _within(df, center_lat, center_lon, radius_km, latitude, longitude)
    return df.where(box & inside)


def circle_masked(
    df,
    center_lat,
    center_lon,
    radius_km,
    latitude="latitude",
    longitude="longitude",
    variables=(),
) -> DataFrame:
    """The smallest sub-grid around a circle, with cells outside set to NULL.

    A latitude (longitude) stays when any of its cells inside the circle has a
    value in the first of ``variables``. One pass over three columns finds the places
    that have one, at most one row for each; both sets of lines come from it. The
    second pass reads the cells of the box.
    """
    if not variables:
        raise InvalidSelectionError("A masked circle needs at least one variable.")
    box, inside = _within(df, center_lat, center_lon, radius_km, latitude, longitude)
    first = F.col(variables[0])
    present = first.isNotNull()
    if isinstance(df.schema[variables[0]].dataType, (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan(first)
    # The count, and the conditions that either join would add, keep the places one table for both
    # sets of lines, so that they share one pass.
    known = F.col(latitude).isNotNull() & F.col(longitude).isNotNull()
    places = df.where(box & inside & present & known).groupBy(latitude, longitude).agg(F.count("*").alias("_n")).where("_n > 0")
    kept = df.where(box)
    for dim in (latitude, longitude):
        kept = kept.join(places.select(dim).distinct(), dim, "left_semi")
    return kept.select(
        *[
            F.when(inside, F.col(c)).alias(c, metadata=df.schema[c].metadata) if c in variables else F.col(c)
            for c in df.columns
        ]
    )


def time_key(columns, dimension: str | None = "time") -> str:
    """The named dimension if present, else the first default time column."""
    key = infer_coord(columns, [k for k in (dimension, *TIME_KEYS) if k])
    if key is None:
        raise InvalidSelectionError(f"No time column: neither {dimension} nor a default name is there.")
    return key


def time_zones(df, start, end, dimension="time", dims=None) -> list[dict] | None:
    """Bounds that files of the time range meet, as zone numbers (microseconds for instants and
    dates); None where the column is text, which has no zones."""
    key = time_key(dims or df.columns, dimension)
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.StringType):
        return None
    first, last = normalize_time_range(start, end, dtype)
    if isinstance(first, datetime):
        first, last = (epoch_micros(x) for x in (first, last))
    return [{key: (first, last)}]


def time_range(df, start, end, dimension="time", dims=None, year_of=None) -> DataFrame:
    """Cells between two instants, both included, in either order.

    The time column is looked for among ``dims``, or all columns. ``year_of`` names the column
    whose UTC year is the directory of stored cells: a range of that column, and of no
    other, prunes directories.
    """
    key = time_key(dims or df.columns, dimension)
    dtype = df.schema[key].dataType
    kept = df.where(within_time(F.col(key), dtype, start, end))
    dated = isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))
    if dated and key == year_of and YEAR_PARTITION in df.columns:
        first, last = normalize_time_range(start, end, dtype)
        kept = kept.where(F.col(YEAR_PARTITION).between(first.year, last.year))
    return kept
