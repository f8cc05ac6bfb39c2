"""Great-circle distance as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius used by every distance, in kilometres.
EARTH_RADIUS_KM = 6371.0


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Distance in km between two positions in degrees (columns or numbers)."""
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    half_dlat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_dlon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    a = F.abs(
        half_dlat * half_dlat
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    )
    # asin is undefined above 1, which rounding can reach at antipodes. NaN
    # ranks above 1 too, but it and NULL must stay missing.
    clamped = F.when((a > 1) & ~F.isnan(a), F.lit(1.0)).otherwise(a)
    return F.asin(F.sqrt(clamped)) * (2 * EARTH_RADIUS_KM)


def haversine_km_arrays(lat1, lon1, lat2, lon2) -> Column:
    """Element-wise distances; shorter arguments repeat from their start.

    Each argument is an array column, a Python list, or a plain number.
    """

    def as_array(value) -> Column:
        if isinstance(value, Column):
            return value
        values = value if isinstance(value, (list, tuple)) else [value]
        return F.array(*[F.lit(float(v)) for v in values])

    arrays = [as_array(v) for v in (lat1, lon1, lat2, lon2)]
    sizes = [F.size(a) for a in arrays]
    length = F.greatest(*sizes)

    def distance(i: Column) -> Column:
        parts = [F.when(n > 0, F.get(a, F.pmod(i, F.greatest(n, F.lit(1))))) for a, n in zip(arrays, sizes)]
        return haversine_km(*parts)

    return F.when(
        length > 0, F.transform(F.sequence(F.lit(0), length - 1), distance)
    ).otherwise(F.array().cast("array<double>"))
