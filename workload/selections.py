"""Selection, join, concatenation and introspection queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom import GridDataset
from gridloom.functions import (
    coerce_time,
    haversine_km,
    haversine_km_arrays,
    normalized_time_range,
    retrieval_status,
    to_comparable,
)
from gridloom.operators import introspect
from gridloom.operators.concat import VariantCells, concat_cutoff, concat_tagged, concat_variants
from gridloom.operators.points import points, points_missed, snap_points
from gridloom.plans.sizing import settle, shared_dir
from gridloom.sources.chunks import ChunkAxis, ChunkGrid, explode_chunks
from gridloom.sources.series import KeptSeries
from gridloom.streaming import merge_histograms, retrieval_histogram, retrieval_rollup

from .fixtures import ctes, fixture, table
from .registry import query


def grid(spark, sf_dir, **kw) -> GridDataset:
    return GridDataset(fixture(spark, sf_dir, "grid"), **kw)


def cube(spark, sf_dir, **kw) -> GridDataset:
    return GridDataset(fixture(spark, sf_dir, "cube"), **kw)


def distance_sql(lat1, lon1, lat2="latitude", lon2="longitude") -> str:
    lat1, lon1 = (f"CAST({v} AS DOUBLE)" for v in (lat1, lon1))
    return f"""(2 * 6371 * asin(sqrt(least(CAST(1 AS DOUBLE), abs(
        pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)
        + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))))"""


def nearest_sql(source: str, dim: str, x, where: str = "true") -> str:
    return (
        f"(SELECT {dim} FROM {source} WHERE {where} "
        f"ORDER BY abs({dim} - CAST({x} AS DOUBLE)), {dim} LIMIT 1)"
    )


# --- filters -----------------------------------------------------------------


@query(
    "rectangle",
    ctes("grid") + "SELECT * FROM grid WHERE latitude BETWEEN 10 AND 11 AND longitude BETWEEN -3 AND 2",
)
def rectangle_query(spark, sf_dir):
    return grid(spark, sf_dir).rectangle(10, -3, 11, 2).df


@query(
    "bounds",
    ctes("grid") + "SELECT * FROM grid WHERE latitude BETWEEN -20 AND -5 AND longitude BETWEEN -4.5 AND 4.25",
)
def bounds_query(spark, sf_dir):
    return grid(spark, sf_dir).select(bounds={"west": -4.5, "south": -20, "east": 4.25, "north": -5}).df


@query(
    "time_range",
    ctes("cube") + "SELECT * FROM cube WHERE time BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-01'",
)
def time_range_query(spark, sf_dir):
    return cube(spark, sf_dir).time_range("1996-03-01T00:00:00Z", "1997-02-01").df


@query(
    "time_range_swapped",
    ctes("cube") + "SELECT * FROM cube WHERE time BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-06-01'",
)
def time_range_swapped(spark, sf_dir):
    return cube(spark, sf_dir).time_range("1998-06-01", "1998-01-01").df


@query("circle", ctes("grid") + f"SELECT * FROM grid WHERE {distance_sql(10.1, -1.2)} <= 50")
def circle_query(spark, sf_dir):
    return grid(spark, sf_dir).circle(10.1, -1.2, 50).df


@query(
    "circle_antimeridian",
    ctes("cube") + f"SELECT * FROM cube WHERE {distance_sql(62.5, 178.25)} <= 1500",
)
def circle_antimeridian(spark, sf_dir):
    return cube(spark, sf_dir).circle(62.5, 178.25, 1500).df


@query(
    "circle_masked",
    ctes("grid")
    + f"""SELECT latitude, longitude, time,
       CASE WHEN d <= 50 THEN temperature END AS temperature,
       CASE WHEN d <= 50 THEN humidity END AS humidity
FROM (SELECT *, {distance_sql(10.1, -1.2)} AS d FROM grid)
WHERE latitude IN (SELECT latitude FROM grid WHERE {distance_sql(10.1, -1.2)} <= 50)
  AND longitude IN (SELECT longitude FROM grid WHERE {distance_sql(10.1, -1.2)} <= 50)""",
)
def circle_masked_query(spark, sf_dir):
    return grid(spark, sf_dir).circle(10.1, -1.2, 50, masked=True).df


@query("point_exact", ctes("grid") + "SELECT * FROM grid WHERE latitude = 12.25 AND longitude = -3.5")
def point_exact_query(spark, sf_dir):
    return grid(spark, sf_dir).point(12.25, -3.5, method="exact").df


@query(
    "point_nearest",
    ctes("cube")
    + f"""SELECT * FROM cube WHERE latitude = {nearest_sql('cube', 'latitude', 33.3)}
  AND longitude = {nearest_sql('cube', 'longitude', -72.9)}""",
)
def point_nearest_query(spark, sf_dir):
    return cube(spark, sf_dir).point(33.3, -72.9).df


@query(
    "point_nearest_tie",
    ctes("grid")
    + f"""SELECT * FROM grid WHERE latitude = {nearest_sql('grid', 'latitude', 10.125)}
  AND longitude = {nearest_sql('grid', 'longitude', 400)}""",
)
def point_nearest_tie(spark, sf_dir):
    return grid(spark, sf_dir).point(10.125, 400).df


@query(
    "point_tolerance",
    ctes("grid")
    + f"""SELECT * FROM grid WHERE latitude = {nearest_sql('grid', 'latitude', 10.1, 'abs(latitude - 10.1) <= 0.125')}
  AND longitude = {nearest_sql('grid', 'longitude', -1.2, 'abs(longitude + 1.2) <= 0.125')}""",
)
def point_tolerance_query(spark, sf_dir):
    return grid(spark, sf_dir).point(10.1, -1.2, tolerance=0.125).df


@query(
    "infer_coord",
    ctes("cube")
    + f"""SELECT latitude AS "LAT", longitude AS "Lng", time AS "Valid Time", precipitation, temperature FROM cube
WHERE latitude = {nearest_sql('cube', 'latitude', -41)} AND longitude = {nearest_sql('cube', 'longitude', 172)}
  AND time >= TIMESTAMP '1998-01-01' AND time <= TIMESTAMP '1998-12-01'""",
)
def infer_coord_query(spark, sf_dir):
    """Dimensions found under other spellings of their names."""
    odd = {"latitude": "LAT", "longitude": "Lng", "time": "Valid Time"}
    ds = GridDataset(fixture(spark, sf_dir, "cube").withColumnsRenamed(odd))
    return ds.point(-41, 172).time_range("1998-01-01", "1998-12-01").df


@query(
    "select_point_time",
    ctes("cube")
    + f"""SELECT latitude, longitude, time, precipitation AS value FROM cube
WHERE latitude = {nearest_sql('cube', 'latitude', 41.2)}
  AND longitude = {nearest_sql('cube', 'longitude', -98.7)}
  AND time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'""",
)
def select_point_time(spark, sf_dir):
    picked = cube(spark, sf_dir).select(
        point={"latitude": 41.2, "longitude": -98.7}, time_range=("1996-01-01", "1999-12-31")
    )
    return picked.to_records("precipitation")


@query(
    "select_bounds_time",
    ctes("cube")
    + """SELECT latitude, longitude, time, round(temperature, 1) AS value FROM cube
WHERE latitude BETWEEN 20 AND 60 AND longitude BETWEEN -110 AND -40
  AND time BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'""",
)
def select_bounds_time(spark, sf_dir):
    picked = cube(spark, sf_dir).select(
        bounds=(-110, 20, -40, 60), time_range={"start": "1997-01-01", "end": "1997-12-31"}
    )
    return picked.to_records("temperature", precision=1)


# --- points ------------------------------------------------------------------

_SNAP = """
, lat_hits AS (
  SELECT p.*, a.latitude AS lat FROM query_points p, (SELECT DISTINCT latitude FROM grid) a
  QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY abs(a.latitude - p.latitude), a.latitude) = 1
), snapped AS (
  SELECT p.point_id, p.latitude AS point_latitude, p.longitude AS point_longitude,
         p.lat AS latitude, a.longitude FROM lat_hits p, (SELECT DISTINCT longitude FROM grid) a
  QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY abs(a.longitude - p.longitude), a.longitude) = 1
)
"""
_CLOSE = "abs(latitude - point_latitude) <= 0.05 AND abs(longitude - point_longitude) <= 0.05"


def _points(spark, sf_dir):
    return fixture(spark, sf_dir, "grid"), fixture(spark, sf_dir, "query_points")


@query("points_join", ctes("grid", "query_points") + _SNAP + "SELECT * FROM snapped")
def points_join(spark, sf_dir):
    return snap_points(*_points(spark, sf_dir))


@query(
    "points_snap",
    ctes("grid", "query_points") + _SNAP + "SELECT * FROM snapped JOIN grid USING (latitude, longitude)",
)
def points_snap(spark, sf_dir):
    return points(*_points(spark, sf_dir))


@query(
    "points_tolerance",
    ctes("grid", "query_points")
    + _SNAP
    + f"SELECT * FROM (SELECT * FROM snapped WHERE {_CLOSE}) JOIN grid USING (latitude, longitude)",
)
def points_tolerance(spark, sf_dir):
    return points(*_points(spark, sf_dir), snap_to_grid=False, tolerance=0.05)


@query(
    "points_missed",
    ctes("grid", "query_points")
    + _SNAP
    + f"""SELECT point_id, point_latitude AS latitude, point_longitude AS longitude
FROM snapped WHERE NOT ({_CLOSE})""",
)
def points_missed_query(spark, sf_dir):
    return points_missed(*_points(spark, sf_dir), tolerance=0.05)


# Points of which a third is on one place.
_CROWD = """, query_points AS (
  SELECT c_custkey AS point_id,
    CASE WHEN c_custkey % 3 = 0 THEN 10.1 ELSE CAST((c_custkey * 37 % 500) * 0.25 - 60 AS DOUBLE) + 0.03125 END AS latitude,
    CASE WHEN c_custkey % 3 = 0 THEN -1.2 ELSE CAST((c_custkey * 11 % 64) * 0.25 - 8 AS DOUBLE) - 0.0625 END AS longitude
  FROM customer)"""


def crowd(spark, sf_dir):
    """The same points, kept apart from the cells of their places."""
    key = F.col("c_custkey")
    wanted = table(spark, sf_dir, "customer").select(
        key.alias("point_id"),
        F.when(key % 3 == 0, 10.1).otherwise((key * 37 % 500) * 0.25 - 60 + 0.03125).alias("latitude"),
        F.when(key % 3 == 0, -1.2).otherwise((key * 11 % 64) * 0.25 - 8 - 0.0625).alias("longitude"),
    )
    return grid(spark, sf_dir).points(wanted, expand=False)


@query(
    "points_per_point",
    ctes("grid")
    + _CROWD
    + _SNAP
    + """SELECT point_id, point_latitude, point_longitude, latitude, longitude, count(*) AS n, max(temperature) AS warmest, min(time) AS since
FROM snapped JOIN grid USING (latitude, longitude) GROUP BY ALL""",
)
def points_per_point(spark, sf_dir):
    """A summary of each point's cells, made once for all the points of a place."""
    return crowd(spark, sf_dir).per_point(
        F.count("*").alias("n"), F.max("temperature").alias("warmest"), F.min("time").alias("since")
    )


@query(
    "points_totals",
    ctes("grid")
    + _CROWD
    + _SNAP
    + """SELECT time, count(humidity) AS n, sum(humidity) AS total, sum(humidity) / count(humidity) AS mean, min(humidity) AS lowest,
  max(humidity) AS highest FROM snapped JOIN grid USING (latitude, longitude) GROUP BY time""",
)
def points_totals(spark, sf_dir):
    """Totals over all points by time, weighted by the points of each place."""
    return crowd(spark, sf_dir).totals("humidity", by=("time",))


# --- concatenation -----------------------------------------------------------

_CONCAT = """SELECT variant, event_id, latitude, longitude, time, value FROM variants
WHERE variant = 'finalized'
   OR time > (SELECT max(time) FROM variants WHERE variant = 'finalized')"""


@query("concat_variants", ctes("variants") + _CONCAT)
def concat_variants_query(spark, sf_dir):
    tagged = fixture(spark, sf_dir, "variants")
    kept = tagged.drop("concat_priority")
    return concat_variants(
        [
            VariantCells(name, kept.where(F.col("variant") == name), priority)
            for name, priority in (("non_finalized", 2), ("finalized", 1))
        ]
    )


@query("concat_cutoff_join", ctes("variants") + _CONCAT)
def concat_cutoff_join(spark, sf_dir):
    return concat_tagged(fixture(spark, sf_dir, "variants")).drop("concat_priority")


@query(
    "concat_cutoff",
    ctes("variants")
    + """SELECT variant, CAST(row_number() OVER o AS INT) AS concat_position, last AS variant_last,
  max(last) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cutoff
FROM (SELECT variant, min(concat_priority) AS p, max(time) AS last FROM variants GROUP BY variant)
WINDOW o AS (ORDER BY p)""",
)
def concat_cutoff_query(spark, sf_dir):
    return concat_cutoff(fixture(spark, sf_dir, "variants"))


@query("kept_series", ctes("variants") + _CONCAT)
def kept_series(spark, sf_dir):
    """The same series, kept and brought up to date by three writes in another order."""
    tagged = fixture(spark, sf_dir, "variants").select(
        F.lit("events").alias("collection"), "variant", "concat_priority", F.lit(0).alias("ord"), "event_id", "latitude", "longitude", "time", "value"
    )
    series = KeptSeries(spark, f"{shared_dir(spark)}/series-{uuid.uuid4()}", group=("collection",))
    final, early = F.col("variant") == "finalized", F.col("time") < F.lit("2024-01-17").cast("timestamp_ntz")
    series.apply(tagged.where(final & early))
    series.apply(tagged.where(~final))
    series.apply(tagged.where(final & ~early))
    return series.read().drop("collection")


@query(
    "concat_order",
    ctes("items")
    + """SELECT variant, CAST(row_number() OVER (ORDER BY p ASC NULLS LAST, o) AS INT) AS concat_position
FROM (SELECT variant, min(concat_priority) AS p, min(ord) AS o FROM items GROUP BY variant)""",
)
def concat_order_query(spark, sf_dir):
    items = fixture(spark, sf_dir, "items").withColumn("time", F.col("ord"))
    return concat_cutoff(items, order="ord").select("variant", "concat_position")


# --- introspection and records -----------------------------------------------


@query("to_records", ctes("grid") + "SELECT latitude, longitude, time, round(temperature, 3) AS value FROM grid")
def to_records_query(spark, sf_dir):
    return grid(spark, sf_dir).to_records("temperature", precision=3)


@query(
    "to_json_records",
    ctes("cube")
    + """SELECT CAST(to_json({latitude: latitude, longitude: longitude, time: strftime(time, '%Y-%m-%d'),
  precipitation: CASE WHEN precipitation > 10 THEN precipitation END, temperature: temperature}) AS VARCHAR) AS json
FROM cube""",
)
def to_json_records_query(spark, sf_dir):
    cells = fixture(spark, sf_dir, "cube")
    missing = F.when(F.col("precipitation") > 10, F.col("precipitation")).otherwise(F.lit(float("nan")))
    as_text = cells.withColumns({"time": F.date_format("time", "yyyy-MM-dd"), "precipitation": missing})
    return GridDataset(as_text).to_json_records()


@query("variables", ctes("grid") + "SELECT unnest(['temperature', 'humidity']) AS variable, count(*) AS cells FROM grid")
def variables_query(spark, sf_dir):
    ds = grid(spark, sf_dir)
    names = F.explode(F.array(*[F.lit(v) for v in ds.variables])).alias("variable")
    return ds.df.agg(F.count("*").alias("cells")).select(names, "cells")


@query("get_variable", ctes("grid") + "SELECT latitude, longitude, time, humidity FROM grid")
def get_variable_query(spark, sf_dir):
    return grid(spark, sf_dir).get_variable("humidity")


@query(
    "axis",
    ctes("cube", "grid")
    + """SELECT 'cube' AS source, latitude AS value FROM cube GROUP BY 2
UNION ALL SELECT 'grid', longitude FROM grid GROUP BY 2""",
)
def axis_query(spark, sf_dir):
    lats = cube(spark, sf_dir).axis("latitude").select(F.lit("cube").alias("source"), F.col("latitude").alias("value"))
    return lats.unionByName(
        grid(spark, sf_dir).axis("longitude").select(F.lit("grid").alias("source"), F.col("longitude").alias("value"))
    )


@query(
    "coords",
    ctes("cube")
    + """SELECT 'latitude' AS dim, count(DISTINCT latitude) AS n FROM cube
UNION ALL SELECT 'longitude', count(DISTINCT longitude) FROM cube
UNION ALL SELECT 'time', count(DISTINCT time) FROM cube""",
)
def coords_query(spark, sf_dir):
    parts = [
        axis.agg(F.lit(dim).alias("dim"), F.count("*").alias("n"))
        for dim, axis in cube(spark, sf_dir).coords.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("axis_order", ctes("cube") + "SELECT DISTINCT time FROM cube ORDER BY time")
def axis_order_query(spark, sf_dir):
    return cube(spark, sf_dir).axis("time").orderBy("time")


@query(
    "sizes",
    ctes("cube")
    + """SELECT count(DISTINCT latitude) AS latitude, count(DISTINCT longitude) AS longitude,
  count(DISTINCT time) AS time FROM cube""",
)
def sizes_query(spark, sf_dir):
    return cube(spark, sf_dir).sizes()


@query(
    "is_empty",
    ctes("grid")
    + """SELECT count(*) = 0 AS nothing_at_pole, (SELECT count(*) = 0 FROM grid) AS nothing_at_all
FROM grid WHERE latitude BETWEEN 80 AND 90""",
)
def is_empty_query(spark, sf_dir):
    ds = grid(spark, sf_dir)
    polar, whole = (d.df.agg(F.count("*") == 0).scalar() for d in (ds.rectangle(80, -180, 90, 180), ds))
    return spark.range(1).select(polar.alias("nothing_at_pole"), whole.alias("nothing_at_all"))


@query(
    "describe_dataset",
    ctes("cube")
    + " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, '{name}' AS name, '{dtype}' AS dtype, count({distinct}{name}) AS size,
  CAST(min({name}) AS VARCHAR) AS lowest, CAST(max({name}) AS VARCHAR) AS highest, '{attrs}' AS attrs FROM cube"""
        if name != "time"
        else f"""SELECT '{kind}', '{name}', '{dtype}', count(DISTINCT time),
  strftime(min(time), '%Y-%m-%dT%H:%M:%S'), strftime(max(time), '%Y-%m-%dT%H:%M:%S'), '{attrs}' FROM cube"""
        for kind, name, dtype, distinct, attrs in (
            ("dimension", "latitude", "double", "DISTINCT ", "{}"),
            ("dimension", "longitude", "double", "DISTINCT ", "{}"),
            ("dimension", "time", "timestamp_ntz", "DISTINCT ", "{}"),
            ("variable", "precipitation", "double", "", '{"units":"mm"}'),
            ("variable", "temperature", "double", "", "{}"),
        )
    ),
)
def describe_query(spark, sf_dir):
    cells = fixture(spark, sf_dir, "cube")
    units = F.col("precipitation").alias("precipitation", metadata={"units": "mm"})
    return GridDataset(cells.withColumn("precipitation", units)).describe()


@query(
    "coord_preview",
    ctes("cube")
    + """, v AS (
  SELECT 'latitude' AS dim, latitude AS k, CAST(latitude AS VARCHAR) AS value FROM cube GROUP BY latitude
  UNION ALL SELECT 'longitude', longitude, CAST(longitude AS VARCHAR) FROM cube GROUP BY longitude
  UNION ALL SELECT 'time', epoch(time), strftime(time, '%Y-%m-%dT%H:%M:%S') FROM cube GROUP BY time)
SELECT dim, 'first' AS side, CAST(row_number() OVER (PARTITION BY dim ORDER BY k) - 1 AS INT) AS position, value
FROM v QUALIFY position < 3
UNION ALL
SELECT dim, 'last', CAST(2 - (row_number() OVER (PARTITION BY dim ORDER BY k DESC) - 1) AS INT) AS position, value
FROM v QUALIFY position >= 0""",
)
def coord_preview_query(spark, sf_dir):
    ds = cube(spark, sf_dir)
    return introspect.coord_preview(ds.df, ds.dims)


@query(
    "explode_chunks",
    """SELECT CAST((vec_id % 500) * 0.25 - 60 AS DOUBLE) AS latitude,
  CAST(j * 0.25 - 8 AS DOUBLE) AS longitude, CAST(vec_id // 500 AS BIGINT) AS step, CAST(v AS DOUBLE) AS temperature
FROM (SELECT vec_id, unnest(range(len(embedding))) AS j, unnest(embedding) AS v FROM embeddings)""",
)
def explode_chunks_query(spark, sf_dir):
    vec = F.col("vec_id")
    axes = [
        ChunkAxis("latitude", F.pmod(vec, F.lit(500)) * F.lit(0.25) - F.lit(60.0), F.lit(0.25), None),
        ChunkAxis("longitude", -8.0, 0.25, size=64),
    ]
    keep = {"step": F.floor(vec / 500).cast("long")}
    return explode_chunks(table(spark, sf_dir, "embeddings"), "embedding", "temperature", axes, keep)


@query(
    "explode_chunks_irregular",
    """SELECT n_nationkey * n_nationkey / CAST(4 AS DOUBLE) AS latitude, CAST(j * 0.5 AS DOUBLE) AS longitude,
  vec_id, CAST(v AS DOUBLE) AS temperature
FROM (SELECT vec_id, unnest(range(len(embedding))) AS j, unnest(embedding) AS v FROM embeddings)
JOIN nation ON n_nationkey = vec_id % 25""",
)
def explode_chunks_irregular(spark, sf_dir):
    """Each vector as one line of a grid whose latitudes are unevenly spaced."""
    key = F.col("n_nationkey")
    lines = table(spark, sf_dir, "nation").select(
        key.alias("position"), (key * key / F.lit(4.0)).alias("value")
    )
    axes = [
        ChunkAxis("latitude", F.pmod("vec_id", F.lit(25)), values=lines),
        ChunkAxis("longitude", 0.0, 0.5, size=64),
    ]
    keep = {"vec_id": F.col("vec_id")}
    return explode_chunks(table(spark, sf_dir, "embeddings"), "embedding", "temperature", axes, keep)


_CHUNK_SQL = """SELECT CAST((vec_id % 500) * 0.25 - 60 AS DOUBLE) AS latitude,
  CAST(j * 0.25 - 8 AS DOUBLE) AS longitude, CAST(vec_id // 500 AS BIGINT) AS step, CAST(v AS DOUBLE) AS temperature
FROM (SELECT vec_id, unnest(range(len(embedding))) AS j, unnest(embedding) AS v FROM embeddings)"""


def chunk_grid(spark, sf_dir) -> ChunkGrid:
    """Each vector as a chunk of one latitude."""
    vec = F.col("vec_id")
    axes = [
        ChunkAxis("latitude", F.pmod(vec, F.lit(500)) * F.lit(0.25) - F.lit(60.0), F.lit(0.25), 1),
        ChunkAxis("longitude", -8.0, 0.25, size=64),
    ]
    keep = {"step": F.floor(vec / 500).cast("long")}
    return ChunkGrid(table(spark, sf_dir, "embeddings"), "embedding", "temperature", axes, keep)


@query("chunk_box", f"SELECT * FROM ({_CHUNK_SQL}) WHERE latitude BETWEEN -31.1 AND 12.25 AND longitude BETWEEN -3 AND 1.6")
def chunk_box(spark, sf_dir):
    """A box over chunks: those outside are left alone, the others are cut before the explosion."""
    return chunk_grid(spark, sf_dir).select({"latitude": (-31.1, 12.25), "longitude": (-3, 1.6)})


@query(
    "chunk_nearest",
    f"""WITH cells AS ({_CHUNK_SQL}) SELECT * FROM cells WHERE latitude = {nearest_sql('cells', 'latitude', 10.125)}
  AND longitude = {nearest_sql('cells', 'longitude', 3.3)}""",
)
def chunk_nearest(spark, sf_dir):
    """The nearest place of a grid in chunks, found from their origins."""
    return chunk_grid(spark, sf_dir).nearest({"latitude": 10.125, "longitude": 3.3})


# --- functions ---------------------------------------------------------------


@query(
    "haversine_km",
    ctes("query_points")
    + f"""SELECT point_id, round({distance_sql(40.7128, -74.006)}, 6) AS km,
  round({distance_sql('latitude', 'longitude', '-latitude', 'longitude + 180')}, 3) AS to_antipode
FROM query_points""",
)
def haversine_query(spark, sf_dir):
    lat, lon = F.col("latitude"), F.col("longitude")
    return fixture(spark, sf_dir, "query_points").select(
        "point_id",
        F.round(haversine_km(40.7128, -74.006, lat, lon), 6).alias("km"),
        F.round(haversine_km(lat, lon, -lat, lon + 180), 3).alias("to_antipode"),
    )


@query(
    "haversine_km_arrays",
    ctes("query_points")
    + f"""SELECT point_id, i, round({distance_sql('lat', 'lon', 'latitude', '[10, 20, 30][i + 1]')}, 6) AS km
FROM (SELECT *, unnest(range(3)) AS i FROM query_points),
LATERAL (SELECT [0, 45][i % 2 + 1] AS lat, longitude AS lon)""",
)
def haversine_arrays_query(spark, sf_dir):
    points_df = fixture(spark, sf_dir, "query_points")
    km = haversine_km_arrays([0, 45], F.array("longitude"), F.array("latitude"), [10, 20, 30])
    return points_df.select("point_id", F.posexplode(km).alias("i", "km")).select(
        "point_id", F.col("i").cast("long").alias("i"), F.round("km", 6).alias("km")
    )


@query(
    "coerce_time",
    """SELECT event_id, CAST(epoch_ms(date_trunc('second', ts)) AS DOUBLE) AS number,
  date_trunc('second', ts) AS instant, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS text FROM events""",
)
def coerce_time_query(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, sf_dir, "events").select(
        "event_id",
        coerce_time(iso, "number").alias("number"),
        coerce_time(iso, "timestamp").alias("instant"),
        coerce_time(iso, "text").alias("text"),
    )


# Each order and shipping date is a range, the second spelt in four ways by the line's number.
_RANGES = """
WITH ranges AS (
  SELECT o_orderkey, l_linenumber, l_quantity, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000Z') AS start,
    CASE l_linenumber % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
      WHEN 2 THEN 'soon' ELSE CAST(epoch_ms(o_orderdate) AS VARCHAR) END AS stop
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
, read AS (
  SELECT *, try_cast(start AS TIMESTAMP) AS t1, CASE WHEN l_linenumber % 4 < 2 THEN try_cast(stop AS TIMESTAMP) END AS t2,
    CAST(epoch_ms(t1) AS DOUBLE) AS n1, coalesce(try_cast(stop AS DOUBLE), CAST(epoch_ms(t2) AS DOUBLE)) AS n2
  FROM ranges)
SELECT o_orderkey, l_linenumber, l_quantity,
  CASE WHEN n2 IS NOT NULL THEN least(n1, n2) END AS first_ms, CASE WHEN n2 IS NOT NULL THEN greatest(n1, n2) END AS last_ms,
  CASE WHEN t2 IS NOT NULL THEN least(t1, t2) END AS first_instant, CASE WHEN t2 IS NOT NULL THEN greatest(t1, t2) END AS last_instant,
  CASE WHEN t1 > t2 THEN strftime(t2, '%Y-%m-%dT%H:%M:%S.000Z') ELSE start END AS first_text,
  CASE WHEN t1 > t2 THEN start ELSE stop END AS last_text
FROM read"""


@query("normalize_time_range", _RANGES)
def normalize_time_range_query(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    way, ordered = F.col("l_linenumber") % 4, F.col("o_orderdate")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    ranges = orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        "o_orderkey",
        "l_linenumber",
        "l_quantity",
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("start"),
        F.when(way == 0, F.date_format(ordered, "yyyy-MM-dd"))
        .when(way == 1, F.date_format(ordered, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(way == 2, "soon")
        .otherwise(F.timestamp_diff("MILLISECOND", epoch, ordered.cast("timestamp_ntz")).cast("string"))
        .alias("stop"),
    )
    ends = {t: normalized_time_range(F.col("start"), F.col("stop"), t) for t in ("number", "timestamp", "text")}
    names = {"number": "ms", "timestamp": "instant", "text": "text"}
    return ranges.select(
        "o_orderkey",
        "l_linenumber",
        "l_quantity",
        *[ends[t][side].alias(f"{side}_{name}") for t, name in names.items() for side in ("first", "last")],
    )


@query("to_comparable", "SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def to_comparable_query(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return table(spark, sf_dir, "events").select("event_id", to_comparable(iso, T.StringType()).alias("ms"))


# --- retrieval log -----------------------------------------------------------

_STATUS = """CASE WHEN message IS NULL THEN 'ok'
  WHEN regexp_matches(message, 'Connection refused|Max retries exceeded|Timeout|timed out|ECONNREFUSED|ETIMEDOUT')
  THEN 'connection_error' ELSE 'error' END"""


@query("retrieval_status", ctes("retrieval_log") + f"SELECT ts, {_STATUS} AS status FROM retrieval_log")
def retrieval_status_query(spark, sf_dir):
    log = fixture(spark, sf_dir, "retrieval_log")
    return log.select("ts", retrieval_status(F.col("message")).alias("status"))


@query(
    "retrieval_rollup",
    ctes("retrieval_log")
    + f"""SELECT gateway, store_type, {_STATUS} AS status, count(*) AS requests, min(duration_ms) AS min_ms,
  max(duration_ms) AS max_ms, round(sum(duration_ms), 2) AS sum_ms FROM retrieval_log GROUP BY 1, 2, 3""",
)
def retrieval_rollup_query(spark, sf_dir):
    rows = retrieval_rollup(fixture(spark, sf_dir, "retrieval_log"))
    return rows.withColumn("sum_ms", F.round("sum_ms", 2))


@query(
    "retrieval_rollup_daily",
    ctes("retrieval_log")
    + f"""SELECT date_trunc('day', ts) AS window_start, gateway, store_type, {_STATUS} AS status,
  count(*) AS requests, min(duration_ms) AS min_ms, max(duration_ms) AS max_ms,
  round(sum(duration_ms), 2) AS sum_ms FROM retrieval_log GROUP BY 1, 2, 3, 4""",
)
def retrieval_rollup_daily(spark, sf_dir):
    rows = retrieval_rollup(fixture(spark, sf_dir, "retrieval_log"), window="1 day")
    return rows.withColumn("sum_ms", F.round("sum_ms", 2))


_BUCKETS = ", ".join(
    f"count(*) FILTER (duration_ms > {low} AND duration_ms <= {high}) AS upto_{high}" for low, high in ((-1e9, 5), (5, 50), (50, 250))
)


@query(
    "retrieval_histogram_daily",
    ctes("retrieval_log")
    + f"""SELECT date_trunc('day', ts) AS window_start, gateway, store_type, {_STATUS} AS status, count(*) AS requests,
  count(duration_ms) AS measured, min(duration_ms) AS min_ms, max(duration_ms) AS max_ms, round(sum(duration_ms), 2) AS sum_ms,
  {_BUCKETS}, count(*) FILTER (duration_ms > 250) AS above FROM retrieval_log GROUP BY 1, 2, 3, 4""",
)
def retrieval_histogram_daily(spark, sf_dir):
    """Daily distributions of durations, rolled up from an hourly state and not from the log."""
    boundaries = (5, 50, 250)
    hourly = settle(retrieval_histogram(fixture(spark, sf_dir, "retrieval_log"), "1 hour", boundaries=boundaries))
    daily = merge_histograms(hourly, "1 day", boundaries)
    names = [f"upto_{b}" for b in boundaries] + ["above"]
    return daily.withColumn("sum_ms", F.round("sum_ms", 2)).select(
        *[c for c in daily.columns if c != "buckets"], *[F.get("buckets", F.lit(i)).alias(n) for i, n in enumerate(names)]
    )
