"""Queries through a Parquet store that is written from the provided tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridloom import CellStore, CellTable, DatasetRequest, GridDataset, GridEngine
from gridloom.operators.points import snap_points
from gridloom.plans.resolution import (
    available_variants,
    items_by_property,
    resolve_api_then_items,
    resolve_datasets,
)
from gridloom.plans.sizing import shared_dir
from gridloom.sources.cells import vacuum, write_cells

from .catalogs import (
    _ORG_PLACED,
    _PARSED,
    _PLACED,
    _SEARCH_ITEMS,
    _TREE_ITEMS,
    _declared,
    _resolution_sql,
    items_of,
    search_items_of,
)
from .fixtures import ctes, fixture, table
from .registry import query


def new_root(spark) -> str:
    return f"{shared_dir(spark)}/store-{uuid.uuid4()}"


def opened(store: CellStore, cid: str) -> GridDataset:
    return GridEngine(store.spark, None, store).load_dataset(DatasetRequest(cid=cid))


# Forecasts made on the day each line ships, for twenty days later.
_FORECAST = """
SELECT CAST(l_suppkey % 19 AS DOUBLE) AS latitude, CAST(l_orderkey % 36 AS DOUBLE) AS longitude,
       l_shipdate AS time, l_shipdate + INTERVAL '20' DAY AS valid_time, max(l_quantity) AS amount
FROM {lineitem} GROUP BY 1, 2, 3, 4"""


def forecasts(spark, sf_dir):
    return spark.sql(_FORECAST, lineitem=table(spark, sf_dir, "lineitem"))


@query(
    "store_second_time",
    f"SELECT * FROM ({_FORECAST.format(lineitem='lineitem')}) WHERE valid_time BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-01-20'",
)
def store_second_time(spark, sf_dir):
    """A range of the second time axis, while directories are years of the first."""
    root = new_root(spark)
    write_cells(forecasts(spark, sf_dir).withColumn("cid", F.lit("forecast")), root)
    return opened(CellStore(spark, root), "forecast").time_range("1997-01-01", "1997-01-20", "valid_time").df


@query(
    "store_zone",
    """SELECT event_id, CAST(user_id AS DOUBLE) AS latitude, epoch_us(ts) AS us, value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-01 06:00:00'""",
)
def store_zone(spark, sf_dir):
    """Instants stored in a zone where the year begins later than in UTC."""
    root = new_root(spark)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, "ts")
    cells = table(spark, sf_dir, "events").select(
        F.lit("events").alias("cid"),
        "event_id",
        F.col("user_id").cast("double").alias("latitude"),
        "value",
        F.timestamp_micros(micros).alias("time"),
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        write_cells(cells, root)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ds = opened(CellStore(spark, root), "events").time_range("2024-01-01T00:00:00Z", "2024-01-01T06:00:00Z")
    return ds.df.select("event_id", "latitude", F.unix_micros("time").alias("us"), "value")


@query(
    "store_mixed_variables",
    """SELECT 'rain' AS cid, CAST(l_suppkey AS DOUBLE) AS latitude, l_shipdate AS time, sum(l_quantity) AS rain, CAST(NULL AS DOUBLE) AS wind
FROM lineitem WHERE l_partkey % 2 = 0 GROUP BY l_suppkey, l_shipdate
UNION ALL
SELECT 'wind', CAST(l_suppkey AS DOUBLE), l_shipdate, NULL, max(l_tax) FROM lineitem WHERE l_partkey % 2 = 1
GROUP BY l_suppkey, l_shipdate""",
)
def store_mixed_variables(spark, sf_dir):
    """Datasets of different variables, written apart and read as one table."""
    lines = table(spark, sf_dir, "lineitem")
    root = new_root(spark)
    for cid, rest, value in (("rain", 0, F.sum("l_quantity")), ("wind", 1, F.max("l_tax"))):
        cells = lines.where(F.col("l_partkey") % 2 == rest).groupBy(
            F.col("l_suppkey").cast("double").alias("latitude"), F.col("l_shipdate").alias("time")
        )
        write_cells(cells.agg(value.alias(cid)).withColumn("cid", F.lit(cid)), root)
    return CellStore(spark, root).table()


@query(
    "store_numeric_cids",
    "SELECT CAST(p_partkey AS DOUBLE) AS latitude, p_retailprice AS price FROM part WHERE p_size % 2 = 0",
)
def store_numeric_cids(spark, sf_dir):
    """Content ids made of digits stay what they are: 007 is not 7."""
    root = new_root(spark)
    cid = F.when(F.col("p_size") % 2 == 0, "007").otherwise("7")
    write_cells(
        table(spark, sf_dir, "part").select(
            cid.alias("cid"), F.col("p_partkey").cast("double").alias("latitude"), F.col("p_retailprice").alias("price")
        ),
        root,
    )
    return opened(CellStore(spark, root), "007").df


@query(
    "store_extra_dimension",
    """SELECT CAST(l_suppkey AS DOUBLE) AS latitude, l_linenumber AS level, sum(l_quantity) AS value
FROM lineitem GROUP BY l_suppkey, l_linenumber""",
)
def store_extra_dimension(spark, sf_dir):
    """A dimension that no name gives away is one after loading, too."""
    root = new_root(spark)
    cells = table(spark, sf_dir, "lineitem").groupBy(
        F.lit("levels").alias("cid"), F.col("l_suppkey").cast("double").alias("latitude"), F.col("l_linenumber").alias("level")
    )
    write_cells(cells.agg(F.sum("l_quantity").alias("amount")), root, dims=("latitude", "level"))
    return opened(CellStore(spark, root), "levels").to_records("amount")


@query(
    "store_replace_one",
    """SELECT 'a' AS cid, CAST(p_partkey AS DOUBLE) AS latitude, 2 * p_retailprice AS price FROM part WHERE p_partkey % 3 = 0
UNION ALL
SELECT 'b', CAST(p_partkey AS DOUBLE), p_retailprice FROM part WHERE p_partkey % 3 = 1
UNION ALL
SELECT 'b', CAST(p_partkey AS DOUBLE), p_retailprice FROM part WHERE p_partkey % 3 = 2""",
)
def store_replace_one(spark, sf_dir):
    """One dataset is replaced, another is added to, and a third write fails for lack of either."""
    root = new_root(spark)
    cells = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 3).alias("third"), F.col("p_partkey").cast("double").alias("latitude"), F.col("p_retailprice").alias("price")
    )

    def of(third, cid, factor=1):
        return cells.where(F.col("third") == third).select(F.lit(cid).alias("cid"), "latitude", (F.col("price") * factor).alias("price"))

    write_cells(of(0, "a").unionByName(of(1, "b")), root)
    write_cells(of(0, "a", 2), root, mode="overwrite")
    write_cells(of(2, "b"), root, mode="append")
    return CellStore(spark, root).table()


_SERIES = """
, listed AS (
  SELECT collection, ds, var, replace(data_href, 'ipfs://', '') AS cid, coalesce(concat_priority, 0) AS p, ord
  FROM parsed WHERE data_href IS NOT NULL)
, wanted AS (
  SELECT collection, ds FROM listed GROUP BY ALL HAVING count(*) {having} ORDER BY count(*) DESC, collection, ds LIMIT 1)
, chosen AS (SELECT listed.* FROM listed JOIN wanted USING (collection, ds))
, ends AS (SELECT cid, max(time) AS last FROM item_cells GROUP BY cid)
, cut AS (
  SELECT chosen.*, max(last) OVER (ORDER BY p, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cutoff
  FROM chosen LEFT JOIN ends USING (cid))
SELECT latitude, longitude, time, precipitation, temperature
FROM cut JOIN item_cells USING (cid) WHERE cutoff IS NULL OR time > cutoff"""


@query("auto_concatenate_request", ctes("items", "item_cells") + _PARSED + _SERIES.format(having="> 1"))
def auto_concatenate_request(spark, sf_dir):
    """The request form, for the dataset with most variants."""
    items = fixture(spark, sf_dir, "items").select("ord", "collection", "id", "data_href", F.col("concat_priority").cast("double"))
    name = F.split("id", "-")[1]
    most = (
        items.where("data_href IS NOT NULL")
        .groupBy("collection", name.alias("dataset"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "collection", "dataset")
        .first()
    )
    engine = GridEngine(spark, items, CellTable(fixture(spark, sf_dir, "item_cells")), resolver="api")
    return engine.load_dataset(DatasetRequest(most["dataset"], most["collection"]), auto_concatenate=True).df


_CLUSTERED = """
SELECT CAST(CASE WHEN p_partkey = 1 THEN 1000000 ELSE p_partkey * CAST(0.0001 AS DOUBLE) END AS DOUBLE) AS latitude,
       CAST(p_size AS DOUBLE) AS longitude, p_retailprice AS price
FROM {part}"""


@query(
    "points_clustered_axis",
    f"""WITH cells AS ({_CLUSTERED.format(part='part')}),
wanted AS (SELECT s_suppkey AS point_id, s_suppkey * CAST(0.0123456 AS DOUBLE) AS y, s_suppkey % 60 + CAST(0.25 AS DOUBLE) AS x FROM supplier)
SELECT point_id, y AS point_latitude, x AS point_longitude,
  (SELECT latitude FROM cells ORDER BY abs(latitude - y), latitude LIMIT 1) AS latitude,
  (SELECT longitude FROM cells ORDER BY abs(longitude - x), longitude LIMIT 1) AS longitude
FROM wanted""",
)
def points_clustered_axis(spark, sf_dir):
    """An axis of close values and one far away."""
    cells = spark.sql(_CLUSTERED, part=table(spark, sf_dir, "part"))
    wanted = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("point_id"),
        (F.col("s_suppkey") * 0.0123456).alias("latitude"),
        (F.col("s_suppkey") % 60 + 0.25).alias("longitude"),
    )
    return snap_points(cells, wanted)


_TREE_OUTCOME = _resolution_sql(_PLACED, _TREE_ITEMS, False)
for _name in ("q", "i", "m", "chosen", "outcome"):
    _TREE_OUTCOME = _TREE_OUTCOME.replace(f"\n, {_name} AS (", f"\n, tree_{_name} AS (")
for _old, _new in (
    ("FROM q LEFT JOIN i ON", "FROM tree_q q LEFT JOIN tree_i i ON"),
    ("AS pick FROM m)", "AS pick FROM tree_m)"),
    ("FROM chosen c LEFT JOIN i ON", "FROM tree_chosen c LEFT JOIN tree_i i ON"),
):
    assert _old in _TREE_OUTCOME
    _TREE_OUTCOME = _TREE_OUTCOME.replace(_old, _new)


@query(
    "resolve_api_then_items",
    ctes("search_items", "requests")
    + _PARSED.replace("FROM items", "FROM search_items WHERE collection IS NOT NULL")
    + _resolution_sql(_PLACED, _SEARCH_ITEMS, True)
    + _TREE_OUTCOME
    + """SELECT * FROM outcome WHERE status = 'ok' UNION ALL
SELECT * FROM tree_outcome WHERE request_id NOT IN (SELECT request_id FROM outcome WHERE status = 'ok')""",
)
def resolve_api_then_items_query(spark, sf_dir):
    """The item search first; what it cannot resolve goes to the item tree."""
    items = search_items_of(spark, sf_dir).select("ord", "collection", "id", "data_href", "dataset_id", "variant")
    collections = tree_collections(fixture(spark, sf_dir, "items"))
    return resolve_api_then_items(fixture(spark, sf_dir, "requests"), items, collections, _declared(spark, sf_dir))


def tree_collections(items):
    org = F.substring_index("collection", "_", 1)
    return items.groupBy("collection").agg(F.min(org).alias("organization_id"), F.min("ord").alias("ord"))


@query(
    "available_variants",
    ctes("search_items")
    + """SELECT DISTINCT coalesce(collection, split_part(id, '-', 1)) AS collection_id,
  coalesce(dataset_id, split_part(id, '-', 2)) AS dataset, coalesce(variant, 'default') AS variant FROM search_items""",
)
def available_variants_query(spark, sf_dir):
    """The names that an item search resolves, items without a collection included."""
    return available_variants(items_by_property(search_items_of(spark, sf_dir)))


_SKEWED = """SELECT DISTINCT l_orderkey * 10 + l_linenumber AS request_id, r.collection, r.dataset, r.variant, r.organization
FROM {lineitem} JOIN {requests} r ON r.request_id = CASE WHEN l_orderkey % 3 <> 0 THEN 30 ELSE l_partkey END"""


@query(
    "resolve_datasets_skewed",
    ctes("items", "org_requests")
    + f", many AS ({_SKEWED.format(lineitem='lineitem', requests='org_requests')})"
    + _PARSED
    + _resolution_sql(_ORG_PLACED.replace("FROM org_requests", "FROM many").replace("org_requests.", "many."), _TREE_ITEMS, False)
    + "SELECT * FROM outcome",
)
def resolve_datasets_skewed(spark, sf_dir):
    """Two requests of three ask for the same dataset."""
    requests = spark.sql(_SKEWED, lineitem=table(spark, sf_dir, "lineitem"), requests=fixture(spark, sf_dir, "org_requests"))
    return resolve_datasets(requests, items_of(spark, sf_dir), declared=_declared(spark, sf_dir))


_PLACES = """SELECT CAST(c_custkey % 400 AS DOUBLE) AS latitude, c_custkey AS ask, CAST(c_nationkey AS DOUBLE) AS rain FROM customer"""


@query(
    "dataset_emptiness",
    f"""WITH asked AS ({_PLACES}), held AS (SELECT DISTINCT CAST(l_suppkey % 300 AS DOUBLE) AS latitude FROM lineitem WHERE l_quantity > 45)
SELECT ask, latitude, rain, latitude NOT IN (SELECT latitude FROM held) AS is_empty,
  latitude NOT IN (SELECT latitude FROM held) AS is_dataset_empty FROM asked""",
)
def dataset_emptiness(spark, sf_dir):
    """Whether there are cells at each of many latitudes, asked for in one table."""
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 45")
    ds = GridDataset(
        lines.select(
            (F.col("l_suppkey") % 300).cast("double").alias("latitude"), F.col("l_shipdate").alias("time"), F.col("l_tax").alias("rain")
        )
    )
    customers = table(spark, sf_dir, "customer")
    wanted = customers.select(
        (F.col("c_custkey") % 400).cast("double").alias("latitude"),
        F.col("c_custkey").alias("ask"),
        F.col("c_nationkey").cast("double").alias("rain"),  # a name that the cells have as well
    )
    return ds.emptiness(wanted, ["latitude"])


_MANY = """
SELECT concat('set', CAST(l_partkey % 40 AS VARCHAR(20))) AS cid, CAST((l_suppkey % 19) * 10 - 90 AS DOUBLE) AS latitude,
       CAST((l_orderkey % 36) * 10 - 180 AS DOUBLE) AS longitude, l_shipdate AS time, max(l_quantity) AS rain
FROM {lineitem} GROUP BY 1, 2, 3, 4"""


#: Where a session has written the store of forty datasets for a folder of tables.
_ROOTS: dict[tuple[str, str], str] = {}


def many_datasets(spark, sf_dir) -> CellStore:
    """A store of forty datasets, written by the first query of a session that reads it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ROOTS:
        root = new_root(spark)
        write_cells(spark.sql(_MANY, lineitem=table(spark, sf_dir, "lineitem")), root)
        _ROOTS[key] = root
    return CellStore(spark, _ROOTS[key])


@query(
    "store_box_files",
    f"""SELECT latitude, longitude, time, rain FROM ({_MANY.format(lineitem='lineitem')}) WHERE cid = 'set7'
AND latitude BETWEEN -35 AND 20 AND longitude BETWEEN -60 AND 100 AND time BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '1997-02-01'""",
)
def store_box_files(spark, sf_dir):
    """A box and a time range of one dataset of many: the file table names the files to open."""
    ds = opened(many_datasets(spark, sf_dir), "set7")
    return ds.rectangle(-35, -60, 20, 100).time_range("1995-06-01", "1997-02-01").df


@query(
    "store_file_zones",
    f"""SELECT cid, year(time) AS year, count(*) AS n, min(latitude) AS south, max(latitude) AS north, min(time) AS first, max(time) AS last
FROM ({_MANY.format(lineitem='lineitem')}) GROUP BY 1, 2""",
)
def store_file_zones(spark, sf_dir):
    """What the file table tells of each dataset and year, without a look at the cells."""
    zone = lambda dim: F.col("zones")[dim]
    instant = lambda micros: F.timestamp_micros(micros.cast("long")).cast("timestamp_ntz")
    return many_datasets(spark, sf_dir).files().groupBy("cid", "year").agg(
        F.sum("n").alias("n"),
        F.min(zone("latitude")["low"]).alias("south"),
        F.max(zone("latitude")["high"]).alias("north"),
        instant(F.min(zone("time")["low"])).alias("first"),
        instant(F.max(zone("time")["high"])).alias("last"),
    )


@query(
    "store_emptiness",
    """SELECT p_partkey, concat('set', CAST(p_partkey % 60 AS VARCHAR)) AS cid,
  p_partkey % 60 NOT IN (SELECT l_partkey % 40 FROM lineitem) AS is_empty,
  p_partkey % 60 NOT IN (SELECT l_partkey % 40 FROM lineitem) AS is_dataset_empty FROM part""",
)
def store_emptiness(spark, sf_dir):
    """Which of many datasets are there and have cells, out of the store's own tables."""
    wanted = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("set"), (F.col("p_partkey") % 60).cast("string")).alias("cid")
    )
    return many_datasets(spark, sf_dir).emptiness(wanted)


@query(
    "store_commits",
    """SELECT CAST(l_suppkey % 5 AS VARCHAR) AS cid, CAST(l_orderkey AS DOUBLE) AS latitude, max(l_tax) * 3 AS rain
FROM lineitem WHERE l_suppkey % 5 = 0 GROUP BY 1, 2
UNION ALL
SELECT CAST(l_suppkey % 5 AS VARCHAR), CAST(l_orderkey AS DOUBLE), max(l_tax) FROM lineitem WHERE l_suppkey % 5 = 1 GROUP BY 1, 2
UNION ALL
SELECT CAST(l_suppkey % 5 AS VARCHAR), CAST(l_orderkey AS DOUBLE), max(l_tax) * 2 FROM lineitem WHERE l_suppkey % 5 IN (1, 2) GROUP BY 1, 2""",
)
def store_commits(spark, sf_dir):
    """Writes that replace and add, then a vacuum: reads are what the order of commits says."""
    cells = table(spark, sf_dir, "lineitem").groupBy(
        (F.col("l_suppkey") % 5).cast("string").alias("cid"), F.col("l_orderkey").cast("double").alias("latitude")
    )
    cells = cells.agg(F.max("l_tax").alias("rain"))
    root = new_root(spark)

    def of(cids, factor):
        return cells.where(F.col("cid").isin(*cids)).withColumn("rain", F.col("rain") * factor)

    write_cells(of(["0", "1"], 1), root)
    write_cells(of(["0"], 2), root, mode="overwrite")
    write_cells(of(["1", "2"], 2), root, mode="append")
    write_cells(of(["0"], 3), root, mode="overwrite")
    vacuum(spark, root, retain_seconds=-60)
    return CellStore(spark, root).table()
