"""Gridded and catalog tables derived from the provided tables.

Each text runs on Spark and on DuckDB; the few that differ have two forms.
``{name}`` marks a provided table or another fixture.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from gridloom.plans.sizing import settle

_ORG = "CASE p_partkey % 3 WHEN 0 THEN 'ecmwf' WHEN 1 THEN 'noaa' ELSE 'copernicus' END"
_COLLECTION = f"concat({_ORG}, '_', replace(lower(p_brand), '#', ''))"
_DATASET = "concat(lower(p_type), CASE WHEN p_size % 2 = 0 THEN '_land' ELSE '' END)"

_GRID = """
SELECT CAST((vec_id % 500) * CAST(0.25 AS DOUBLE) - 60 AS DOUBLE) AS latitude,
       CAST(j * CAST(0.25 AS DOUBLE) - 8 AS DOUBLE) AS longitude,
       CAST('2024-01-01' AS TIMESTAMP) + CAST(floor(vec_id / 500) AS INT) * INTERVAL '1' DAY AS time,
       CAST(v AS DOUBLE) AS temperature,
       CAST(label * 10 + j AS DOUBLE) AS humidity
FROM """

SQL = {
    "cube": """
SELECT CAST((l_suppkey % 19) * 10 - 90 AS DOUBLE) AS latitude,
       CAST((l_partkey % 36) * 10 - 180 AS DOUBLE) AS longitude,
       CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS time,
       max(l_quantity) AS precipitation,
       min(l_extendedprice) AS temperature
FROM {lineitem} GROUP BY 1, 2, 3""",
    "variants": """
SELECT 'finalized' AS variant, 1 AS concat_priority, event_id,
       CAST((user_id % 19) * 10 - 90 AS DOUBLE) AS latitude,
       CAST((event_id % 36) * 10 - 180 AS DOUBLE) AS longitude,
       ts AS time, value
FROM {events} WHERE ts < CAST('2024-01-21' AS TIMESTAMP)
UNION ALL
SELECT 'non_finalized', 2, event_id,
       CAST((user_id % 19) * 10 - 90 AS DOUBLE),
       CAST((event_id % 36) * 10 - 180 AS DOUBLE),
       ts, value + CAST(0.5 AS DOUBLE)
FROM {events} WHERE ts >= CAST('2024-01-15' AS TIMESTAMP)""",
    "query_points": """
SELECT s_suppkey AS point_id,
       CAST((s_suppkey * 37 % 500) * CAST(0.25 AS DOUBLE) - 60 + CAST(0.03125 AS DOUBLE) AS DOUBLE) AS latitude,
       CAST((s_suppkey * 11 % 64) * CAST(0.25 AS DOUBLE) - 8
            - CASE WHEN s_suppkey % 3 = 0 THEN CAST(0.0625 AS DOUBLE) ELSE CAST(0.03125 AS DOUBLE) END AS DOUBLE) AS longitude
FROM {supplier}""",
    "items": f"""
SELECT p_partkey AS ord,
       {_COLLECTION} AS collection,
       {_DATASET} AS dataset,
       CASE p_size % 4 WHEN 0 THEN 'finalized' WHEN 1 THEN 'non_finalized' WHEN 2 THEN 'ensemble' ELSE 'default' END AS variant,
       concat({_COLLECTION}, '-', {_DATASET},
              CASE p_size % 4 WHEN 0 THEN '-finalized' WHEN 1 THEN '-non_finalized' WHEN 2 THEN '-ensemble' ELSE '' END) AS id,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE concat('ipfs://bafy', CAST(p_partkey AS VARCHAR(20))) END AS data_href,
       CASE p_partkey % 3 WHEN 0 THEN 'historical' WHEN 1 THEN 'forecast'
            ELSE CASE WHEN p_size % 3 = 0 THEN 'forecast' ELSE 'historical' END END AS observation,
       CASE WHEN p_size % 4 = 0 THEN 1 WHEN p_size % 4 = 1 THEN 2 END AS concat_priority
FROM {{part}}""",
    # Search form of the items: names as properties, some of them missing.
    "search_items": """
SELECT ord, CASE WHEN ord % 31 <> 0 THEN collection END AS collection, id, data_href, observation,
       CASE WHEN ord % 19 <> 0 THEN dataset END AS dataset_id,
       CASE WHEN ord % 19 <> 0 THEN variant END AS variant,
       CASE WHEN ord % 11 <> 0 THEN concat('ipfs://bafy', CAST(ord AS VARCHAR(20))) END AS latest_cid,
       CAST(ord % 90 AS DOUBLE) AS edge,
       CASE WHEN ord % 3 <> 0 THEN concat('20', CAST(10 + ord % 10 AS VARCHAR(20)), '-01-01T00:00:00Z') END AS start_datetime,
       CASE WHEN ord % 2 <> 0 THEN concat('20', CAST(20 + ord % 5 AS VARCHAR(20)), '-01-01T00:00:00Z') END AS end_datetime,
       CASE WHEN ord % 4 = 0 THEN '2015-06-01T00:00:00Z' END AS datetime
FROM {items}""",
    "requests": f"""
SELECT p_partkey AS request_id,
       {_COLLECTION} AS collection,
       CASE WHEN p_partkey % 7 = 0 THEN 'unknown_dataset' ELSE lower(p_type) END AS dataset,
       CASE WHEN p_partkey % 5 = 0 THEN 'finalized' WHEN p_partkey % 5 = 1 THEN 'unknown_variant' END AS variant
FROM {{part}} WHERE p_partkey % 4 = 0""",
    # The same requests with the organization split off, wrong or left out.
    "org_requests": f"""
SELECT p_partkey AS request_id,
       CASE WHEN p_partkey % 3 = 0 THEN replace(lower(p_brand), '#', '')
            WHEN p_partkey % 11 = 1 THEN 'nowhere'
            ELSE {_COLLECTION} END AS collection,
       {_DATASET} AS dataset,
       CASE WHEN p_partkey % 5 = 0 THEN 'finalized' END AS variant,
       CASE WHEN p_partkey % 2 = 0 THEN {_ORG} WHEN p_partkey % 13 = 1 THEN 'esa' END AS organization
FROM {{part}}""",
    "retrieval_log": """
SELECT ts, concat('gw', CAST(user_id % 3 AS VARCHAR(20))) AS gateway, 'store' AS store_type,
       CASE event_type WHEN 'error' THEN 'ETIMEDOUT while opening store'
                       WHEN 'signup' THEN 'zarr metadata missing' END AS message,
       value AS duration_ms
FROM {events}""",
    # Cells of every catalog item, keyed by the content id its asset names.
    "item_cells": """
SELECT concat('bafy', CAST(l_partkey AS VARCHAR(20))) AS cid,
       CAST((l_suppkey % 19) * 10 - 90 AS DOUBLE) AS latitude,
       CAST((l_orderkey % 36) * 10 - 180 AS DOUBLE) AS longitude,
       l_shipdate AS time,
       max(l_quantity) AS precipitation,
       min(l_extendedprice) AS temperature
FROM {lineitem} GROUP BY 1, 2, 3, 4""",
}

SPARK_SQL = {"grid": _GRID + "{embeddings} LATERAL VIEW posexplode(embedding) x AS j, v"}
DUCKDB_SQL = {
    "grid": _GRID
    + "(SELECT vec_id, label, unnest(range(len(embedding))) AS j, unnest(embedding) AS v FROM {embeddings})"
}

_MARK = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = SPARK_SQL.get(name) or SQL[name]
    sources = {
        mark: fixture(spark, sf_dir, mark) if mark in SQL or mark in SPARK_SQL else table(spark, sf_dir, mark)
        for mark in set(_MARK.findall(text))
    }
    # Provided timestamps carry no zone, so literals must not either.
    return spark.sql(text.replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)"), **sources)


def ctes(*names: str) -> str:
    """WITH clause of the named fixtures, for the oracle."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        text = DUCKDB_SQL.get(name) or SQL[name]
        for mark in _MARK.findall(text):
            if mark in SQL or mark in DUCKDB_SQL:
                add(mark)
        parts.setdefault(name, f"{name} AS ({_MARK.sub(lambda m: m.group(1), text)})")

    for name in names:
        add(name)
    return "WITH " + ",\n".join(parts.values()) + "\n"


# --- catalog documents -------------------------------------------------------

# Items per row of a collection document; the document is split into parts.
PART_ITEMS = 1000

ROOT = "ipfs://root"

_DOCS = """
WITH tree AS (
  SELECT ord, collection, dataset, variant, id, data_href, observation,
         substring_index(collection, '_', 1) AS org,
         CAST(regexp_extract(collection, '[0-9]+$', 0) AS INT) AS brand
  FROM {items}
),
names AS (SELECT DISTINCT org, collection, brand FROM tree),
slugs AS (
  SELECT DISTINCT org, concat(collection, '/', dataset) AS slug FROM tree
  UNION SELECT org, concat(collection, '/planned') FROM names
),
by_org AS (
  SELECT org,
         array_sort(collect_list(CASE WHEN brand % 2 = 1 THEN collection END)) AS historical,
         array_sort(collect_list(CASE WHEN brand % 2 = 0 THEN collection END)) AS forecast,
         array_sort(collect_list(collection)) AS collections
  FROM names GROUP BY org
),
slugs_by_org AS (SELECT org, array_sort(collect_list(slug)) AS slugs FROM slugs GROUP BY org),
org_links AS (
  SELECT org, to_json(named_struct(
           'rel', 'child', 'href', concat('ipfs://org-', org), 'title', upper(org), 'grid:id', org,
           'grid:collections:historical', historical, 'grid:collections:forecast', forecast,
           'grid:datasets', slugs)) AS link
  FROM by_org JOIN slugs_by_org USING (org)
)
SELECT 'ipfs://root' AS href, 0 AS part,
       concat('{{"id":"root","links":[{{"rel":"self","href":"ipfs://root"}},',
              '{{"rel":"child","href":"ipfs://org-gone","grid:id":"gone"}},',
              array_join(transform(array_sort(collect_list(struct(org, link))), x -> x.link), ','), ']}}') AS body
FROM org_links
UNION ALL
SELECT concat('ipfs://org-', org), 0,
       to_json(named_struct('id', org, 'links', concat(
         transform(collections, c -> named_struct('rel', 'child', 'href', concat('ipfs://collection-', c))),
         array(named_struct('rel', 'child', 'href', concat('ipfs://collection-gone-', org))))))
FROM by_org
UNION ALL
SELECT concat('ipfs://collection-', collection), CAST(floor(ord / {part_items}) AS INT),
       to_json(named_struct('id', collection, 'title', concat('About ', collection), 'links',
         transform(array_sort(collect_list(struct(ord, id))), x -> named_struct(
           'rel', 'item', 'href', concat('ipfs://item-', x.ord), 'grid:id', x.id,
           'grid:concatPriority', CASE WHEN x.ord % 3 = 0 THEN x.ord % 7 END))))
FROM tree GROUP BY collection, floor(ord / {part_items})
UNION ALL
SELECT concat('ipfs://item-', ord), 0,
       CASE WHEN ord % 29 = 0 THEN '{{"id": "cut'
       ELSE concat('{{"id":"', id, '","properties":{{"grid:dataset_id":"', dataset, '","grid:variant":"', variant,
              '","grid:observation":"', observation, '"',
              CASE WHEN ord % 13 = 0 THEN ',"grid:concatPriority":"1"'
                   WHEN ord % 5 = 0 THEN concat(',"grid:concatPriority":', ord % 4) ELSE '' END,
              CASE WHEN ord % 2 = 0 THEN ',"grid:concatDimension":"step"' ELSE '' END,
              CASE WHEN data_href IS NULL THEN '}},"assets":{{}}}}'
                   ELSE concat('}},"assets":{{"data":{{"href":"', data_href, '"}}}}}}') END) END
FROM tree WHERE ord % 23 <> 0
"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items as a tree of catalog documents, some missing or cut short.

    Lists gathered in one document are bounded: organizations by the few
    brands and types, collections by ``PART_ITEMS`` per part. The documents
    are written once, as a published catalog would be.
    """
    return settle(spark.sql(_DOCS, items=fixture(spark, sf_dir, "items"), part_items=PART_ITEMS))
