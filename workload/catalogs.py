"""Catalog queries: listings, resolution, tree walks and end-to-end loads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridloom import CatalogKeys, CellStore, CellTable, DatasetMetadata, DatasetRequest, GridDataset, GridEngine
from gridloom.functions import (
    collection_by_split,
    dataset_by_prefix,
    dataset_by_split,
    dataset_path,
    item_bbox,
    item_time_extent,
    normalize_segment,
    number_prop,
    org_from_collection,
    qualify_collection,
    resolve_ipfs_uri,
    string_list,
    string_prop,
    strip_ipfs,
    variant_by_prefix,
    variant_by_split,
)
from gridloom.plans.concatenable import concatenable_items, link_meta_join
from gridloom.plans.listing import (
    available_datasets,
    catalog_key_differences,
    catalog_parity,
    catalog_set_differences,
    collection_category,
    latest_variant_rows,
    list_datasets,
    list_datasets_api,
)
from gridloom.plans.resolution import (
    DATASET_NOT_FOUND,
    org_resolve,
    pick_variant,
    pick_variant_api,
    resolve_collections,
    resolve_datasets,
    resolve_datasets_api,
    resolve_join,
)
from gridloom.plans.sizing import shared_dir
from gridloom.plans.walk import load_catalog
from gridloom.sources.cells import write_cells
from gridloom.sources.nodes import CatalogStore

from .fixtures import ROOT, ctes, documents, fixture, table
from .registry import query

KEYS = CatalogKeys("grid")


def items_of(spark, sf_dir):
    """Items as the tree form has them: names only inside the id."""
    return fixture(spark, sf_dir, "items").select("ord", "collection", "id", "data_href")


def search_items_of(spark, sf_dir):
    edge = F.col("edge")
    whole = F.array(-edge, -edge / 2, edge, edge / 2)
    box = F.when(F.col("ord") % 4 != 0, whole).otherwise(F.array(edge, edge))
    return fixture(spark, sf_dir, "search_items").withColumn("bbox", box).drop("edge")


def tree_of(spark, sf_dir):
    return load_catalog(documents(spark, sf_dir), ROOT, KEYS)


_PARSED = """
, parsed AS (
  SELECT *, split_part(id, '-', 2) AS ds,
    CASE WHEN len(string_split(id, '-')) > 2 THEN array_to_string(string_split(id, '-')[3:], '-') ELSE 'default' END AS var
  FROM items)
"""

# --- listings ----------------------------------------------------------------


@query(
    "list_datasets",
    ctes("items")
    + _PARSED
    + """SELECT collection, ds AS dataset, var AS variant, replace(data_href, 'ipfs://', '') AS cid,
  split_part(collection, '_', 1) AS organization, ord AS position FROM parsed WHERE data_href IS NOT NULL""",
)
def list_datasets_query(spark, sf_dir):
    listing = list_datasets(items_of(spark, sf_dir))
    return listing.select("collection", "dataset", "variant", "cid", "organization", "position")


_SEARCH = """
, named AS (
  SELECT *, coalesce(collection, split_part(id, '-', 1)) AS col, coalesce(dataset_id, split_part(id, '-', 2)) AS ds,
    coalesce(variant, CASE WHEN len(string_split(id, '-')) > 2
      THEN array_to_string(string_split(id, '-')[3:], '-') ELSE 'default' END) AS var
  FROM search_items)
, latest AS (
  SELECT col AS collection, ds AS dataset, var AS variant, replace(latest_cid, 'ipfs://', '') AS cid,
    CASE WHEN ord % 4 <> 0 THEN -edge END AS west, CASE WHEN ord % 4 <> 0 THEN -edge / 2 END AS south,
    CASE WHEN ord % 4 <> 0 THEN edge END AS east, CASE WHEN ord % 4 <> 0 THEN edge / 2 END AS north,
    coalesce(start_datetime, datetime) AS start, coalesce(end_datetime, datetime) AS "end",
    min(ord) OVER (PARTITION BY col, ds, var) AS position
  FROM named QUALIFY row_number() OVER (PARTITION BY col, ds, var ORDER BY ord DESC) = 1)
, categories AS (
  SELECT col AS collection, CASE WHEN count(DISTINCT observation) = 1 THEN max(observation) END AS category
  FROM named GROUP BY col)
"""


@query(
    "list_datasets_api",
    ctes("search_items")
    + _SEARCH
    + """SELECT l.*, split_part(collection, '_', 1) AS organization, CAST(NULL AS VARCHAR) AS title, category
FROM latest l JOIN categories USING (collection)""",
)
def list_datasets_api_query(spark, sf_dir):
    return list_datasets_api(search_items_of(spark, sf_dir))


@query(
    "list_available_datasets",
    ctes("search_items")
    + _SEARCH
    + "SELECT collection, dataset, variant, cid, category FROM latest JOIN categories USING (collection)",
)
def list_available_datasets_query(spark, sf_dir):
    engine = GridEngine(spark, search_items_of(spark, sf_dir), store=None)
    return engine.list_available_datasets().select("collection", "dataset", "variant", "cid", "category")


@query("latest_variant_row", ctes("search_items") + _SEARCH + "SELECT * FROM latest")
def latest_variant_query(spark, sf_dir):
    return latest_variant_rows(search_items_of(spark, sf_dir))


@query("collection_category", ctes("search_items") + _SEARCH + "SELECT * FROM categories")
def collection_category_query(spark, sf_dir):
    return collection_category(search_items_of(spark, sf_dir))


# Two forms of one catalog that differ on some items: the tree (left), and the search (right) with
# other boxes, instants in another spelling or a day late, other titles, and collections of its own.
_TWO_FORMS = (
    ctes("items")
    + _PARSED
    + """
, left_items AS (
  SELECT *, CAST(ord % 90 AS DOUBLE) AS edge, concat('20', CAST(10 + ord % 10 AS VARCHAR(20)), '-01-01T00:00:00Z') AS began
  FROM parsed WHERE data_href IS NOT NULL)
, l AS (
  SELECT collection, ds AS dataset, var AS variant, arg_max(struct_pack(
    cid := replace(data_href, 'ipfs://', ''), box := [-edge, -edge / 2, edge, edge / 2], moment := CAST(began AS TIMESTAMP)), ord) AS x
  FROM left_items GROUP BY 1, 2, 3
  UNION ALL SELECT DISTINCT collection, 'planned', CAST(NULL AS VARCHAR), CAST(NULL AS STRUCT(cid VARCHAR, box DOUBLE[], moment TIMESTAMP)) FROM items)
, right_items AS (
  SELECT *, CASE WHEN ord % 97 = 0 THEN 'esa_extra' ELSE collection END AS col, CAST(ord % 90 AS DOUBLE) AS edge,
    CAST(concat('20', CAST(10 + ord % 10 AS VARCHAR(20)), '-01-01T00:00:00Z') AS TIMESTAMP)
      + CASE WHEN ord % 41 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS moment
  FROM items WHERE collection NOT LIKE '%5')
, r AS (
  SELECT col AS collection, dataset, variant, arg_max(struct_pack(
    cid := CASE WHEN ord % 11 <> 0 THEN 'bafy' || ord END,
    box := [-edge, -edge / 2, edge + CASE WHEN ord % 37 = 0 THEN 1 ELSE 0 END, edge / 2], moment := moment), ord) AS x
  FROM right_items GROUP BY 1, 2, 3)
, lc AS (SELECT collection, CASE WHEN min(observation) = max(observation) THEN min(observation) END AS category FROM items GROUP BY 1)
, rc AS (SELECT col AS collection, CASE WHEN min(observation) = max(observation) THEN min(observation) END AS category FROM right_items GROUP BY 1)
"""
)


def two_listings(spark, sf_dir):
    """The tree form and the search form of the items."""
    items = fixture(spark, sf_dir, "items")
    edge = (F.col("ord") % 90).cast("double")
    began = F.concat(F.lit("20"), (10 + F.col("ord") % 10).cast("string"), F.lit("-01-01T00:00:00"))
    tree = items.select(
        "ord", "collection", "id", "data_href", F.array(-edge, -edge / 2, edge, edge / 2).alias("bbox"),
        F.concat(began, F.lit("Z")).alias("datetime"),
    )
    observed = F.when(F.min("observation") == F.max("observation"), F.min("observation"))
    collections = items.groupBy("collection").agg(observed.alias("category")).select(
        "collection", org_from_collection(F.col("collection")).alias("organization"),
        F.concat(F.lit("About "), "collection").alias("title"), "category",
    )
    planned = collections.select("collection", F.lit("planned").alias("dataset"))
    left = list_datasets(tree, collections, planned)

    late = F.date_add(F.to_date(F.substring(began, 1, 10)), F.when(F.col("ord") % 41 == 0, 1).otherwise(0))
    search = items.where(~F.col("collection").endswith("5")).select(
        "ord",
        F.when(F.col("ord") % 97 == 0, "esa_extra").otherwise(F.col("collection")).alias("collection"),
        "id",
        F.col("dataset").alias("dataset_id"),
        "variant",
        "observation",
        F.when(F.col("ord") % 11 != 0, F.concat(F.lit("ipfs://bafy"), F.col("ord"))).alias("latest_cid"),
        F.array(-edge, -edge / 2, edge + F.when(F.col("ord") % 37 == 0, 1).otherwise(0), edge / 2).alias("bbox"),
        F.concat(late.cast("string"), F.lit("T02:00:00+02:00")).alias("start_datetime"),  # midnight in another zone
        F.concat(late.cast("string"), F.lit("T00:00:00.000Z")).alias("end_datetime"),
    )
    titles = search.select("collection").distinct().select(
        "collection",
        F.concat(F.when(F.col("collection").endswith("2"), "Of ").otherwise("About "), "collection").alias("title"),
    )
    return left, list_datasets_api(search, titles)


@query(
    "catalog_parity",
    _TWO_FORMS
    + """
SELECT collection, dataset, variant, presence, same_cid, same_bbox, same_extent, same_organization, same_title, same_category FROM (
SELECT coalesce(l.collection, r.collection) AS collection, coalesce(l.dataset, r.dataset) AS dataset,
  coalesce(l.variant, r.variant) AS variant,
  CASE WHEN r.collection IS NULL THEN 'left_only' WHEN l.collection IS NULL THEN 'right_only' ELSE 'both' END AS presence,
  l.x.cid IS NOT DISTINCT FROM r.x.cid AS same_cid, l.x.box IS NOT DISTINCT FROM r.x.box AS same_bbox,
  l.x.moment IS NOT DISTINCT FROM r.x.moment AS same_extent, presence = 'both' AS same_organization,
  presence = 'both' AND l.collection NOT LIKE '%2' AS same_title,
  lc.category IS NOT DISTINCT FROM rc.category AS same_category
FROM l FULL OUTER JOIN r ON l.collection = r.collection AND l.dataset = r.dataset AND l.variant = r.variant
LEFT JOIN lc ON lc.collection = l.collection LEFT JOIN rc ON rc.collection = r.collection)
WHERE presence <> 'both' OR NOT (same_cid AND same_bbox AND same_extent AND same_organization AND same_title AND same_category)""",
)
def catalog_parity_query(spark, sf_dir):
    return catalog_parity(*two_listings(spark, sf_dir))


_LEVELS = " UNION ALL ".join(
    f"""SELECT '{level}' AS level, {keys}, only_in FROM (
  SELECT DISTINCT {distinct}, 'left' AS only_in FROM l WHERE ({distinct_key}) NOT IN (SELECT ({distinct_key}) FROM r)
  UNION ALL SELECT DISTINCT {distinct}, 'right' FROM r WHERE ({distinct_key}) NOT IN (SELECT ({distinct_key}) FROM l))"""
    for level, keys, distinct, distinct_key in (
        ("collection", "collection, NULL AS dataset, NULL AS variant", "collection", "collection"),
        ("dataset", "collection, dataset, NULL AS variant", "collection, dataset", "collection, dataset"),
        ("variant", "collection, dataset, variant", "collection, dataset, variant", "collection, dataset, coalesce(variant, '')"),
    )
)


@query("catalog_set_differences", _TWO_FORMS + _LEVELS)
def catalog_set_differences_query(spark, sf_dir):
    """Collections, datasets and variants that only one form has."""
    return catalog_set_differences(*two_listings(spark, sf_dir))


@query(
    "catalog_key_differences",
    ctes("items")
    + _PARSED
    + """
SELECT DISTINCT collection, dataset, variant, 'right' AS only_in FROM items
WHERE (collection, dataset, variant) NOT IN
  (SELECT (collection, ds, var) FROM parsed WHERE data_href IS NOT NULL)""",
)
def catalog_key_differences_query(spark, sf_dir):
    search = fixture(spark, sf_dir, "items").withColumnRenamed("dataset", "dataset_id")
    return catalog_key_differences(list_datasets(items_of(spark, sf_dir)), list_datasets_api(search))


# --- resolution --------------------------------------------------------------

_RANK = """CASE var WHEN 'default' THEN 0 WHEN 'final' THEN 1 WHEN 'finalized' THEN 2 WHEN 'latest' THEN 3 END"""


def _resolution_sql(requests: str, items: str, first_match: bool) -> str:
    """Outcome of ``q`` (request_id, collection, dataset, variant,
    organization_id, collection_id) against ``i`` (collection, ds, var, shown)."""
    fallback = "list_min(opts_first)" if first_match else "CASE WHEN n = 1 THEN list_min(opts_first) END"
    return f"""
, q AS ({requests})
, i AS ({items})
, m AS (
  SELECT q.*,
    count(i.ord) AS n,
    list(struct_pack(r := {_RANK}, o := ord)) FILTER ({_RANK} IS NOT NULL) AS opts_rank,
    list(ord) FILTER (ord IS NOT NULL) AS opts_first,
    min(ord) FILTER (i.var = q.variant) AS exact
  FROM q LEFT JOIN i ON i.collection = q.collection_id AND i.ds = q.dataset
  GROUP BY ALL)
, chosen AS (
  SELECT *, CASE WHEN variant IS NOT NULL THEN exact
    ELSE coalesce(list_min(opts_rank).o, {fallback}) END AS pick FROM m)
, outcome AS (
  SELECT c.request_id, c.collection, c.dataset, c.variant, c.organization_id, c.collection_id,
    CASE WHEN c.organization_id IS NULL THEN 'organization_not_found'
      WHEN c.collection_id IS NULL THEN 'collection_not_found' WHEN n = 0 THEN 'dataset_not_found'
      WHEN pick IS NULL AND c.variant IS NOT NULL THEN 'variant_not_found'
      WHEN pick IS NULL THEN 'ambiguous_variant'
      WHEN i.data_href IS NULL THEN 'no_data_asset' ELSE 'ok' END AS status,
    i.shown AS resolved_variant, i.id AS item_id, replace(i.data_href, 'ipfs://', '') AS cid
  FROM chosen c LEFT JOIN i ON i.ord = c.pick)
"""


_TREE_ITEMS = "SELECT collection, ds, var, var AS shown, ord, id, data_href FROM parsed"
_SEARCH_ITEMS = """SELECT coalesce(collection, split_part(id, '-', 1)) AS collection, coalesce(dataset_id, ds) AS ds,
  variant AS var, coalesce(variant, 'default') AS shown, ord, id, data_href
  FROM (SELECT *, split_part(id, '-', 2) AS ds FROM search_items)"""
_PLACED = """SELECT request_id, collection, dataset, variant, split_part(collection, '_', 1) AS organization_id,
  collection AS collection_id FROM requests"""


def _placed(spark, sf_dir):
    requests = fixture(spark, sf_dir, "requests")
    return requests.select(
        "*",
        org_from_collection(F.col("collection")).alias("organization_id"),
        F.col("collection").alias("collection_id"),
    )


@query(
    "pick_variant",
    ctes("items", "requests") + _PARSED + _resolution_sql(_PLACED, _TREE_ITEMS, False) + "SELECT * FROM outcome",
)
def pick_variant_query(spark, sf_dir):
    return pick_variant(_placed(spark, sf_dir), items_of(spark, sf_dir))


@query(
    "pick_variant_api",
    ctes("search_items", "requests") + _resolution_sql(_PLACED, _SEARCH_ITEMS, True) + "SELECT * FROM outcome",
)
def pick_variant_api_query(spark, sf_dir):
    return pick_variant_api(_placed(spark, sf_dir), search_items_of(spark, sf_dir))


_ORG_PLACED = """
SELECT r.request_id, r.collection, r.dataset, r.variant, r.organization_id, c.collection AS collection_id
FROM (SELECT *, coalesce(organization,
    CASE WHEN collection IN (SELECT collection FROM items) THEN split_part(collection, '_', 1)
      ELSE (SELECT min(split_part(i.collection, '_', 1)) FROM items i
            WHERE split_part(i.collection, '_', 2) = org_requests.collection) END) AS organization_id
  FROM org_requests) r
LEFT JOIN (SELECT DISTINCT collection FROM items) c
  ON c.collection = CASE WHEN starts_with(r.collection, r.organization_id || '_') THEN r.collection
    WHEN r.organization IS NOT NULL THEN r.organization_id || '_' || r.collection
    WHEN r.collection IN (SELECT collection FROM items) THEN r.collection
    ELSE r.organization_id || '_' || r.collection END"""


def _declared(spark, sf_dir):
    """Organizations in alphabetical order, each declaring its collections."""
    names = items_of(spark, sf_dir).select("collection").distinct()
    org = org_from_collection(F.col("collection"))
    return names.select(org.alias("organization_id"), org.alias("org_ord"), "collection")


@query(
    "resolve_datasets",
    ctes("items", "org_requests")
    + _PARSED
    + _resolution_sql(_ORG_PLACED, _TREE_ITEMS, False)
    + "SELECT * FROM outcome",
)
def resolve_datasets_query(spark, sf_dir):
    requests = fixture(spark, sf_dir, "org_requests")
    return resolve_datasets(requests, items_of(spark, sf_dir), declared=_declared(spark, sf_dir))


@query(
    "org_resolve_join",
    ctes("items", "org_requests") + f", placed AS ({_ORG_PLACED}) SELECT request_id, organization_id FROM placed",
)
def org_resolve_query(spark, sf_dir):
    found = org_resolve(fixture(spark, sf_dir, "org_requests"), _declared(spark, sf_dir))
    return found.select("request_id", "organization_id")


@query(
    "resolve_collections",
    ctes("items", "org_requests")
    + f", placed AS ({_ORG_PLACED}) SELECT request_id, organization_id, collection_id FROM placed",
)
def resolve_collections_query(spark, sf_dir):
    tree = tree_of(spark, sf_dir)
    placed = resolve_collections(fixture(spark, sf_dir, "org_requests"), tree.collections, tree.declared)
    return placed.select("request_id", "organization_id", "collection_id")


@query(
    "resolve_datasets_api",
    ctes("search_items", "requests") + _resolution_sql(_PLACED, _SEARCH_ITEMS, True) + "SELECT * FROM outcome",
)
def resolve_datasets_api_query(spark, sf_dir):
    return resolve_datasets_api(fixture(spark, sf_dir, "requests"), search_items_of(spark, sf_dir))


@query(
    "resolve_join",
    ctes("items", "requests")
    + _PARSED
    + """SELECT request_id, r.collection, r.dataset, count(p.ord) AS n_items FROM requests r
LEFT JOIN parsed p ON p.collection = r.collection AND p.ds = r.dataset GROUP BY 1, 2, 3""",
)
def resolve_join_query(spark, sf_dir):
    return resolve_join(fixture(spark, sf_dir, "requests"), items_of(spark, sf_dir))


@query(
    "available_datasets",
    ctes("items", "requests")
    + _PARSED
    + _resolution_sql(_PLACED, _TREE_ITEMS, False)
    + """SELECT DISTINCT collection, ds AS dataset FROM parsed
WHERE collection IN (SELECT collection_id FROM outcome WHERE status = 'dataset_not_found')""",
)
def available_datasets_query(spark, sf_dir):
    """What could have been asked for, where a dataset was not found."""
    items = items_of(spark, sf_dir)
    failed = pick_variant(_placed(spark, sf_dir), items).where(F.col("status") == DATASET_NOT_FOUND)
    asked = failed.select(F.col("collection_id").alias("collection")).distinct()
    return available_datasets(items).join(asked, "collection", "left_semi")


# --- tree walk ---------------------------------------------------------------

_READABLE = "ord % 23 <> 0 AND ord % 29 <> 0"


@query(
    "catalog_walk",
    ctes("items")
    + f"""SELECT collection, split_part(collection, '_', 1) AS organization, id, data_href, dataset AS dataset_id,
  variant, observation,
  CASE WHEN ord % 13 <> 0 AND ord % 5 = 0 THEN CAST(ord % 4 AS DOUBLE) END AS concat_priority,
  CASE WHEN ord % 2 = 0 THEN 'step' END AS concat_dimension
FROM items WHERE {_READABLE}""",
)
def catalog_walk_query(spark, sf_dir):
    return tree_of(spark, sf_dir).items.select(
        "collection",
        "organization",
        "id",
        "data_href",
        "dataset_id",
        "variant",
        "observation",
        "concat_priority",
        "concat_dimension",
    )


@query(
    "catalog_refresh",
    ctes("items")
    + f"""SELECT collection, id, replace(variant, 'finalized', 'patched') AS variant, data_href
FROM items WHERE {_READABLE} AND ord % 10 <> 3""",
)
def catalog_refresh_query(spark, sf_dir):
    """The items of a kept catalog after an edit: some documents gone, some changed, the others not read again."""
    docs = documents(spark, sf_dir)
    store = CatalogStore(spark, f"{shared_dir(spark)}/nodes-{uuid.uuid4()}", KEYS)
    store.refresh(docs)
    item = F.col("href").startswith("ipfs://item-")
    gone = item & F.col("href").endswith("3")
    edited = docs.where(~gone).withColumn("body", F.when(item, F.regexp_replace("body", '(variant":"[a-z_]*)finalized', "$1patched")).otherwise(F.col("body")))
    store.refresh(edited)
    return store.walk(ROOT).items.select("collection", "id", "variant", "data_href")


@query(
    "walk_join",
    ctes("items")
    + """SELECT collection, split_part(collection, '_', 1) AS organization_id,
  'ipfs://item-' || ord AS target, id FROM items""",
)
def walk_join_query(spark, sf_dir):
    """Item links reached through root, organization and collection."""
    return tree_of(spark, sf_dir).item_links.select("collection", "organization_id", "target", "id")


@query(
    "catalog_broken_links",
    ctes("items")
    + f"""SELECT 'item' AS level, 'ipfs://collection-' || collection AS parent_href, 'ipfs://item-' || ord AS href
FROM items WHERE NOT ({_READABLE})
UNION ALL SELECT DISTINCT 'collection', 'ipfs://org-' || split_part(collection, '_', 1),
  'ipfs://collection-gone-' || split_part(collection, '_', 1) FROM items
UNION ALL SELECT 'organization', 'ipfs://root', 'ipfs://org-gone'""",
)
def catalog_broken_links_query(spark, sf_dir):
    return tree_of(spark, sf_dir).broken_links


@query(
    "collection_category_link",
    ctes("items")
    + """SELECT DISTINCT split_part(collection, '_', 1) AS organization_id, collection,
  CASE WHEN CAST(regexp_extract(collection, '[0-9]+$') AS INT) % 2 = 1 THEN 'historical' ELSE 'forecast' END AS category
FROM items""",
)
def collection_category_link_query(spark, sf_dir):
    return tree_of(spark, sf_dir).categories


@query(
    "declared_datasets",
    ctes("items")
    + """SELECT DISTINCT split_part(collection, '_', 1) AS organization_id, collection,
  unnest([dataset, 'planned']) AS dataset FROM items""",
)
def declared_datasets_query(spark, sf_dir):
    return tree_of(spark, sf_dir).declared_datasets


@query(
    "list_datasets_tree",
    ctes("items")
    + _PARSED
    + f"""
, found AS (SELECT collection, ds AS dataset, var AS variant, replace(data_href, 'ipfs://', '') AS cid
  FROM parsed WHERE data_href IS NOT NULL AND {_READABLE})
, every AS (SELECT * FROM found
  UNION ALL SELECT DISTINCT collection, d, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
  FROM (SELECT collection, unnest([dataset, 'planned']) AS d FROM items)
  WHERE (collection, d) NOT IN (SELECT (collection, dataset) FROM found))
SELECT *, split_part(collection, '_', 1) AS organization, 'About ' || collection AS title,
  CASE WHEN CAST(regexp_extract(collection, '[0-9]+$') AS INT) % 2 = 1 THEN 'historical' ELSE 'forecast' END AS category
FROM every""",
)
def list_datasets_tree_query(spark, sf_dir):
    """Listing of the walked tree, with declared datasets that have no item."""
    tree = tree_of(spark, sf_dir)
    listing = list_datasets(tree.items, tree.collections, tree.declared_datasets)
    return listing.select("collection", "dataset", "variant", "cid", "organization", "title", "category")


@query(
    "link_meta_join",
    ctes("items")
    + f"""
, links AS (SELECT collection, id, min(ord) AS o FROM items GROUP BY 1, 2)
SELECT i.collection, i.id, data_href,
  coalesce(CASE WHEN i.ord % 13 <> 0 AND i.ord % 5 = 0 THEN CAST(i.ord % 4 AS DOUBLE) END,
           CASE WHEN o % 3 = 0 THEN CAST(o % 7 AS DOUBLE) END) AS concat_priority,
  CASE WHEN i.ord % 2 = 0 THEN 'step' END AS concat_dimension
FROM items i JOIN links USING (collection, id) WHERE i.ord % 23 <> 0 AND i.ord % 29 <> 0""",
)
def link_meta_query(spark, sf_dir):
    tree = tree_of(spark, sf_dir)
    return link_meta_join(tree.items, tree.item_links).select(
        "collection", "id", "data_href", "concat_priority", "concat_dimension"
    )


@query(
    "concatenable_items",
    ctes("items")
    + _PARSED
    + """SELECT collection, ds AS dataset, var AS variant, replace(data_href, 'ipfs://', '') AS cid,
  CAST(coalesce(concat_priority, 0) AS DOUBLE) AS concat_priority, 'time' AS concat_dimension, ord
FROM parsed WHERE data_href IS NOT NULL""",
)
def concatenable_query(spark, sf_dir):
    return concatenable_items(fixture(spark, sf_dir, "items").drop("dataset", "variant"))


# --- end to end --------------------------------------------------------------

_FIRST = """(SELECT 'bafy' || min(ord) FROM items
  WHERE (collection, dataset, variant) = (SELECT (collection, dataset, variant) FROM items WHERE ord = 1))"""


def engine_of(spark, sf_dir, **kw) -> GridEngine:
    items = fixture(spark, sf_dir, "items").drop("dataset", "variant", "observation")
    return GridEngine(spark, items, CellTable(fixture(spark, sf_dir, "item_cells")), **kw)


def first_request(spark, sf_dir) -> DatasetRequest:
    """A request for whatever the second catalog item holds."""
    row = fixture(spark, sf_dir, "items").where(F.col("ord") == 1).first()
    organization, collection = row.collection.split("_")
    return DatasetRequest(row.dataset, collection, row.variant, organization)


@query(
    "load_dataset",
    ctes("items", "item_cells")
    + f"SELECT latitude, longitude, time, precipitation, temperature, cid FROM item_cells WHERE cid = {_FIRST}",
)
def load_dataset_query(spark, sf_dir):
    ds = engine_of(spark, sf_dir).load_dataset(first_request(spark, sf_dir))
    return ds.df.withColumn("cid", F.lit(ds.info.cid))


@query(
    "info",
    ctes("items", "item_cells")
    + f"""SELECT any_value(collection) AS collection, any_value(dataset) AS dataset, any_value(variant) AS variant,
  any_value(split_part(collection, '_', 1)) AS organization,
  any_value(concat(collection, '-', dataset, '-', variant)) AS path, {_FIRST} AS cid, 'stac' AS source,
  (SELECT count(*) FROM item_cells WHERE cid = {_FIRST} AND latitude BETWEEN 0 AND 90
    AND longitude BETWEEN -180 AND 180) AS cells
FROM items WHERE ord = 1""",
)
def info_query(spark, sf_dir):
    """Lineage as it stands after a selection."""
    ds = engine_of(spark, sf_dir).load_dataset(first_request(spark, sf_dir)).rectangle(0, -180, 90, 180)
    fields = ("collection", "dataset", "variant", "organization", "path", "cid", "source")
    lineage = [F.lit(getattr(ds.info, f)).alias(f) for f in fields]
    return ds.df.agg(F.count("*").alias("cells")).select(*lineage, "cells")


@query(
    "select_dataset",
    ctes("items", "item_cells")
    + f"""SELECT latitude, longitude, time, precipitation AS value FROM item_cells WHERE cid = {_FIRST}
  AND latitude BETWEEN -60 AND 80 AND longitude BETWEEN -150 AND 120
  AND time BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2000-12-31'""",
)
def select_dataset_query(spark, sf_dir):
    picked = engine_of(spark, sf_dir).select_dataset(
        first_request(spark, sf_dir),
        bounds=(-150, -60, 120, 80),
        time_range=("1995-06-01", "2000-12-31"),
    )
    return picked.to_records("precipitation")


@query(
    "load_many",
    ctes("items", "org_requests", "item_cells")
    + _PARSED
    + _resolution_sql(_ORG_PLACED, _TREE_ITEMS, False)
    + """SELECT request_id, resolved_variant AS variant, c.* FROM outcome JOIN item_cells c USING (cid)
WHERE status = 'ok'""",
)
def load_many_query(spark, sf_dir):
    """Every request at once: resolution and cells in one plan."""
    engine = engine_of(spark, sf_dir, declared=_declared(spark, sf_dir))
    return engine.load_many(fixture(spark, sf_dir, "org_requests"))


@query(
    "auto_concatenate",
    ctes("items", "item_cells")
    + _PARSED
    + """
, listed AS (
  SELECT collection, ds AS dataset, var AS variant, replace(data_href, 'ipfs://', '') AS cid,
    coalesce(concat_priority, 0) AS p, ord
  FROM parsed WHERE data_href IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY collection, ds) > 1)
, ends AS (SELECT cid, max(time) AS last FROM item_cells GROUP BY cid)
, cut AS (
  SELECT listed.*, max(last) OVER (PARTITION BY collection, dataset ORDER BY p, ord
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cutoff
  FROM listed JOIN ends USING (cid))
SELECT collection, dataset, variant, CAST(p AS DOUBLE) AS concat_priority, cid,
  latitude, longitude, time, precipitation, temperature
FROM cut JOIN item_cells USING (cid) WHERE cutoff IS NULL OR time > cutoff""",
)
def auto_concatenate_query(spark, sf_dir):
    """Every dataset with several variants, joined into one series each."""
    return engine_of(spark, sf_dir).auto_concatenate_many()


@query(
    "read_cells",
    ctes("cube")
    + """SELECT latitude, longitude, time, precipitation, temperature FROM cube
WHERE latitude BETWEEN -30 AND 30 AND longitude BETWEEN -60 AND 60
  AND time BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31'""",
)
def read_cells_query(spark, sf_dir):
    """Through the Parquet store: year directories and row groups are pruned."""
    cells = fixture(spark, sf_dir, "cube").withColumn("cid", F.lit("bafycube"))
    root = f"{shared_dir(spark)}/store-{uuid.uuid4()}"
    write_cells(cells, root)
    ds = GridDataset(CellStore(spark, root).read("bafycube"), DatasetMetadata(cid="bafycube"))
    picked = ds.time_range("1997-01-01", "1998-12-31").rectangle(-30, -60, 30, 60)
    return picked.df.select(*picked.dims, *picked.variables)


# --- names and properties ----------------------------------------------------


@query(
    "parse_item_id",
    ctes("items")
    + _PARSED
    + """SELECT ord, ds AS dataset_prefix, var AS variant_prefix, split_part(id, '-', 1) AS collection_split,
  ds AS dataset_split, var AS variant_split FROM parsed""",
)
def parse_item_id_query(spark, sf_dir):
    item, collection = F.col("id"), F.col("collection")
    return items_of(spark, sf_dir).select(
        "ord",
        dataset_by_prefix(item, collection).alias("dataset_prefix"),
        variant_by_prefix(item, collection).alias("variant_prefix"),
        collection_by_split(item).alias("collection_split"),
        dataset_by_split(item).alias("dataset_split"),
        variant_by_split(item).alias("variant_split"),
    )


@query(
    "normalize_segment",
    r"""SELECT p_partkey, regexp_replace(lower(trim(concat(' ', p_name, '  ', p_brand, ' '))), '\s+', '_', 'g') AS segment
FROM part""",
)
def normalize_segment_query(spark, sf_dir):
    text = F.concat(F.lit(" \t"), "p_name", F.lit(" \n "), "p_brand", F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", normalize_segment(text).alias("segment"))


@query(
    "resolve_ipfs_uri",
    ctes("items")
    + """SELECT ord, replace(data_href, 'ipfs://', '') AS cid,
  replace(data_href, 'ipfs://', 'https://gateway.example/ipfs/') AS url FROM items""",
)
def resolve_ipfs_query(spark, sf_dir):
    href = F.col("data_href")
    return items_of(spark, sf_dir).select(
        "ord", strip_ipfs(href).alias("cid"), resolve_ipfs_uri(href, "https://gateway.example").alias("url")
    )


@query(
    "qualify_collection",
    ctes("org_requests")
    + """SELECT request_id, CASE WHEN organization IS NULL OR starts_with(collection, organization || '_')
  THEN collection ELSE organization || '_' || collection END AS qualified,
  CASE WHEN contains(collection, '_') THEN split_part(collection, '_', 1) END AS organization_part
FROM org_requests""",
)
def qualify_collection_query(spark, sf_dir):
    collection, organization = F.col("collection"), F.col("organization")
    return fixture(spark, sf_dir, "org_requests").select(
        "request_id",
        qualify_collection(collection, organization).alias("qualified"),
        org_from_collection(collection).alias("organization_part"),
    )


@query(
    "dataset_path",
    ctes("items")
    + """SELECT ord, concat(collection, '-', dataset, CASE WHEN variant = 'default' THEN '' ELSE '-' || variant END) AS path
FROM items""",
)
def dataset_path_query(spark, sf_dir):
    variant = F.when(F.col("variant") != "default", F.col("variant")).otherwise("")
    return fixture(spark, sf_dir, "items").select(
        "ord", dataset_path(F.col("collection"), F.col("dataset"), variant).alias("path")
    )


@query(
    "typed_properties",
    """SELECT event_id, CAST(NULL AS VARCHAR) AS k_text, CAST(json_extract(props, '$.k') AS DOUBLE) AS k_number
FROM events""",
)
def typed_properties_query(spark, sf_dir):
    """The numeric ``k`` of each event is a number and no text."""
    props = F.from_json("props", "MAP<STRING, VARIANT>")
    return table(spark, sf_dir, "events").select(
        "event_id", string_prop(props, "k").alias("k_text"), number_prop(props, "k").alias("k_number")
    )


@query(
    "item_extent",
    ctes("search_items")
    + """SELECT ord, CASE WHEN ord % 4 <> 0 THEN -edge END AS west, CASE WHEN ord % 4 <> 0 THEN edge / 2 END AS north,
  coalesce(start_datetime, datetime) AS start, coalesce(end_datetime, datetime) AS "end",
  coalesce(start_datetime, end_datetime, datetime) IS NULL AS no_extent FROM search_items""",
)
def item_extent_query(spark, sf_dir):
    box = item_bbox(F.col("bbox"))
    when = item_time_extent(F.col("start_datetime"), F.col("end_datetime"), F.col("datetime"))
    return search_items_of(spark, sf_dir).select(
        "ord",
        F.get(box, 0).alias("west"),
        F.get(box, 3).alias("north"),
        when["start"].alias("start"),
        when["end"].alias("end"),
        when.isNull().alias("no_extent"),
    )


@query(
    "string_list",
    """SELECT doc_id, lang AS name FROM documents UNION ALL SELECT doc_id, source FROM documents""",
)
def string_list_query(spark, sf_dir):
    """Text elements of a mixed JSON array; the number in it is skipped."""
    names = F.to_json(F.array("lang", "source"))
    mixed = F.parse_json(F.concat(F.lit("["), F.col("n_chars"), F.lit(","), F.substring(names, 2, F.length(names))))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(string_list(mixed)).alias("name"))
