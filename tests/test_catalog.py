import json
import random

import pytest
from pyspark.sql import functions as F

from gridloom import CatalogKeys, StacLoadError, WriteConflictError
from gridloom.plans.concatenable import concatenable_items
from gridloom.plans.listing import (
    catalog_key_differences,
    catalog_parity,
    catalog_set_differences,
    list_datasets,
    list_datasets_api,
)
from gridloom.plans.resolution import resolve_datasets, resolve_datasets_api
from gridloom.plans.walk import catalog_walk, load_catalog
from gridloom.sources.commits import CommitLog
from gridloom.sources.nodes import CatalogStore
from tests.conftest import collected, plan_of

ITEM = (
    "ord long, collection string, id string, data_href string, dataset_id string, variant string,"
    " latest_cid string, observation string, start_datetime string, end_datetime string, datetime string,"
    " bbox array<double>"
)
REQUEST = "request_id long, collection string, dataset string, variant string, organization string"


def item(ord, id, collection=None, href="", **props):
    names = ("dataset_id", "variant", "latest_cid", "observation", "start_datetime", "end_datetime", "datetime", "bbox")
    href = f"ipfs://bafy{ord}" if href == "" else href
    return (ord, collection or id.split("-")[0], id, href, *[props.get(n) for n in names])


def resolved(spark, rows, *requests, api=False, **kw):
    items = spark.createDataFrame(rows, ITEM)
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(requests)], REQUEST)
    out = (resolve_datasets_api if api else resolve_datasets)(table, items, **kw)
    return [(r.status, r.cid, r.resolved_variant) for r in out.orderBy("request_id").collect()]


LAND = [
    item(1, "ecmwf_era5-precipitation_total_land-finalized", dataset_id="precipitation_total_land", variant="finalized"),
    item(2, "ecmwf_era5-precipitation_total-finalized", dataset_id="precipitation_total", variant="finalized"),
]


@pytest.mark.parametrize("api", [True, False])
def test_exact_dataset_match(spark, api):
    asked = ("ecmwf_era5", "precipitation_total", "finalized", None)
    assert resolved(spark, LAND, asked, api=api) == [("ok", "bafy2", "finalized")]
    assert resolved(spark, LAND[:1], asked, api=api) == [("dataset_not_found", None, None)]


def test_search_falls_back_to_the_item_id(spark):
    rows = [
        item(1, "ecmwf_era5-temperature_2m_land-finalized", variant="finalized"),
        item(2, "ecmwf_era5-temperature_2m-finalized", variant="finalized"),
    ]
    asked = ("ecmwf_era5", "temperature_2m", "finalized", None)
    assert resolved(spark, rows, asked, api=True) == [("ok", "bafy2", "finalized")]


TREE = [
    item(1, "ecmwf_era5-temp-b"),
    item(2, "ecmwf_era5-temp-finalized"),
    item(3, "ecmwf_era5-temp-latest"),
    item(4, "ecmwf_era5-wind-x"),
    item(5, "ecmwf_era5-rain-x"),
    item(6, "ecmwf_era5-rain-y"),
    item(7, "ecmwf_era5-snow", href=None),
    item(8, "noaa_gfs-temp-default"),
    item(9, "ecmwf_era5-temp-finalized"),
]


def test_statuses_and_variants(spark):
    got = resolved(
        spark,
        TREE,
        ("era5", "temp", None, "ecmwf"),
        ("ecmwf_era5", "temp", "b", None),
        ("era5", "temp", "b", None),
        ("ecmwf_era5", "wind", None, None),
        ("ecmwf_era5", "rain", None, None),
        ("ecmwf_era5", "snow", None, None),
        ("ecmwf_era5", "hail", None, None),
        ("ecmwf_era5", "temp", "zzz", None),
        ("nowhere", "temp", None, None),
        ("nowhere", "temp", None, "ecmwf"),
        ("ecmwf_era5", "temp", "", ""),
    )
    assert got == [
        ("ok", "bafy2", "finalized"),
        ("ok", "bafy1", "b"),
        ("ok", "bafy1", "b"),  # found through the declaring organization
        ("ok", "bafy4", "x"),
        ("ambiguous_variant", None, None),
        ("no_data_asset", None, "default"),
        ("dataset_not_found", None, None),
        ("variant_not_found", None, None),
        ("organization_not_found", None, None),
        ("collection_not_found", None, None),
        ("ok", "bafy2", "finalized"),
    ]


def test_search_takes_the_first_when_none_is_preferred(spark):
    rows = [item(5, "c_d-rain-x", dataset_id="rain", variant="x"), item(6, "c_d-rain-y", dataset_id="rain", variant="y")]
    unnamed = [item(7, "c_d-rain-z", dataset_id="rain"), *[(r[0] + 5, *r[1:]) for r in rows]]
    assert resolved(spark, rows, ("c_d", "rain", None, None), api=True) == [("ok", "bafy5", "x")]
    assert resolved(spark, unnamed, ("c_d", "rain", None, None), api=True) == [("ok", "bafy7", "default")]
    assert resolved(spark, unnamed, ("c_d", "rain", "z", None), api=True) == [("variant_not_found", None, None)]
    assert resolved(spark, [item(1, "c_d-a", href="")], ("c_d", "a", None, None), api=True)[0][0] == "ok"


def test_resolution_under_one_hot_key(spark):
    """A third of items and requests share a dataset; no pairs are formed."""
    items = spark.range(3000).selectExpr(
        "id AS ord", "CASE WHEN id >= 0 THEN 'o_c' END AS collection",
        "concat('o_c-', CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('d', id % 50) END, '-v', id) AS id",
        "concat('ipfs://b', id) AS data_href",
    )
    requests = spark.range(3000).selectExpr(
        "id AS request_id", "CASE WHEN id >= 0 THEN 'o_c' END AS collection",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'nothing' END AS dataset",
        "CASE WHEN id % 3 = 0 THEN concat('v', id) END AS variant",
    )
    out = resolve_datasets(requests, items)
    assert "NestedLoop" not in plan_of(out) and "CartesianProduct" not in plan_of(out)
    assert collected(out.groupBy("status").count()) == [("dataset_not_found", 2000), ("ok", 1000)]


# --- listings ----------------------------------------------------------------


def test_search_listing(spark):
    rows = [
        item(1, "org_c-a-v", dataset_id="a", variant="v", latest_cid="ipfs://x", observation="historical", datetime="2020-01-01T00:00:00Z"),
        item(2, "org_c-a-v", dataset_id="a", variant="v", latest_cid="y", observation="historical", bbox=[1.0, 2.0, 3.0, 4.0]),
        item(3, "org_c-b", observation="historical"),
        item(4, "plain-z", observation="forecast"),
        item(5, "plain-z-w", observation="historical"),
        item(6, "lonely", collection="org_c"),
    ]
    got = {(r.collection, r.dataset, r.variant): r for r in list_datasets_api(spark.createDataFrame(rows, ITEM)).collect()}
    assert set(got) == {("org_c", "a", "v"), ("org_c", "b", "default"), ("plain", "z", "default"), ("plain", "z", "w")}
    newest = got["org_c", "a", "v"]
    assert (newest.cid, newest.west, newest.north, newest.start, newest.position) == ("y", 1.0, 4.0, None, 1)
    assert (newest.organization, newest.category) == ("org", "historical")
    mixed = got["plain", "z", "w"]
    assert (mixed.organization, mixed.category, mixed.cid) == (None, None, None)


def test_tree_listing_keeps_declared_datasets(spark):
    items = spark.createDataFrame([item(1, "o_c-a-v"), item(2, "o_c-gone", href=None), item(3, "single", "o_c")], ITEM)
    collections = spark.createDataFrame([("o_c", "o", "Title", "historical")], "collection string, organization string, title string, category string")
    declared = spark.createDataFrame([("o_c", "a"), ("o_c", "soon"), ("unknown", "x")], "collection string, dataset string")
    got = list_datasets(items, collections, declared)
    assert collected(got.select("dataset", F.coalesce("variant", F.lit("-")), "title")) == [
        ("a", "v", "Title"),
        ("soon", "-", "Title"),
    ]


def test_parity(spark):
    base = [item(i, f"o_c-d{i}-v", dataset_id=f"d{i}", variant="v", latest_cid=f"ipfs://bafy{i}",
                 datetime="2020-01-01T00:00:00Z", bbox=[0.0, 0.0, 1.0, 1.0]) for i in range(4)]
    same = spark.createDataFrame(base, ITEM)
    # Millisecond spelling of the same instants must not count.
    other = same.withColumn("datetime", F.lit("2020-01-01T00:00:00.000Z"))
    assert catalog_parity(list_datasets(same), list_datasets_api(other)).count() == 0
    assert catalog_key_differences(list_datasets(same), list_datasets_api(other)).count() == 0
    changed = other.where("ord > 0").withColumn(
        "latest_cid", F.when(F.col("ord") == 2, "z").otherwise(F.col("latest_cid"))
    ).withColumn("bbox", F.when(F.col("ord") == 3, F.array(*map(F.lit, (0.0, 0.0, 9.0, 9.0)))).otherwise(F.col("bbox")))
    rows = {r.dataset: r for r in catalog_parity(list_datasets(same), list_datasets_api(changed)).collect()}
    assert set(rows) == {"d0", "d2", "d3"}
    assert rows["d0"].presence == "left_only"
    assert (rows["d2"].same_cid, rows["d2"].same_bbox) == (False, True)
    assert (rows["d3"].same_cid, rows["d3"].same_bbox) == (True, False)
    assert collected(catalog_key_differences(list_datasets(same), list_datasets_api(changed)), "dataset", "only_in") == [("d0", "left")]


def test_sets_and_datasets_without_items(spark):
    base = [item(i, f"o_c{i // 2}-d{i}-v", f"o_c{i // 2}", dataset_id=f"d{i}", variant="v", latest_cid=f"ipfs://bafy{i}") for i in range(4)]
    left_items, right_items = spark.createDataFrame(base[:3], ITEM), spark.createDataFrame(base[:2], ITEM)
    collections = spark.createDataFrame([("o_c0", "o", None, None), ("o_c1", "o", None, None)], "collection string, organization string, title string, category string")
    declared = spark.createDataFrame([("o_c0", "soon"), ("o_c1", "soon")], "collection string, dataset string")
    left, right = list_datasets(left_items, collections, declared), list_datasets_api(right_items)
    got = collected(catalog_set_differences(left, right).select("level", "collection", *[F.coalesce(c, F.lit("-")) for c in ("dataset", "variant")], "only_in"))
    assert got == [
        ("collection", "o_c1", "-", "-", "left"),
        ("dataset", "o_c0", "soon", "-", "left"),
        ("dataset", "o_c1", "d2", "-", "left"),
        ("dataset", "o_c1", "soon", "-", "left"),
        ("variant", "o_c0", "soon", "-", "left"),
        ("variant", "o_c1", "d2", "v", "left"),
        ("variant", "o_c1", "soon", "-", "left"),
    ]
    parity = {(r.dataset, r.variant): r.presence for r in catalog_parity(left, right).collect()}
    assert parity == {("soon", None): "left_only", ("d2", "v"): "left_only"} or len(parity) == 2
    assert catalog_parity(left, left).count() == 0 and catalog_set_differences(left, left).count() == 0
    assert catalog_key_differences(left, right).where("variant IS NULL").count() == 2


# --- tree walk ---------------------------------------------------------------


def tree_documents():
    def link(rel, href, **more):
        return {"rel": rel, "href": href, **more}

    return {
        "r": {"id": "root", "links": [
            link("self", "r"),
            link("child", "noid"),
            link("child", "o1", title="One", **{
                "x:id": "one",
                "x:collections:historical": ["one_a", 5],
                "x:collections:forecast": ["one_b"],
                "x:datasets": ["one_a/t", "one_a/u", "one_b/w", "slugless", 7],
            }),
            link("child", "o2", **{"x:id": "two", "x:collections": ["two_c"]}),
            link("child", "o3", **{"x:id": "three"}),
            link("child", "o4", **{"x:id": 4}),
        ]},
        "o1": {"id": "one", "links": [link("child", "c1"), link("child", "c2"), link("child", "c9")]},
        "o2": {"id": "two", "links": [link("child", "c3")]},
        "o3": {"id": "three"},
        "c1": {"id": "one_a", "title": "A", "links": [
            link("item", "i1", **{"x:id": "one_a-t-v", "x:concatPriority": 3, "x:concatDimension": "step"}),
            link("item", "i2", **{"x:id": "one_a-t-w", "x:concatPriority": "3"}),
            link("item", "i8"), link("item", "i9"), link("parent", "o1"),
        ]},
        "c2": {"id": "one_b", "links": []},
        "c3": {"id": "two_c", "links": [link("item", "i3")]},
        "i1": {"id": "one_a-t-v", "properties": {"x:variant": "v"}, "assets": {"data": {"href": "ipfs://1"}}},
        "i2": {"id": "one_a-t-w", "properties": {"x:variant": 9, "x:concatPriority": 1.5}, "assets": {"data": {"href": "ipfs://2"}}, "bbox": [1, 2, 3, 4]},
        "i3": {"id": "two_c-t", "properties": {}, "assets": {}},
    }


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(href, json.dumps(body)) for href, body in tree_documents().items()]
    return spark.createDataFrame([*rows, ("i8", '{"id": "cut')], "href string, body string")


def test_walk(docs):
    tree = catalog_walk(docs, "r", CatalogKeys("x"))
    assert collected(tree.items.select("collection", "id", F.coalesce("variant", F.lit("-")))) == [
        ("one_a", "one_a-t-v", "v"), ("one_a", "one_a-t-w", "-"), ("two_c", "two_c-t", "-"),
    ]
    assert collected(tree.collections.select("collection", "organization", F.coalesce("title", F.lit("-")), F.coalesce("category", F.lit("-")))) == [
        ("one_a", "one", "A", "historical"), ("one_b", "one", "-", "forecast"), ("two_c", "two", "-", "-"),
    ]
    assert collected(tree.declared, "organization_id", "collection") == [
        ("one", "one_a"), ("one", "one_b"), ("one", "slugless"), ("two", "two_c"),
    ]
    assert collected(tree.declared_datasets, "collection", "dataset") == [("one_a", "t"), ("one_a", "u"), ("one_b", "w")]
    assert collected(tree.broken_links) == [
        ("collection", "o1", "c9"), ("item", "c1", "i8"), ("item", "c1", "i9"), ("organization", "r", "o3"),
    ]


def test_walk_of_split_documents(spark, docs):
    """A collection document in two rows gives the same items in order."""
    body = tree_documents()["c1"]
    halves = [("c1", json.dumps({**body, "links": body["links"][i : i + 1]}), i) for i in range(5)]
    split = docs.where("href != 'c1'").withColumn("part", F.lit(0)).unionByName(
        spark.createDataFrame(halves, "href string, body string, part int")
    )
    key = CatalogKeys("x")
    got, want = (catalog_walk(d, "r", key).items.orderBy("ord").select("id").collect() for d in (split, docs))
    assert got == want


def test_walk_needs_its_root(docs):
    assert load_catalog(docs, "r", CatalogKeys("x")).organizations.count() == 2
    for root in ("nothing", "i8", "i1"):
        with pytest.raises(StacLoadError):
            load_catalog(docs, root)


def test_concatenation_metadata_falls_back_to_the_link(docs):
    tree = catalog_walk(docs, "r", CatalogKeys("x"))
    got = concatenable_items(tree.items, tree.item_links)
    assert collected(got, "variant", "cid", "concat_priority", "concat_dimension") == [
        ("v", "1", 3.0, "step"), ("w", "2", 1.5, "time"),
    ]


def test_resolution_through_the_walked_tree(spark, docs):
    tree = catalog_walk(docs, "r", CatalogKeys("x"))
    rows = [(0, "a", "t", "w", None), (1, "c", "t", None, "two"), (2, "b", "w", None, None), (3, "one_a", "t", None, None)]
    out = resolve_datasets(spark.createDataFrame(rows, REQUEST), tree.items, tree.collections, tree.declared)
    assert collected(out.select("request_id", "status", F.coalesce("collection_id", F.lit("-")))) == [
        (0, "ok", "one_a"), (1, "no_data_asset", "two_c"), (2, "dataset_not_found", "one_b"), (3, "ambiguous_variant", "one_a"),
    ]


# --- kept catalogs -----------------------------------------------------------

TABLES = ("organizations", "collections", "item_links", "items", "declared", "declared_datasets", "categories", "broken_links")


def all_rows(tree):
    return {t: sorted(map(repr, getattr(tree, t).collect())) for t in TABLES}


def test_kept_catalog_equals_a_full_walk_after_any_edits(spark, tmp_path):
    rng = random.Random(12)
    keys = CatalogKeys("x")
    store = CatalogStore(spark, str(tmp_path / "nodes"), keys)
    documents = {(href, 0): json.dumps(body) for href, body in tree_documents().items()}
    documents["i8", 0] = '{"id": "cut'
    held = {}
    for step in range(4):
        df = spark.createDataFrame([(h, p, b, "extra") for (h, p), b in documents.items()], "href string, part int, body string, hash string")
        got = store.refresh(df)
        differ = {k for k in documents.keys() | held.keys() if documents.get(k) != held.get(k)}
        assert {(r.href, r.part) for r in got.changes.collect()} == differ
        assert got.number == step + 1
        # Only what differs was parsed and written.
        batch = spark.read.parquet(f"{store.root}/nodes").join(CommitLog(spark, store.root).entries(), "token").where(F.col("number") == got.number)
        assert {(r.href, r.part): r.gone for r in batch.collect()} == {k: k not in documents for k in differ}
        assert all_rows(store.walk("r")) == all_rows(catalog_walk(df, "r", keys))
        held = dict(documents)
        links = tree_documents()["c1"]["links"]
        for _ in range(3):
            act = rng.randrange(5)
            name = rng.choice(["i1", "i2", "i3", "c2", "i9", "o1"])
            if act == 0:
                documents.pop((name, 0), None)
            elif act == 1:
                documents[name, 0] = json.dumps({"id": f"one_a-n{step}", "properties": {"x:variant": f"v{step}"}, "assets": {"data": {"href": f"ipfs://{step}"}}})
            elif act == 2:
                documents["c1", 0] = json.dumps({"id": "one_a", "title": f"T{step}", "links": rng.sample(links, 3)})
            elif act == 3:
                documents["c1", 1] = json.dumps({"id": "one_a", "links": rng.sample(links, 2)})
            else:
                documents[name, 0] = "no json"
        documents["i3", 0] = json.dumps({"id": f"two_c-t{step}", "properties": {}, "assets": {}})
    assert store.refresh(spark.createDataFrame([(h, p, b) for (h, p), b in held.items()], "href string, part int, body string")).number is None
    before = all_rows(store.walk("r"))
    store.compact()
    assert all_rows(store.walk("r")) == before and CommitLog(spark, store.root).entries().count() == 1
    assert store.refresh(spark.createDataFrame([], "href string, body string")).number == 6
    assert store.parsed().count() == 0


def test_repeated_and_nameless_documents(spark, tmp_path):
    store = CatalogStore(spark, str(tmp_path / "nodes"), CatalogKeys("x"))
    rows = [("a", '{"id": "1", "links": []}'), ("a", '{"id": "1", "links": []}'), (None, "{}"), ("b", None)]
    df = spark.createDataFrame(rows, "href string, body string")
    assert collected(store.refresh(df).changes) == [("a", 0, "inserted"), ("b", 0, "inserted")]
    assert store.refresh(df).number is None and store.parsed().count() == 2


def test_two_refreshes_at_once(spark, tmp_path, monkeypatch):
    store = CatalogStore(spark, str(tmp_path / "nodes"), CatalogKeys("x"))
    one, two = (spark.createDataFrame([(h, "{}")], "href string, body string") for h in "ab")
    append = CommitLog.append

    def late(self, number, token, mode):
        monkeypatch.setattr(CommitLog, "append", append)
        store.refresh(two)
        return append(self, number, token, mode)

    monkeypatch.setattr(CommitLog, "append", late)
    with pytest.raises(WriteConflictError):
        store.refresh(one)
    assert collected(store.hashes().select("href")) == [("b",)]
