"""The store: files chosen by zones, commits in order, and what may be removed."""

import os
import random
import threading
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom import CellStore, DatasetRequest, GridDataset, GridEngine, WriteConflictError, vacuum, write_cells
from gridloom.sources import cells as cells_module
from gridloom.sources.commits import CommitLog
from tests.conftest import collected, plan_of


def grid(spark, cids, value=0.0, lats=36, days=40):
    """Cells of some datasets over the whole globe and two years."""
    rows = spark.createDataFrame([(c,) for c in cids], "cid string").crossJoin(
        spark.range(lats * 8).selectExpr(f"(id % {lats}) * {180 / lats} - 90D AS latitude", f"(id div {lats}) * 45D - 180 AS longitude")
    )
    times = spark.range(days).selectExpr("timestamp_ntz'2022-11-20' + make_dt_interval(id * 2) AS time")
    return rows.crossJoin(times).withColumn("value", F.lit(value) + F.col("latitude") * 1000 + F.dayofyear("time"))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store") / "grids")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        write_cells(grid(spark, ["a", "b/c d+e%é", "z"]), root)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return CellStore(spark, root)


def dataset(store, cid) -> GridDataset:
    return GridEngine(store.spark, None, store).load_dataset(DatasetRequest(cid=cid))


SELECTIONS = {
    "box": lambda ds: ds.rectangle(-40.0, -100.0, -20.0, 50.0),
    "circle": lambda ds: ds.circle(60.0, 175.0, 2500.0),
    "masked": lambda ds: ds.circle(60.0, 175.0, 2500.0, masked=True),
    "exact": lambda ds: ds.point(-40.0, 45.0, method="exact"),
    "times": lambda ds: ds.time_range("2022-12-28", "2022-12-10"),
    "all": lambda ds: ds.time_range("2023-01-01", "2023-02-01").rectangle(0.0, -180.0, 60.0, 0.0).circle(30.0, -90.0, 4000.0),
    "masked_then_box": lambda ds: ds.circle(60.0, 175.0, 2500.0, masked=True).rectangle(40.0, -200.0, 60.0, 200.0).time_range("2022-12-28", "2023-01-20"),
    "nearest_then_times": lambda ds: ds.point(11.0, 50.0).time_range("2022-12-28", "2023-01-20"),
    "box_then_nearest": lambda ds: ds.rectangle(-40.0, -100.0, -20.0, 50.0).point(80.0, 170.0),
    "nothing": lambda ds: ds.rectangle(1000.0, 1000.0, 1001.0, 1001.0),
}


@pytest.mark.parametrize("name, cid", [*((name, "a") for name in SELECTIONS), ("all", "b/c d+e%é")])
def test_selections_open_what_they_need(spark, store, cid, name):
    ds = dataset(store, cid)
    got = SELECTIONS[name](ds)
    want = SELECTIONS[name](GridDataset(ds.df, axes=ds.axes))
    assert collected(got.df) == collected(want.df)
    assert got.df.columns == want.df.columns
    whole, opened = len(ds.df.inputFiles()), len(got.df.inputFiles())
    if name in ("box", "circle", "exact", "times", "all"):
        assert 0 < opened <= whole * (0.7 if name == "times" else 0.5)
    if name == "nothing":
        assert opened == 0


def test_a_box_on_one_of_many_datasets_opens_only_its_files(spark, tmp_path):
    root = str(tmp_path / "many")
    write_cells(grid(spark, [f"d{k}" for k in range(40)], lats=4, days=10), root)
    store = CellStore(spark, root)
    held = store.files().groupBy("cid").count().count()
    assert held == 40
    chosen = store.files({"latitude": (-45, 0), "longitude": (0, 45)}, spark.createDataFrame([("d7",), ("gone",)], "cid string"))
    paths = {r.path for r in chosen.collect()}
    got = dataset(store, "d7").rectangle(-45.0, 0.0, 0.0, 45.0).df
    opened = got.inputFiles()
    assert len(opened) == len(paths) and all("cid=d7/" in f for f in opened)
    assert got.count() == 2 * 2 * 10
    assert {f.split("cid=")[1].split("/")[0] for f in store.table(spark.createDataFrame([("d3",)], "cid string")).inputFiles()} == {"d3"}


def test_files_tell_what_is_in_them(spark, store):
    rows = store.files().collect()
    assert sum(r.n for r in rows) == 3 * 36 * 8 * 40
    for r in random.Random(1).sample(rows, 5):
        cells = spark.read.parquet(f"{store.root}/{r.path}")
        low, high, first, n = cells.agg(F.min("latitude"), F.max("latitude"), F.min("time"), F.count("*")).first()
        assert (low, high, n) == (r.zones["latitude"]["low"], r.zones["latitude"]["high"], r.n)
        assert (first - datetime(1970, 1, 1)) / timedelta(microseconds=1) == r.zones["time"]["low"]


def test_odd_axes_have_zones_that_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "odd")
    rows = [("n", float("nan"), 1, date(2020, 1, 1), "x", 1.0), ("n", None, None, None, None, 2.0), ("n", 5.0, 2**60 + 1, date(2021, 1, 1), "y", 3.0)]
    df = spark.createDataFrame(rows, "cid string, latitude double, level long, time date, name string, v double")
    write_cells(df, root, dims=("latitude", "level", "time", "name"))
    store = CellStore(spark, root)
    ds = dataset(store, "n")
    assert ds.time_range("2020-12-31", "2021-06-01").df.select("v").collect() == [(3.0,)]
    assert store.files({"level": (2**60 + 1, None)}).count() >= 1
    assert store.files({"latitude": (4.0, 6.0), "time": (None, 0.0)}).count() == 0
    assert store.files({"name": (0.0, 1.0)}).count() == store.files().count()
    write_cells(spark.createDataFrame([("e",)], "cid string").withColumn("latitude", F.lit(None).cast("double")), root)
    assert store.files({"latitude": (-90, 90)}, spark.createDataFrame([("e",)], "cid string")).count() == 0


def test_emptiness_without_cells(spark, tmp_path):
    root = str(tmp_path / "empty")
    write_cells(spark.createDataFrame([("full", 1.0, 2.0), ("bare", 1.0, None)], "cid string, latitude double, v double"), root)
    write_cells(spark.createDataFrame([("axis", 1.0)], "cid string, latitude double"), root)
    wanted = spark.createDataFrame([(c, 7) for c in ("full", "bare", "axis", "gone", None, "full")], "cid string, cells int")
    got = CellStore(spark, root).emptiness(wanted)
    assert collected(got.select("cid", "is_empty", "is_dataset_empty").where("cid IS NOT NULL")) == [
        ("axis", False, True), ("bare", False, False), ("full", False, False), ("full", False, False), ("gone", True, True),
    ]
    assert got.where("cid IS NULL AND is_empty").count() == 1 and "cells/" not in str(got.inputFiles())


# --- commits -------------------------------------------------------------------


def one(spark, cid, value):
    return spark.createDataFrame([(cid, 1.0, float(value))], "cid string, latitude double, v double")


def meanwhile(monkeypatch, write):
    """Let another write finish between a write's files and its commit."""
    commit = cells_module._commit

    def late(*args):
        monkeypatch.setattr(cells_module, "_commit", commit)
        write()
        return commit(*args)

    monkeypatch.setattr(cells_module, "_commit", late)


@pytest.mark.parametrize(
    "mine, theirs, cid, fails",
    [
        ("errorifexists", "errorifexists", "x", True),
        ("overwrite", "overwrite", "x", True),
        ("overwrite", "append", "x", True),
        ("append", "overwrite", "x", True),
        ("append", "append", "x", False),
        ("errorifexists", "errorifexists", "other", False),
        ("overwrite", "append", "other", False),
    ],
)
def test_two_writers(spark, tmp_path, monkeypatch, mine, theirs, cid, fails):
    root = str(tmp_path / "grids")
    meanwhile(monkeypatch, lambda: write_cells(one(spark, cid, 1), root, mode=theirs))
    if fails:
        with pytest.raises(WriteConflictError):
            write_cells(one(spark, "x", 2), root, mode=mine)
        assert collected(CellStore(spark, root).table(), "cid", "v") == [("x", 1.0)]
    else:
        assert write_cells(one(spark, "x", 2), root, mode=mine) == 2
        assert collected(CellStore(spark, root).table(), "cid", "v") == sorted([(cid, 1.0), ("x", 2.0)])
    assert [r.number for r in CommitLog(spark, root).entries().orderBy("number").collect()] == ([1] if fails else [1, 2])


def test_the_order_needs_no_clock(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "grids")
    ticks = iter(range(10**9, 0, -1000))
    monkeypatch.setattr(time, "time", lambda: next(ticks))
    monkeypatch.setattr(time, "time_ns", lambda: next(ticks) * 10**9)
    for k in range(3):
        write_cells(one(spark, "x", k), root, mode="overwrite")
    assert collected(CellStore(spark, root).table(), "cid", "v") == [("x", 2.0)]


def test_a_number_is_taken_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "grids"))
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append(log.append(1, f"t{k}", "append"))) for k in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert won.count(True) == 1 and log.head() == 1 and log.entries().count() == 1
    assert [n for n in os.listdir(log.path) if not n.startswith(".")] == [f"{1:020d}.json"]


# --- vacuum --------------------------------------------------------------------


def test_vacuum_leaves_reads_as_they_are(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "grids")
    store = CellStore(spark, root)
    write_cells(one(spark, "a", 1).union(one(spark, "b", 1)), root)
    write_cells(one(spark, "a", 2), root, mode="overwrite")
    write_cells(one(spark, "b", 3), root, mode="append")
    write_cells(one(spark, "c/d", 4), root)
    write_cells(one(spark, "c/d", 5), root, mode="overwrite")

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(cells_module, "_commit", fail)
        with pytest.raises(RuntimeError):
            write_cells(one(spark, "lost", 6), root)
    assert len(os.listdir(f"{root}/cells")) == 6
    before = collected(store.table(), "cid", "v")
    assert before == [("a", 2.0), ("b", 1.0), ("b", 3.0), ("c/d", 5.0)]
    assert vacuum(spark, root) == 0  # all of it may still be in use
    assert vacuum(spark, root, retain_seconds=-10.0) > 0
    assert collected(store.table(), "cid", "v") == before
    assert collected(store.read("b")) == [(1.0, 1.0), (1.0, 3.0)] and collected(store.open("a").axes["latitude"]) == [(1.0,)]
    left = [sorted(os.listdir(f"{root}/cells/{t}")) for t in os.listdir(f"{root}/cells")]
    assert sorted(c for cids in left for c in cids if c.startswith("cid=")) == ["cid=a", "cid=b", "cid=b", "cid=c%2Fd"]
    assert vacuum(spark, root, retain_seconds=-10.0) == 0
    assert write_cells(one(spark, "e", 7), root) == 6
    with pytest.raises(ValueError):
        store.read("lost")


def test_plans_of_narrowed_reads_keep_their_filters(spark, store):
    picked = dataset(store, "a").rectangle(-40.0, -100.0, -20.0, 50.0).time_range("2022-12-28", "2023-01-20")
    plan = plan_of(picked.df)
    assert "PushedFilters" in plan and "GreaterThanOrEqual(latitude,-40.0)" in plan and "cell_year" in plan
