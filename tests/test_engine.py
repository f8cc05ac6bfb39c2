import pytest
from pyspark.sql import functions as F

from gridloom import (
    CellStore,
    CellTable,
    DatasetNotFoundError,
    DatasetRequest,
    GridEngine,
    StacResolutionError,
    read_cells,
    write_cells,
)
from gridloom.sources.series import KeptSeries
from tests.conftest import collected, plan_of

ITEMS = [
    (0, "ecmwf_era5", "ecmwf_era5-temp-finalized", "ipfs://fin", 1.0),
    (1, "ecmwf_era5", "ecmwf_era5-temp-non_finalized", "ipfs://non", 2.0),
    (2, "ecmwf_era5", "ecmwf_era5-rain", "ipfs://rain", None),
    (3, "ecmwf_era5", "ecmwf_era5-wind-x", "ipfs://windx", None),
    (4, "ecmwf_era5", "ecmwf_era5-wind-y", "ipfs://windy", None),
]


def day(n):
    return f"2023-{1 + n // 28:02d}-{1 + n % 28:02d}"


@pytest.fixture(scope="module")
def cells(spark):
    rows = []
    for cid, first, last in (("fin", 0, 60), ("non", 50, 90), ("rain", 0, 10), ("windx", 0, 5), ("windy", 3, 8)):
        rows += [(cid, lat, lon, day(n), float(n), cid) for lat in (10.0, 10.5, 11.0) for lon in (20.0, 21.0) for n in range(first, last + 1)]
    df = spark.createDataFrame(rows, "cid string, latitude double, longitude double, time string, temperature double, origin string")
    return df.withColumn("time", F.col("time").cast("timestamp_ntz"))


@pytest.fixture(scope="module", params=["store", "table"])
def engine(request, spark, cells, tmp_path_factory):
    items = spark.createDataFrame(ITEMS, "ord long, collection string, id string, data_href string, concat_priority double")
    if request.param == "store":
        root = str(tmp_path_factory.mktemp("store") / "grids")
        write_cells(cells, root)
        return GridEngine(spark, items, CellStore(spark, root))
    return GridEngine(spark, items, CellTable(cells))


def ask(dataset=None, variant=None, collection="era5", organization="ecmwf", **kw):
    return DatasetRequest(dataset, collection, variant, organization, **kw)


def test_load_one_variant(engine):
    ds = engine.load_dataset(ask("temp", "finalized"))
    info = ds.info
    assert (info.path, info.collection, info.dataset, info.variant, info.organization, info.source, info.cid) == (
        "ecmwf_era5-temp-finalized", "ecmwf_era5", "temp", "finalized", "ecmwf", "stac", "fin",
    )
    assert ds.df.count() == 61 * 6 and info.concatenated_variants is None
    assert ds.variables == ["temperature", "origin"] and info.fetched_at is not None


def test_only_variant_is_taken(engine):
    assert engine.load_dataset(ask("rain")).info.variant == "default"


@pytest.mark.parametrize(
    "request_, status",
    [
        (ask("test", "test", collection="unknown"), "collection_not_found"),
        (ask("unknown", "test"), "dataset_not_found"),
        (ask("temp", "unknown"), "variant_not_found"),
        (ask("wind"), "ambiguous_variant"),
    ],
)
def test_failures(engine, request_, status):
    with pytest.raises(StacResolutionError) as error:
        engine.load_dataset(request_)
    assert error.value.status == status
    if status == "dataset_not_found":
        assert "rain, temp, wind" in str(error.value)
    if status == "ambiguous_variant":
        assert "x, y" in str(error.value)


def test_names_are_needed(engine):
    for bad in (ask(None), ask(""), ask("  ")):
        with pytest.raises(DatasetNotFoundError):
            engine.load_dataset(bad)


def test_direct_content_id(engine):
    ds = engine.load_dataset(DatasetRequest(cid="rain"))
    assert (ds.info.source, ds.info.cid, ds.info.path) == ("direct_cid", "rain", "")
    assert ds.df.count() == 66


def test_auto_concatenation(engine):
    def load():
        ds = engine.load_dataset(ask("temp"), auto_concatenate=True)
        rows = collected(ds.df.select("time", "origin").distinct())
        return ds, [o for _, o in rows]

    ds, origins = load()
    assert ds.variables == ["temperature", "origin"]
    assert origins == ["fin"] * 61 + ["non"] * 30
    assert ds.info.concatenated_variants == ("finalized", "non_finalized")
    assert (ds.info.source, ds.info.path, ds.info.variant) == ("stac_concatenated", "ecmwf_era5-temp", None)


def test_no_concatenation_when_not_asked_for(engine):
    assert engine.load_dataset(ask("temp")).info.variant == "finalized"
    assert engine.load_dataset(ask("temp", "non_finalized"), auto_concatenate=True).info.variant == "non_finalized"
    assert engine.load_dataset(ask("rain"), auto_concatenate=True).info.source == "stac"


def test_select_while_loading(engine):
    picked = engine.select_dataset(
        ask("temp", "finalized"),
        point={"latitude": 10.4, "longitude": 20.2},
        time_range=("2023-01-03", "2023-01-05"),
    )
    assert collected(picked.to_records("temperature"), "latitude", "longitude", "value") == [
        (10.5, 20.0, 2.0), (10.5, 20.0, 3.0), (10.5, 20.0, 4.0),
    ]
    assert picked.info.path == "ecmwf_era5-temp-finalized"


def test_search_resolver(spark, cells):
    rows = [(i, c, d, h, d.split("-")[1], "v" + str(i)) for i, c, d, h, _ in ITEMS]
    items = spark.createDataFrame(rows, "ord long, collection string, id string, data_href string, dataset_id string, variant string")
    engine = GridEngine(spark, items, CellTable(cells), resolver="api")
    assert engine.load_dataset(ask("wind")).info.variant == "v3"
    with pytest.raises(StacResolutionError):
        engine.load_dataset(ask("wind", "x"))
    with pytest.raises(ValueError):
        GridEngine(spark, items, None, resolver="guess")


def test_load_many(engine, spark):
    rows = [(0, "ecmwf_era5", "rain", None), (1, "ecmwf_era5", "rain", None), (2, "ecmwf_era5", "wind", "y"), (3, "ecmwf_era5", "nothing", None)]
    requests = spark.createDataFrame(rows, "request_id long, collection string, dataset string, variant string")
    got = engine.load_many(requests)
    assert collected(got.groupBy("request_id").count()) == [(0, 66), (1, 66), (2, 36)]


def test_concatenate_all(engine):
    got = engine.auto_concatenate_many()
    assert collected(got.groupBy("dataset", "variant").count()) == [
        ("temp", "finalized", 366), ("temp", "non_finalized", 180), ("wind", "x", 36), ("wind", "y", 18),
    ]


def test_series_follow_the_store(spark, cells, tmp_path):
    root = str(tmp_path / "grids")
    late = cells.where("cid = 'fin' AND time > '2023-02-10'")
    write_cells(cells.join(late, ["cid", "latitude", "longitude", "time"], "left_anti"), root)
    items = spark.createDataFrame(ITEMS, "ord long, collection string, id string, data_href string, concat_priority double")
    engine = GridEngine(spark, items, CellStore(spark, root))
    series = KeptSeries(spark, str(tmp_path / "series"))

    def same():
        columns = ["collection", "dataset", "variant", "latitude", "longitude", "time", "temperature", "origin"]
        assert collected(series.read(), *columns) == collected(engine.auto_concatenate_many(), *columns)

    seen = engine.update_series(series)
    same()
    write_cells(late, root, mode="append")
    assert engine.update_series(series, seen) == seen + 1
    same()
    write_cells(cells.where("cid = 'fin' AND time < '2023-01-20'"), root, mode="overwrite")
    assert engine.update_series(series, seen + 1) == seen + 2
    same()
    assert engine.update_series(series, seen + 2) == seen + 2 and series.read().count() > 0


def test_store_layout_prunes(spark, cells, tmp_path):
    root = str(tmp_path / "grids")
    late = cells.where("cid = 'fin'").withColumn("time", F.expr("time + INTERVAL '3' YEAR"))
    write_cells(cells.unionByName(late.withColumn("cid", F.lit("fin"))), root)
    assert "cell_year" not in CellStore(spark, root).table().columns
    engine = GridEngine(spark, None, CellStore(spark, root))
    ds = engine.load_dataset(DatasetRequest(cid="fin"))
    assert set(ds.axes) == {"latitude", "longitude", "time"} and "cell_year" not in ds.df.columns
    picked = ds.time_range("2026-01-01", "2026-01-02")
    plan = plan_of(picked.df)
    assert "PartitionFilters: [isnotnull(cell_year" in plan and picked.df.count() == 12
    near = ds.point(10.4, 20.2).df
    assert near.count() == 61 * 2
    assert "axes" in near._jdf.queryExecution().optimizedPlan().toString() or near.inputFiles() != []
    assert read_cells(spark, root, "rain").count() == 66
    with pytest.raises(ValueError):
        read_cells(spark, root, "")


def test_load_many_prunes_partitions(spark, cells, tmp_path):
    root = str(tmp_path / "grids")
    write_cells(cells, root)
    items = spark.createDataFrame(ITEMS, "ord long, collection string, id string, data_href string, concat_priority double")
    requests = spark.createDataFrame([(0, "ecmwf_era5", "rain")], "request_id long, collection string, dataset string")
    got = GridEngine(spark, items, CellStore(spark, root)).load_many(requests)
    assert "dynamicpruning" in plan_of(got).lower()
    assert got.count() == 66


def test_store_keeps_datasets_apart(spark, tmp_path):
    root = str(tmp_path / "grids")
    a = spark.createDataFrame([("007", 1.0, 5, 0.5), ("007", 2.0, 6, 0.25)], "cid string, lat double, level int, rain double")
    a = a.withMetadata("rain", {"units": "mm"})
    b = spark.createDataFrame([("7", 1.0, "x")], "cid string, lat double, name string")
    write_cells(a, root, dims=("lat", "level"))
    write_cells(b, root)
    store = CellStore(spark, root)
    ds = GridEngine(spark, None, store).load_dataset(DatasetRequest(cid="007"))
    assert ds.dims == ("lat", "level") and ds.variables == ["rain"] and ds.attrs("rain") == {"units": "mm"}
    assert collected(ds.to_records("rain")) == [(1.0, 5, 0.5), (2.0, 6, 0.25)]
    assert collected(store.table(), "cid", "lat", "rain", "name") == [("007", 1.0, 0.5, None), ("007", 2.0, 0.25, None), ("7", 1.0, None, "x")]
    assert collected(store.axis_table("level")) == [("007", 5), ("007", 6)]
    with pytest.raises(ValueError):
        write_cells(b, root)
    write_cells(b.withColumn("lat", F.lit(9.0)), root, mode="append")
    assert collected(store.read("7")) == [(1.0, "x"), (9.0, "x")]
    write_cells(b.withColumn("lat", F.lit(3.0)), root, mode="overwrite")
    assert collected(store.read("7")) == [(3.0, "x")] and store.read("007").count() == 2
    assert collected(store.open("7").axes["lat"]) == [(3.0,)]
    with pytest.raises(ValueError):
        store.read("gone")
    with pytest.raises(ValueError):
        write_cells(b.withColumn("cid", F.lit(None).cast("string")), root)


def test_search_resolver_takes_items_without_a_collection(spark, cells):
    rows = [(0, None, "e_c-t-v", "ipfs://rain", None, "v"), (1, "e_c", "e_c-t-w", "ipfs://fin", "t", "w")]
    items = spark.createDataFrame(rows, "ord long, collection string, id string, data_href string, dataset_id string, variant string")
    engine = GridEngine(spark, items, CellTable(cells), resolver="api")
    listed = collected(engine.list_available_datasets(), "collection", "dataset", "variant")
    assert listed == [("e_c", "t", "v"), ("e_c", "t", "w")]
    for _, dataset, variant in listed:
        assert engine.load_dataset(DatasetRequest(dataset, "c", variant, "e")).info.variant == variant
    with pytest.raises(StacResolutionError) as error:
        engine.load_dataset(DatasetRequest("t", "c", "z", "e"))
    assert "v, w" in str(error.value) and collected(error.value.available) == [("v",), ("w",)]


def test_search_first_then_tree(spark, cells):
    items = spark.createDataFrame(ITEMS, "ord long, collection string, id string, data_href string, concat_priority double")
    engine = GridEngine(spark, items, CellTable(cells), resolver="api_then_items")
    assert engine.load_dataset(ask("wind")).info.cid == "windx"  # the search takes the first
    assert engine.load_dataset(ask("wind", "y")).info.cid == "windy"  # the search knows no variants here
    assert engine.load_dataset(ask("temp", collection="era5", organization=None)).info.cid == "fin"


def many_variants(spark, n=40):
    """Variants of growing ends, one without cells, one without ends, one listed twice."""
    listed = [(k, "noaa_sst", f"noaa_sst-sst-v{k}", f"ipfs://c{k % (n - 1)}", None if k % 7 == 3 else float(k % 5)) for k in range(n)]
    items = spark.createDataFrame(listed, "ord long, collection string, id string, data_href string, concat_priority double")
    nan = float("nan")
    steps = {f"c{k}": [float(k + s) for s in range(3)] + ([nan] if k % 4 == 0 else []) for k in range(n)}
    steps |= {"c0": [nan, None], "c5": [], "c10": [nan]}
    rows = [(cid, 1.0, time, i) for cid, times in steps.items() for i, time in enumerate(times)]
    cells = spark.createDataFrame(rows, "cid string, latitude double, time double, value int")
    ordered = sorted(listed, key=lambda r: (r[4] is None and 0.0 or r[4] or 0.0))
    want, last = [], float("-inf")
    for at, item in enumerate(ordered):
        of = [r for r in rows if r[0] == item[3].removeprefix("ipfs://")]
        want += [r[1:] for r in of if at == 0 or (r[2] is not None and r[2] == r[2] and r[2] > last)]
        last = max([last, *(r[2] for r in of if r[2] is not None and r[2] == r[2])])
    return items, cells, want


def test_many_variants_of_one_table_are_read_together(spark):
    items, cells, want = many_variants(spark)
    ds = GridEngine(spark, items, CellTable(cells), resolver="api").load_dataset(
        DatasetRequest("sst", "noaa_sst"), auto_concatenate=True
    )
    assert ds.df.columns == ["latitude", "time", "value"]
    assert sorted(map(str, (tuple(r) for r in ds.df.collect()))) == sorted(map(str, want))
    assert len(ds.info.concatenated_variants) == 40
    assert plan_of(ds.df).count("Scan") <= 6


def test_strict_asks_for_cells_of_every_variant(spark):
    items, cells, _ = many_variants(spark)
    engine = GridEngine(spark, items, CellTable(cells), resolver="api", strict=True)
    with pytest.raises(ValueError, match="Variant v5 is empty along time"):
        engine.load_dataset(DatasetRequest("sst", "noaa_sst"), auto_concatenate=True)
