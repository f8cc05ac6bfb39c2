import math
import random

import pytest
from pyspark.sql import functions as F

from gridloom import DatasetMetadata, GridDataset, InvalidSelectionError, NoDataFoundError
from gridloom.functions import haversine_km
from gridloom.operators import introspect
from gridloom.operators.selection import circle, circle_box
from tests.conftest import collected, grid_rows, plan_of
from tests.test_functions import km


def values(ds, variable="precipitation"):
    return [r.value for r in ds.to_records(variable).orderBy("time").collect()]


# --- combined selections -----------------------------------------------------


def test_bounds_and_time_in_one_call(sample):
    picked = GridDataset(sample).select(
        bounds=[5, 50, 7, 51], time_range=("2023-01-01T00:00:00Z", "2023-01-04T00:00:00Z")
    )
    assert values(picked) == [4.25, 6.5]


def test_object_bounds_with_keys(sample):
    keys = {"latitude_key": "latitude", "longitude_key": "longitude"}
    bounds = {"west": 5, "south": 50, "east": 7, "north": 51, "options": keys}
    records = GridDataset(sample).select(bounds=bounds).to_records("precipitation").collect()
    assert len(records) == 3 and {r.longitude for r in records} == {6.01}


def test_point_and_bounds_are_exclusive(sample):
    with pytest.raises(InvalidSelectionError):
        GridDataset(sample).select(
            bounds=[5, 50, 7, 51], point={"latitude": 50.75, "longitude": 6.01}
        )


def test_point_and_week(sample):
    meta = DatasetMetadata(dataset="precipitation", path="a-b-c", variant="c")
    ds = GridDataset(sample, meta, strict=True)
    picked = ds.point(50.7, 6).time_range("2023-01-01T00:00:00Z", "2023-01-07T00:00:00Z")
    assert values(picked) == [4.25, 6.5, 3]
    assert picked.info is meta


def test_point_without_time_column_keeps_the_point(small_grid):
    ds = GridDataset(small_grid)
    picked = ds.select(point={"latitude": 50.1, "longitude": 6.1}, time_range=("2023-01-01", "2023-01-02"))
    assert collected(picked.df, "temperature") == [(11.0,)]
    with pytest.raises(InvalidSelectionError):
        ds.select(time_range=("2023-01-01", "2023-01-02"))


@pytest.mark.parametrize("bounds", [(1, 0, 1, 2), (0, 2, 1, 2), (0, 0, math.inf, 1), (0, 0, math.nan, 1), (0, 1, 2)])
def test_bad_bounds(sample, bounds):
    with pytest.raises(InvalidSelectionError):
        GridDataset(sample).select(bounds=bounds)


# --- point -------------------------------------------------------------------


def test_exact_point(small_grid):
    ds = GridDataset(small_grid, strict=True)
    assert collected(ds.point(50.5, 6.5, method="exact").df, "temperature") == [(12.5,)]
    with pytest.raises(NoDataFoundError):
        ds.point(50.4, 6.5, method="exact")


def test_nearest_point_ties_to_the_lower_value(small_grid):
    picked = GridDataset(small_grid).point(50.25, 6.75).df
    assert collected(picked, "latitude", "longitude") == [(50.0, 6.5)]


@pytest.mark.parametrize("tolerance, hits", [(0.125, 1), (0.12, 0)])
def test_tolerance_is_inclusive(small_grid, tolerance, hits):
    ds = GridDataset(small_grid)
    assert ds.point(50.375, 6.5, tolerance=tolerance).df.count() == hits
    if not hits:
        with pytest.raises(NoDataFoundError):
            GridDataset(small_grid, strict=True).point(50.375, 6.5, tolerance=tolerance)


def test_point_ignores_missing_coordinates(spark):
    rows = [(1.0, 1.0, 5.0), (float("nan"), 2.0, 6.0), (None, None, 7.0)]
    df = spark.createDataFrame(rows, "lat double, lon double, v double")
    assert collected(GridDataset(df).point(50, 50).df, "v") == []  # nearest latitude 1, longitude 2
    assert collected(GridDataset(df).point(0, 0).df, "v") == [(5.0,)]


def test_point_needs_known_names(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, v double")
    with pytest.raises(InvalidSelectionError):
        GridDataset(df).point(1, 2)
    renamed = spark.createDataFrame([(1.0, 2.0, 3.0)], "Lat double, LNG double, v double")
    assert GridDataset(renamed).point(0, 0).df.count() == 1


# --- rectangle ---------------------------------------------------------------


def test_rectangle_edges_are_inclusive(small_grid):
    ds = GridDataset(small_grid)
    assert ds.rectangle(50.0, 6.0, 50.5, 6.5).df.count() == 4
    assert ds.rectangle(50.0, 6.0, 51.0, 7.0).df.count() == 9
    assert ds.rectangle(50.25, 6.25, 50.75, 6.75).df.count() == 1


def test_rectangle_elsewhere_is_empty(small_grid):
    far = GridDataset(small_grid, strict=True).rectangle(50, -80, 51, -79)
    assert far.is_empty() and far.is_dataset_empty()


@pytest.mark.parametrize("box", [(50.5, 6, 50, 6.5), (50, 6, 50, 6.5), (50, 6.5, 50.5, 6), (50, 6, 50.5, 6)])
def test_rectangle_order(small_grid, box):
    with pytest.raises(InvalidSelectionError):
        GridDataset(small_grid).rectangle(*box)


def test_rectangle_checks_axes_when_strict(spark):
    bad = spark.createDataFrame([(100.0, 6.0, 1.0), (200.0, 7.0, 2.0)], "latitude double, longitude double, v double")
    with pytest.raises(InvalidSelectionError):
        GridDataset(bad, strict=True).rectangle(50, 6, 51, 7)
    wide = spark.createDataFrame([(10.0, 350.0, 1.0)], "latitude double, longitude double, v double")
    with pytest.raises(InvalidSelectionError):
        GridDataset(wide, strict=True).rectangle(5, -20, 15, 0)
    text = spark.createDataFrame([("north", 1.0, 1.0)], "latitude string, longitude double, v double")
    with pytest.raises(InvalidSelectionError):
        GridDataset(text, strict=True).rectangle(5, -20, 15, 0)


def test_custom_keys(small_grid):
    yx = small_grid.withColumnsRenamed({"latitude": "y", "longitude": "x"})
    ds = GridDataset(yx)
    keys = {"latitude_key": "y", "longitude_key": "x"}
    assert ds.rectangle(50, 6, 50.5, 6.5, **keys).df.count() == 4
    assert ds.circle(50.5, 6.5, 50, **keys).df.count() == 3
    assert ds.points([50.1], [6.1], **keys).df.count() == 1
    with pytest.raises(InvalidSelectionError):
        ds.rectangle(50, 6, 50.5, 6.5)
    with pytest.raises(InvalidSelectionError):
        ds.circle(50.5, 6.5, 50)


def test_attributes_survive(small_grid):
    ds = GridDataset(small_grid)
    for picked in (
        ds.rectangle(50, 6, 51, 7),
        ds.circle(50.5, 6.5, 100),
        ds.circle(50.5, 6.5, 100, masked=True),
        ds.point(50, 6),
    ):
        assert picked.attrs("temperature") == {"units": "celsius", "description": "Temperature"}
        assert picked.variables == ["temperature", "humidity"]


# --- circle ------------------------------------------------------------------


def test_circle_rows(small_grid):
    rows = [r for r in small_grid.collect() if km(50.5, 6.5, r.latitude, r.longitude) <= 50]
    assert collected(GridDataset(small_grid).circle(50.5, 6.5, 50).df) == sorted(map(tuple, rows))


def test_circle_far_away_and_bad_radius(small_grid):
    ds = GridDataset(small_grid)
    assert ds.circle(50, -80, 1).is_dataset_empty()
    assert ds.circle(50, -80, 1, masked=True).is_dataset_empty()
    for radius in (0, -1, math.nan):
        with pytest.raises(InvalidSelectionError):
            ds.circle(50.5, 6.5, radius)


def test_circle_edge(spark):
    rows = [(50.0, 6.0, 1.0), (50.5, 6.0, 2.0)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, v double")
    assert collected(GridDataset(df).circle(50, 6, 55.6).df, "v") == [(1.0,), (2.0,)]
    assert collected(GridDataset(df).circle(50, 6, 55.59).df, "v") == [(1.0,)]


def masked_by_hand(rows, lat, lon, radius):
    """Sub-grid around the hits, values outside blanked; rows (lat, lon, v)."""
    inside = {(a, b) for a, b, v in rows if km(lat, lon, a, b) <= radius}
    alive = {(a, b) for a, b, v in rows if (a, b) in inside and v is not None and not math.isnan(v)}
    lats, lons = {a for a, _ in alive}, {b for _, b in alive}
    return sorted(
        (a, b, v if (a, b) in inside else None) for a, b, v in rows if a in lats and b in lons
    )


@pytest.mark.parametrize(
    "start, count, step, radius",
    [((49, 5), 15, 0.15, 50), ((49.5, 5.5), 11, 0.1, 10), ((49.5, 5.5), 11, 0.1, 100), ((49, 5), 21, 0.1, 10)],
)
def test_masked_circle_on_dense_grids(spark, start, count, step, radius):
    lats, lons = ([s + i * step for i in range(count)] for s in start)
    rows = grid_rows(lats, lons, lambda i, j: 15 + i + j)
    df = spark.createDataFrame(rows, "latitude double, longitude double, v double")
    got = GridDataset(df).circle(50, 6, radius, masked=True).df.collect()
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got), key=key) == sorted(masked_by_hand(rows, 50, 6, radius), key=key)


def test_masked_circle_drops_lines_without_values(spark):
    nan = float("nan")
    rows = [(0.0, 0.0, 1.0), (0.0, 0.1, nan), (0.1, 0.0, None), (0.1, 0.1, None)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, v double")
    got = GridDataset(df).circle(0, 0, 50, masked=True).df
    assert collected(got) == [(0.0, 0.0, 1.0)]


@pytest.mark.parametrize(
    "center", [(89, 10), (-89.5, -170), (0, 179.9), (10, -179.95), (60, 180), (0, 0), (45, 300), (30, -400), (95, 10)]
)
def test_circle_box_never_loses_cells(spark, center):
    rng = random.Random(7)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 360)) for _ in range(1500)]
    rows += [(center[0] + rng.uniform(-1, 1), center[1] + rng.uniform(-1, 1)) for _ in range(300)]
    rows += [(100.0, 5.0), (10.0, 700.0), (float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "latitude double, longitude double")
    lat, lon = F.col("latitude"), F.col("longitude")
    distance = haversine_km(*center, lat, lon)
    lost = [
        F.count_if((distance <= radius) & ~F.isnan(distance) & ~circle_box(lat, lon, *center, radius)).alias(f"r{radius}")
        for radius in (30, 900, 9000, 12000, 20100)
    ]
    assert set(df.agg(*lost).first()) == {0}
    near = [r for r in rows if km(*center, *r) <= 900]
    assert collected(circle(df, *center, 900)) == sorted(near)


# --- time --------------------------------------------------------------------


def test_time_range_is_inclusive_and_orders_its_ends(sample):
    ds = GridDataset(sample).rectangle(50, 5, 51, 7)
    assert values(ds.time_range("2023-01-04", "2023-01-07")) == [6.5, 3]
    assert values(ds.time_range("2023-01-07", "2023-01-04")) == [6.5, 3]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string", "millis"])
def test_time_range_on_every_axis_type(sample, kind):
    if kind == "millis":
        df = sample.withColumn("time", F.unix_millis("time"))
    elif kind == "string":
        df = sample.withColumn("time", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    else:
        df = sample.withColumn("time", F.col("time").cast(kind))
    picked = GridDataset(df).time_range("2023-01-01T00:00:00Z", "2023-01-04T00:00:00Z")
    assert collected(picked.df, "precipitation") == [(1.5,), (4.25,), (6.5,)]
    later = GridDataset(df).time_range("2023-01-01T00:00:01Z", "2023-01-06T23:00:00Z")
    assert collected(later.df, "precipitation") == [(6.5,)]


def test_time_range_errors(sample, small_grid):
    with pytest.raises(InvalidSelectionError):
        GridDataset(sample).time_range("later", "2023-01-04")
    with pytest.raises(InvalidSelectionError):
        GridDataset(small_grid).time_range("2023-01-01", "2023-01-04")
    with pytest.raises(InvalidSelectionError):
        GridDataset(sample, strict=True).time_range("2999-01-01", "2999-02-01")
    assert GridDataset(sample).time_range("2999-01-01", "2999-02-01").is_empty()


def test_unknown_dimension_falls_back(sample):
    assert GridDataset(sample).time_range("2023-01-07", "2023-01-08", "nope").df.count() == 1
    renamed = GridDataset(sample.withColumnRenamed("time", "valid_time"))
    assert renamed.time_range("2023-01-07", "2023-01-08").df.count() == 1


def test_a_variable_named_like_a_time_axis(spark):
    """``t`` may be a variable; the dimensions then have to be named."""
    rows = [(1.0, 2.0, "2024-01-01", 280.0), (1.0, 2.0, "2024-01-02", 281.0)]
    df = spark.createDataFrame(rows, "lat double, lon double, step_time string, t double")
    ds = GridDataset(df, dims=("lat", "lon", "step_time"))
    assert ds.variables == ["t"]
    assert collected(ds.time_range("2024-01-02", "2024-01-03", "step_time").df, "t") == [(281.0,)]
    with pytest.raises(InvalidSelectionError):
        ds.time_range("2024-01-02", "2024-01-03")


# --- output and introspection ------------------------------------------------


def test_records(small_grid):
    ds = GridDataset(small_grid)
    with pytest.raises(KeyError):
        ds.to_records("pressure")
    assert ds.to_records("temperature").columns == ["latitude", "longitude", "value"]
    rounded = GridDataset(small_grid.withColumn("temperature", F.lit(1.2345))).to_records("temperature", 2)
    assert {r.value for r in rounded.collect()} == {1.23}


def test_json_records_write_missing_as_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, float("nan"))], "latitude double, longitude double, v double")
    assert GridDataset(df).to_json_records().first().json == '{"latitude":1.0,"longitude":2.0,"v":null}'


def test_sizes_axes_and_variables(small_grid):
    ds = GridDataset(small_grid)
    assert ds.sizes().first().asDict() == {"latitude": 3, "longitude": 3}
    assert collected(ds.axis("latitude")) == [(50.0,), (50.5,), (51.0,)]
    assert ds.variables == ["temperature", "humidity"] and set(ds.coords) == {"latitude", "longitude"}
    with pytest.raises(KeyError):
        ds.axis("depth")
    with pytest.raises(KeyError):
        ds.get_variable("latitude")


def test_emptiness(small_grid):
    ds = GridDataset(small_grid)
    none = ds.rectangle(0, 0, 1, 1)
    assert none.is_empty() and not ds.is_empty()
    with pytest.raises(NoDataFoundError):
        none.ensure_has_data()
    assert GridDataset(small_grid.select("latitude", "longitude")).is_dataset_empty()


def test_description(small_grid):
    rows = {r.name: r for r in GridDataset(small_grid).describe(preview=True).collect()}
    assert rows["latitude"].size == 3 and rows["latitude"].preview == "50.0, 50.5, 51.0"
    assert rows["humidity"].kind == "variable" and rows["humidity"].highest == "58.0"
    assert rows["temperature"].attrs == '{"description":"Temperature","units":"celsius"}'


def odd_axes(spark):
    rows = [(0.0, "b", 3, 1.5), (-0.0, "a", None, None), (float("nan"), None, 2, float("nan")), (None, "c", 1, -1.0), (7.5, "d", 9, 2.0), (1.0, "e", 5, 0.0)]
    return spark.createDataFrame(rows, "latitude double, name string, level int, v double")


@pytest.mark.parametrize("values", [200_000, 0])
def test_axes_are_summed_up_in_one_aggregation(spark, monkeypatch, values):
    """As sets of one aggregation, or as tables of their own where an axis is long."""
    monkeypatch.setattr(introspect, "SET_VALUES", values)
    dims = ["latitude", "name", "level"]
    report = introspect.describe_dataset(odd_axes(spark), dims, preview=True)
    got = {r.name: (r.size, r.lowest, r.highest, r.preview) for r in report.collect()}
    assert got == {
        "latitude": (3, "0.0", "7.5", "0.0, 1.0, 7.5"),
        "name": (5, "a", "e", "a, b, c, d, e"),
        "level": (5, "1", "9", "1, 2, 3, 5, 9"),
        "v": (4, "-1.0", "2.0", None),
    }
    ends = introspect.coord_preview(odd_axes(spark), dims, count=2)
    assert collected(ends.where("dim = 'level'")) == [("level", "first", 0, "1"), ("level", "first", 1, "2"), ("level", "last", 0, "5"), ("level", "last", 1, "9")]
    for df in (report, ends):
        plan = plan_of(df)
        assert "Expand" not in plan
        if values:
            assert "Exchange hashpartitioning" not in plan and plan.count("ObjectHashAggregate") <= 4
    empty = introspect.describe_dataset(odd_axes(spark).where("false"), dims, preview=True)
    assert {(r.size, r.lowest, r.preview) for r in empty.collect()} == {(0, None, None)}
    known = {"level": spark.createDataFrame([(4,), (6,)], "level int")}
    rows = {r.name: r for r in introspect.describe_dataset(odd_axes(spark), dims, True, known).collect()}
    assert (rows["level"].size, rows["level"].preview, rows["name"].size) == (2, "4, 6", 5)


def test_emptiness_of_many_selections(spark, small_grid):
    wanted = spark.createDataFrame([(50.0, 1, 2.0), (50.0, 2, 3.0), (99.0, 3, None), (None, 4, 1.0)], "latitude double, ask int, temperature double")
    got = GridDataset(small_grid).emptiness(wanted, ["latitude"])
    assert collected(got.select("ask", "is_empty", "is_dataset_empty")) == [(1, False, False), (2, False, False), (3, True, True), (4, True, True)]
    assert got.columns == ["latitude", "ask", "temperature", "is_empty", "is_dataset_empty"]
    bare = GridDataset(small_grid.select("latitude", "longitude")).emptiness(wanted, ["latitude"])
    assert collected(bare.select("ask", "is_empty", "is_dataset_empty"))[0] == (1, False, True)


# --- plans -------------------------------------------------------------------


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cells") / "grid")
    rows = grid_rows(range(-60, 60, 2), range(-100, 100, 5), lambda i, j: i * j)
    df = spark.createDataFrame(rows, "latitude double, longitude double, v double")
    df.withColumn("time", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("w", F.lit(1.0)).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_reach_the_scan_without_shuffle_or_python(stored):
    ds = GridDataset(stored)
    for picked in (
        ds.rectangle(0, 0, 10, 10),
        ds.circle(3, 4, 300),
        ds.time_range("2023-01-01", "2024-06-01"),
        ds.point(2, 5, method="exact"),
    ):
        plan = plan_of(picked.to_records("v"))
        assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
        assert "PushedFilters: []" not in plan
        assert "w:double" not in plan  # only the wanted variable is read
        assert "LessThanOrEqual" in plan or "EqualTo" in plan


def test_nearest_point_reaches_the_scan(stored):
    plan = plan_of(GridDataset(stored).point(3, 4).df)
    assert "EqualTo(latitude,ScalarSubquery" in plan.replace(" ", "") or "ScalarSubquery" in plan
    assert "Join" not in plan
