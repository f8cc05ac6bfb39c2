import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom import InvalidSelectionError
from gridloom import functions as fn
from gridloom.functions.timing import coerce_bound, parse_instant
from gridloom.model import infer_coord, normalize_name
from tests.conftest import collected


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def km(lat1, lon1, lat2, lon2):
    """Independent distance: angle between unit vectors."""
    a, b, c, d = map(math.radians, (lat1, lon1, lat2, lon2))
    u = (math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a))
    v = (math.cos(c) * math.cos(d), math.cos(c) * math.sin(d), math.sin(c))
    dot = sum(x * y for x, y in zip(u, v))
    cross = math.hypot(u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
    return 6371 * math.atan2(cross, dot)


@pytest.mark.parametrize(
    "ends, about, within",
    [
        ((40.7128, -74.006, 34.0522, -118.2437), 3936, 5),
        ((40.7128, -74.006, 40.7128, -74.006), 0, 1e-5),
        ((0, 0, 0, 1), 111.32, 0.5),
        ((0, 0, 1, 0), 111.32, 0.5),
        ((51.5074, -0.1278, -33.8688, 151.2093), 16994, 50),
        ((-34.6037, -58.3816, -33.9249, 18.4241), 6870, 5),
    ],
)
def test_haversine_pairs(spark, ends, about, within):
    (got,) = one(spark, fn.haversine_km(*ends))
    assert abs(got - about) <= within
    assert got == pytest.approx(km(*ends), abs=1e-6)


def test_haversine_antipode_and_missing(spark):
    nan = F.lit(float("nan"))
    far, missing, null = one(
        spark,
        fn.haversine_km(30, 10, -30, 190),
        fn.haversine_km(nan, 0, 0, 0),
        fn.haversine_km(F.lit(None).cast("double"), 0, 0, 0),
    )
    assert far == pytest.approx(math.pi * 6371)
    assert math.isnan(missing) and null is None


@pytest.mark.parametrize(
    "args, size",
    [
        (([40.7128, 34.0522], [-74.006, -118.2437], 40.7128, -74.006), 2),
        (([40.7128, 34.0522], [-74.006, -118.2437], [34.0522, 40.7128], [-118.2437, -74.006]), 2),
        ((40.7128, [-74.006, -118.2437], [34.0522, 40.7128], -118.2437), 2),
        (([0, 0, 0], 0, 0, [1, 2, 3]), 3),
        (([0, 10], 0, [1, 2, 3], 5), 3),
    ],
)
def test_haversine_arrays_cycle(spark, args, size):
    (got,) = one(spark, fn.haversine_km_arrays(*args))
    lists = [a if isinstance(a, list) else [a] for a in args]
    assert len(got) == size
    assert got == pytest.approx([km(*[v[i % len(v)] for v in lists]) for i in range(size)], abs=1e-6)


def test_haversine_arrays_empty(spark):
    assert one(spark, fn.haversine_km_arrays([], [], [], [])) == ([],)


def test_normalize_segment(spark):
    texts = ["  ERA5  Land\t2m ", " Wind U ", "plain", " \n "]
    got = [one(spark, fn.normalize_segment(F.lit(t)))[0] for t in texts]
    assert got == ["era5_land_2m", "wind_u", "plain", ""]
    assert [normalize_name(t) for t in texts] == got


def test_infer_coord_keeps_original_name():
    assert infer_coord(["Valid Time", "LAT"], ("latitude", "lat", "y")) == "LAT"
    assert infer_coord(["Valid Time"], ("time", "valid_time")) == "Valid Time"
    assert infer_coord(["a"], ("b",)) is None


@pytest.mark.parametrize(
    "item, by_prefix, by_split",
    [
        ("era-temp-final", ("temp", "final"), ("temp", "final")),
        ("era-temp", ("temp", "default"), ("temp", "default")),
        ("era-temp-a-b", ("temp", "a-b"), ("temp", "a-b")),
        ("temp", ("temp", "default"), (None, "default")),
        ("other-temp", ("other", "temp"), ("temp", "default")),
    ],
)
def test_item_ids(spark, item, by_prefix, by_split):
    i, c = F.lit(item), F.lit("era")
    assert one(spark, fn.dataset_by_prefix(i, c), fn.variant_by_prefix(i, c)) == by_prefix
    assert one(spark, fn.dataset_by_split(i), fn.variant_by_split(i)) == by_split


def test_dash_in_collection_differs_between_forms(spark):
    i, c = F.lit("my-era-temp-final"), F.lit("my-era")
    assert one(spark, fn.dataset_by_prefix(i, c), fn.dataset_by_split(i)) == ("temp", "era")


def test_names(spark):
    got = one(
        spark,
        fn.qualify_collection(F.lit("era5"), F.lit("ecmwf")),
        fn.qualify_collection(F.lit("ecmwf_era5"), F.lit("ecmwf")),
        fn.qualify_collection(F.lit("era5"), F.lit("")),
        fn.org_from_collection(F.lit("noaa_gfs_x")),
        fn.org_from_collection(F.lit("noaa")),
        fn.dataset_path(F.lit("c"), F.lit(""), F.lit("v")),
        fn.resolve_ipfs_uri(F.lit("ipfs://abc"), "https://g"),
        fn.resolve_ipfs_uri(F.lit("https://x"), "https://g"),
    )
    assert got == ("ecmwf_era5", "ecmwf_era5", "era5", "noaa", None, "c-v", "https://g/ipfs/abc", "https://x")


def test_typed_properties(spark):
    body = '{"s": "text", "n": 2, "f": 1.5, "b": true, "list": ["a", 1, "b"]}'
    p = F.from_json(F.lit(body), "MAP<STRING, VARIANT>")
    assert one(spark, *[fn.string_prop(p, k) for k in ("s", "n", "b", "none")]) == ("text", None, None, None)
    assert one(spark, *[fn.number_prop(p, k) for k in ("n", "f", "s", "b")]) == (2.0, 1.5, None, None)
    assert one(spark, fn.string_list(p["list"]), fn.string_list(p["s"])) == (["a", "b"], None)


def test_bbox_and_extent(spark):
    none = F.lit(None).cast("string")
    box = one(spark, fn.item_bbox(F.array(*map(F.lit, (1.0, 2.0, 3.0, 4.0, 5.0)))), fn.item_bbox(F.array(F.lit(1.0))))
    assert box == ([1.0, 2.0, 3.0, 4.0], None)
    extent = one(
        spark, fn.item_time_extent(F.lit("a"), none, F.lit("z")), fn.item_time_extent(none, none, none)
    )
    assert tuple(extent[0]) == ("a", "z") and extent[1] is None


def test_retrieval_status(spark):
    rows = [("ETIMEDOUT",), ("zarr metadata missing",), ("request timed out",), ("timeout",), (None,)]
    df = spark.createDataFrame(rows, "message string")
    got = collected(df.select(F.coalesce("message", F.lit("")), fn.retrieval_status(F.col("message"))))
    assert got == [
        ("", "ok"),
        ("ETIMEDOUT", "connection_error"),
        ("request timed out", "connection_error"),
        ("timeout", "error"),
        ("zarr metadata missing", "error"),
    ]


def test_bounds_are_typed_by_the_axis():
    number = T.DoubleType()
    assert coerce_bound("1500", number) == 1500.0
    assert coerce_bound("1970-01-01T00:00:01Z", number) == 1000.0
    assert coerce_bound("1970-01-02", T.TimestampType()) == parse_instant(86_400_000)
    assert fn.normalize_time_range("2024-02-01", "2024-01-01", T.TimestampType()) == (
        parse_instant("2024-01-01"),
        parse_instant("2024-02-01"),
    )
    for dtype in (number, T.TimestampType(), T.StringType()):
        with pytest.raises(InvalidSelectionError):
            coerce_bound("soon", dtype)
