import pytest
from pyspark.sql import functions as F

from gridloom import InvalidSelectionError
from gridloom.sources.chunks import ChunkAxis, ChunkGrid, explode_chunks
from tests.conftest import collected, plan_of


def test_three_dimensional_chunks(spark):
    """Chunks of 2 x 2 x 3 elements; the slowest axis differs per chunk."""
    rows = [(0, [float(v) for v in range(12)]), (1, [float(v) for v in range(100, 112)])]
    chunks = spark.createDataFrame(rows, "block long, data array<double>")
    axes = [
        ChunkAxis("step", F.col("block") * 2.0, 1.0),
        ChunkAxis("latitude", 10.0, -0.5, size=2),
        ChunkAxis("longitude", 5.0, 2.0, size=3),
    ]
    got = explode_chunks(chunks, "data", "v", axes)
    want = [
        (2.0 * b + s, 10 - 0.5 * i, 5 + 2.0 * j, data[s * 6 + i * 3 + j])
        for b, data in rows for s in range(2) for i in range(2) for j in range(3)
    ]
    assert collected(got) == sorted(want)


def test_irregular_axis(spark):
    axis = spark.createDataFrame([(0, -3.5), (1, 0.25), (2, 9.0)], "position long, value double")
    chunks = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "row long, data array<double>")
    axes = [ChunkAxis("latitude", F.col("row"), values=axis), ChunkAxis("longitude", 0.0, 1.0, size=2)]
    got = explode_chunks(chunks, "data", "v", axes, {"row": F.col("row")})
    assert collected(got, "latitude", "longitude", "v") == [
        (-3.5, 0.0, 1.0), (-3.5, 1.0, 2.0), (0.25, 0.0, 3.0), (0.25, 1.0, 4.0), (9.0, 0.0, 5.0), (9.0, 1.0, 6.0),
    ]


def chunked(spark, steps=(1.0, -0.5, 2.0), ragged=False):
    """Blocks of 3 x 4 x 5 elements that tile 6 x 8 x 10, one of them short, one empty, one NULL."""
    rows = []
    for b in range(8):
        n = 60 - (22 if ragged and b == 5 else 0)
        rows.append((b % 2, b // 2 % 2, b // 4, [float(1000 * b + k) for k in range(n)]))
    rows += [(0, 0, 9, []), (0, 1, 9, None)]
    df = spark.createDataFrame(rows, "x long, y long, z long, data array<double>")
    axes = [
        ChunkAxis("step", F.col("z") * 3 * steps[0] + 10.0, steps[0], None if ragged else 3),
        ChunkAxis("latitude", F.col("y") * 4 * steps[1] + 1.5, steps[1], size=4),
        ChunkAxis("longitude", F.col("x") * 5 * steps[2], F.lit(steps[2]), size=F.lit(5)),
    ]
    return ChunkGrid(df, "data", "v", axes, {"z": F.col("z"), "x": F.col("x")})


BOXES = [
    {},
    {"step": (11, 13)},
    {"latitude": (-1.0, 0.5), "longitude": (3.9, 12.0)},
    {"latitude": (None, 0.0), "longitude": (7, None), "step": (12.0, 12.0)},
    {"longitude": (4.0, 4.0), "latitude": (1.5, 1.5)},
    {"longitude": (-1e300, 1e300), "latitude": (5, 1)},
    {"step": (1e9, 1e12)},
    {"step": (None, None), "latitude": (-1e9, 1e9)},
]


@pytest.mark.parametrize("ragged", [False, True])
@pytest.mark.parametrize("steps", [(1.0, -0.5, 2.0), (0.1, 0.3, -0.7)])
def test_selections_equal_filtered_cells(spark, steps, ragged):
    grid = chunked(spark, steps, ragged)
    cells = grid.cells().collect()
    for box in BOXES:
        want = [
            tuple(r)
            for r in cells
            if all((low is None or r[d] >= low) and (high is None or r[d] <= high) for d, (low, high) in box.items())
        ]
        got = grid.select(box)
        assert got.columns == grid.cells().columns
        assert collected(got) == sorted(want), box


def test_irregular_axes_are_cut(spark):
    lines = spark.createDataFrame([(0, -3.5), (1, 0.25), (2, 9.0), (3, -7.0), (5, 2.0), (6, None)], "position long, value double")
    others = spark.createDataFrame([(0, 1.0), (1, 2.0)], "position long, value double")
    rows = [(r, [float(10 * r + k) for k in range(6)]) for r in range(4)]
    chunks = spark.createDataFrame(rows, "row long, data array<double>")
    axes = [
        ChunkAxis("latitude", F.col("row") * 2, size=2, values=lines),
        ChunkAxis("longitude", 0, size=3, values=others),
    ]
    grid = ChunkGrid(chunks, "data", "v", axes, {"row": F.col("row")})
    cells = [tuple(r) for r in grid.cells().collect()]
    assert len(cells) == 24
    for low, high in ((-4.0, 1.0), (None, 0.0), (100.0, None), (2.0, 2.0)):
        want = [c for c in cells if c[0] is not None and (low is None or c[0] >= low) and (high is None or c[0] <= high)]
        got = [tuple(r) for r in grid.select({"latitude": (low, high)}).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    both = [c for c in cells if c[0] is not None and c[0] <= 1 and c[1] == 2.0]
    assert collected(grid.select({"latitude": (None, 1.0), "longitude": (2.0, 2.0)})) == sorted(both)


@pytest.mark.parametrize("place", [{"latitude": -0.74, "longitude": 7.0}, {"step": -99.0}, {"longitude": 5.0, "step": 12.5, "latitude": 0.0}])
def test_nearest_from_origins(spark, place):
    grid = chunked(spark)
    cells = grid.cells().collect()
    at = {d: min({r[d] for r in cells}, key=lambda c: (abs(c - x), c)) for d, x in place.items()}
    assert collected(grid.nearest(place)) == sorted(tuple(r) for r in cells if all(r[d] == v for d, v in at.items()))


def test_chunks_are_dropped_before_the_explosion(spark, tmp_path):
    path = str(tmp_path / "chunks")
    spark.range(400).selectExpr("id AS block", "transform(sequence(0, 999), k -> id * 1000D + k) AS data").write.parquet(path)
    axes = [ChunkAxis("latitude", F.col("block") * 1.0, 1.0, 1), ChunkAxis("longitude", 0.0, 0.1, size=1000)]
    grid = ChunkGrid(spark.read.parquet(path), "data", "v", axes)
    got = grid.select({"latitude": (17.5, 18.5), "longitude": (10.0, 10.5)})
    plan = plan_of(got)
    scan, explode = plan.index("FileScan"), plan.index("Generate explode")
    between = plan[explode:scan]
    assert "Filter" in between and "block" in between.split("Filter")[1][:400]
    assert got.count() == 6
    with pytest.raises(InvalidSelectionError):
        grid.select({"height": (0, 1)})
    assert grid.nearest({"latitude": 1e9, "longitude": -5.0}).collect() == [(399.0, 0.0, 399000.0)]
