"""Bands of a circle against distances alone."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions import haversine_km
from gridloom.operators.selection import _within, band_cover, circle, circle_masked, circle_zones
from tests.conftest import collected, plan_of

CENTERS = [(0, 0), (52.5, 13.4), (-33, 179.9), (89.5, 20), (-89.999, -170), (75, -180), (90, 0), (12, 365), (60, 0.1)]


@pytest.fixture(scope="module")
def scattered(spark):
    rng = random.Random(6)
    rows = [(rng.uniform(-91, 91), rng.uniform(-400, 400)) for _ in range(4000)]
    rows += [(c + rng.gauss(0, s), d + rng.gauss(0, s)) for c, d in CENTERS for s in (0.01, 0.3, 4, 20) for _ in range(250)]
    rows += [(c + k / 4, d + j / 4) for c, d in CENTERS for k in range(-8, 9) for j in range(-8, 9)]
    rows += [(None, 1.0), (1.0, None), (float("nan"), 0.0), (0.0, float("nan")), (90.0, 5.0), (-90.0, 5.0), (1e9, 0.0)]
    return spark.createDataFrame(rows, "latitude double, longitude double")


@pytest.mark.parametrize("center", CENTERS)
def test_same_cells_as_by_distance(scattered, center):
    """For circles of all sizes at once; and the zones of each hold every cell of it."""
    lat, lon = F.col("latitude"), F.col("longitude")
    wrong = []
    for radius in (0.5, 5, 40, 111.2, 300, 700, 2500, 3000, 9000, 11000, 25000):
        distance = haversine_km(*center, lat, lon)
        exact = F.coalesce((distance <= radius) & ~F.isnan(distance), F.lit(False))
        box, inside = _within(scattered, *center, radius, "latitude", "longitude")
        wrong.append(F.count_if(F.coalesce(box & inside, F.lit(False)) != exact).alias(f"cells{radius}"))
        met = F.lit(not circle_zones(*center, radius))
        for bounds in circle_zones(*center, radius):
            here = F.lit(True)
            for dim, (low, high) in bounds.items():
                here = here & (F.lit(True) if low is None else F.col(dim) >= low) & (F.lit(True) if high is None else F.col(dim) <= high)
            met = met | here
        wrong.append(F.count_if(exact & ~met).alias(f"zones{radius}"))
    got = scattered.agg(*wrong).first().asDict()
    assert {name: n for name, n in got.items() if n} == {}
    near = haversine_km(*center, lat, lon) <= 700
    assert collected(circle(scattered, *center, 700)) == collected(scattered.where(near & ~F.isnan(haversine_km(*center, lat, lon))))


def test_few_cells_need_a_distance(spark):
    cover = band_cover(50.0, 500.0)
    grid = spark.range(400 * 400).selectExpr("44 + (id div 400) * 0.03 AS latitude", "4 + (id % 400) * 0.03 AS longitude")
    at = F.least(F.floor((F.col("latitude") - cover.low) / cover.height).cast("int"), F.lit(len(cover.inner) - 1))
    off = F.abs(F.col("longitude") - 10.0)
    inner, outer = (F.get(F.array(*map(F.lit, w)), at) for w in (cover.inner, cover.outer))
    edge = grid.where((F.col("latitude") >= cover.low) & (off > inner) & (off <= outer)).count()
    assert 0 < edge < 0.12 * circle(grid, 50, 10, 500).count()
    assert band_cover(50.0, 12_000.0) is None and band_cover(95.0, 10.0) is None


def test_masked_circle_scans_the_cells_twice(spark, tmp_path):
    path = str(tmp_path / "cells")
    spark.range(6400).selectExpr("(id % 80) * 0.25 AS latitude", "(id div 80) * 0.25 AS longitude", "id * 1.0 AS value").write.parquet(path)
    df = circle_masked(spark.read.parquet(path), 10, 10, 200, variables=["value"])
    rows = df.collect()
    assert {r.latitude for r in rows} and any(r.value is None for r in rows) and any(r.value is not None for r in rows)
    plan = plan_of(df)
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    # One narrow scan for the places, used by both sets of lines, and one for the cells.
    assert final.count("FileScan parquet") - final.count("ReusedExchange") <= 2
    assert _within(df, 10, 10, 200, "latitude", "longitude") is not None
