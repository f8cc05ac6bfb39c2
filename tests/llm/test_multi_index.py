"""The multi-index against brute force, and on odd rows."""

import math

import numpy as np
import pytest

from gridloom.llm import multi_index
from gridloom.llm.multi_index import nearest, traversal
from tests.oracle import compare, connect

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, n=10, every=100):
    sound = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            sound[i, tuple(np.float64(np.float32(x)) for x in v)] = None
    out = []
    for i, v in sound:
        if i % every:
            continue
        near = sorted((math.dist(v, w), j) for j, w in sound if j != i and len(w) == len(v))[:n]
        out += [(i, r + 1, j, round(d, 9)) for r, (d, j) in enumerate(near)]
    return sorted(out)


def got(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect())


def test_traversal_is_in_order_of_the_sum():
    rng = np.random.default_rng(3)
    d1, d2, sizes = rng.random(9), rng.random(7), rng.integers(0, 4, (9, 7))
    for wanted in (1, 5, 30, int(sizes.sum()), 10_000):
        reached = traversal(d1, d2, sizes, wanted)
        summed = d1[:, None] + d2[None]
        met, below = sizes[summed <= reached].sum(), sizes[summed < reached].sum()
        assert met >= min(wanted, sizes.sum())
        assert wanted > sizes.sum() or below < wanted


def test_odd_rows_ties_and_copies(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist(), i % 3) for i in range(220)]
    rows += [(1000 + i, rows[100][1], None) for i in range(40)]  # copies of a query, queries among them
    rows += [(300, rows[0][1], 1), (300, rows[0][1], 2), (300, rows[7][1], 0), (400, [1.0, 2.0], 0), (401, [2.0, 2.0], 0)]
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 6, 0), (503, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (600, [7.0], 1)]
    rows += [(504, [math.nan] * 6, 0), (505, [math.inf] * 6, 0), (None, [1.0] * 6, 0), (506, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS nth", "2 AS search", "3 AS unit", "4 AS v", "5 AS rank")
    assert got(nearest(df)) == brute(rows)
    assert got(nearest(df, neighbours=3, every=50)) == brute(rows, 3, 50)


def test_one_hot_cell_is_split(spark, monkeypatch):
    rng = np.random.default_rng(8)
    hot = rng.normal(size=8)
    rows = [(i, (hot + (rng.normal(size=8) * 1e-3 if i % 3 else rng.normal(size=8))).tolist(), 0) for i in range(400)]
    monkeypatch.setattr(multi_index, "SHELF", 16)
    assert got(nearest(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_and_single(spark):
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nearest(spark.createDataFrame([(0, [1.0, 2.0], 0)], SCHEMA)).count() == 0
    assert got(nearest(spark.createDataFrame([(0, [1.0], 0), (1, [3.0], 0)], SCHEMA))) == [(0, 1, 1, 2.0)]


def test_lengths_outside_the_sample_are_searched(spark):
    rows = [(i, [float(i + 1), 1.0], 0) for i in range(150)] + [(200, [1.0, 2.0, 3.0], 0), (201, [1.0, 2.0, 4.0], 0)]
    assert got(nearest(spark.createDataFrame(rows, SCHEMA), sample=4)) == brute(rows)


@pytest.mark.parametrize("kind", ["even", "clusters"])
def test_recall(spark, monkeypatch, kind):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(6000, 32))
    if kind == "clusters":
        x = x * 0.2 + rng.normal(size=(40, 32))[rng.integers(0, 40, 6000)]
    x = x.astype(np.float32).astype(np.float64)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    monkeypatch.setattr(multi_index, "LEAST", 50)
    found = nearest(spark.createDataFrame(rows, SCHEMA), sample=2000).collect()
    assert len(found) == 600
    hits = 0
    for q in range(0, 6000, 100):
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & {r.vec_id for r in found if r.query_id == q})
    assert hits / 600 >= 0.93


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    import __spark_entry__ as contract

    name = "op11_multi_index"
    assert compare(spark, connect(sf), name, contract.queries()[name], contract.oracle_sql()[name], sf) is None
