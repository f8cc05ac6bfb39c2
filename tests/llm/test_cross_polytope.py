"""Vector links against all pairs."""

import math

import numpy as np
import pyarrow as pa

from gridloom.llm import cross_polytope
from tests.llm.helpers import grouped

SCHEMA = "vec_id long, embedding array<float>, label int, n_links int, unit string"


def expected(rows, threshold=0.93):
    unit = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = np.array(v, np.float32).astype(np.float64)
            unit[i] = (label, v / np.linalg.norm(v))
    links = [
        (a, b)
        for a in unit
        for b in unit
        if a < b and unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= threshold
    ]
    degree = {i: 0 for i, *_ in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    root = grouped(list(degree), links)
    return {i: (degree[i], root[i], root[i] == i) for i in degree}


def vectors(seed, d=64):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(12):
        base = rng.normal(size=d)
        for k in range(14):
            noise = rng.normal(size=d) * np.linalg.norm(base) / math.sqrt(d) * (0.02 + 0.05 * k / 2)
            rows.append((base + noise * (k > 1)) * (1 + k))
    out = [(i, [float(x) for x in v], i % 3 if i % 5 else 0) for i, v in enumerate(rows)]
    n = len(out)
    odd = [None, [], [0.0] * d, [float("nan")] * d, [float("inf")] + [1.0] * (d - 1), [None] + [1.0] * (d - 1), [1.0] * 10]
    out += [(n + i, v, 0) for i, v in enumerate(odd)]
    return [*out, (n + len(odd), out[0][1], None), (n + len(odd) + 1, [2.0] * 10, 0)]


def test_links_are_those_of_all_pairs(spark, monkeypatch):
    rows = vectors(4)
    df = spark.createDataFrame([(*r, 5, "z") for r in rows], SCHEMA)
    for block, shelf, listed, matrix in ((4096, 8192, 64, 1024), (5, 8192, 1, 7), (9, 20, 3, 4)):
        for name, value in (("BLOCK", block), ("SHELF", shelf), ("LISTED", listed), ("MATRIX", matrix)):
            monkeypatch.setattr(cross_polytope, name, value)
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cross_polytope.near_vectors(df).collect()}
        assert got == expected(rows)


def test_empty_table(spark):
    assert cross_polytope.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def pairs_at_the_threshold(n):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return x, 0.93 * x + math.sqrt(1 - 0.93**2) * side


def share_met(a, b):
    return sum(bool(set(p) & set(q)) for p, q in zip(a.tolist(), b.tolist(), strict=True)) / len(a)


def test_recall_just_above_the_threshold():
    """Pairs at a cosine of 0.93 meet in some bucket, all but very few."""
    x, y = pairs_at_the_threshold(3000)
    a, b = (cross_polytope.bucket_keys(v, cross_polytope.TABLES, cross_polytope.PROBES).reshape(len(v), -1) for v in (x, y))
    assert share_met(a, b) >= 0.999


def test_recall_of_shelves():
    """And on some shelf, however many a label has; a shelf's rows stay as many as rows grow."""
    x, y = pairs_at_the_threshold(3000)
    for shelves in (2, 8, 64, 128, 1024, 8192):
        a, b = (cross_polytope.shelf_keys(v, shelves) for v in (x, y))
        assert share_met(a, b) >= 0.99, shelves
        sizes = np.unique(np.concatenate([np.unique(row) for row in a]), return_counts=True)[1]
        assert len(sizes) > 0.5 * shelves
        assert sizes.mean() <= 3000 * cross_polytope.SHELF_PROBES / shelves * 2.5 + 1


def test_spanning_edges_join_what_links_join():
    rng = np.random.default_rng(2)
    for _ in range(40):
        near = rng.random((9, 7)) < 0.15
        links = [(r, 9 + c) for r, c in zip(*np.nonzero(near), strict=True)]
        edges = [(r, 9 + c) for r, c in cross_polytope._spanning(near)]
        assert set(edges) <= set(links) and grouped(range(16), edges) == grouped(range(16), links)
        assert len(edges) == 16 - len(set(grouped(range(16), links).values()))


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(cross_polytope.rotated(x, 3), axis=1), np.linalg.norm(x, axis=1))


def test_large_labels_move_few_small_rows():
    """A vector of a label with millions moves as a few sketches, not as whole vectors; pairs still meet."""
    x, y = pairs_at_the_threshold(20_000)
    size = len(cross_polytope.sketches(x[:1])[0])
    assert size <= 0.3 * 4 * 64
    for n, copies in ((10_256, 1), (400_000, 1), (1_500_000, 5), (2_300_000, 5), (9_000_000, 7)):
        shelves = cross_polytope.shelves_of(n, 64)
        if shelves == 1:
            assert copies == 1
            continue
        a, b = (cross_polytope.shelf_keys(v, shelves, probes=shelves.bit_length()) for v in (x, y))
        assert a.shape[1] <= copies and n * copies / shelves <= 2 * cross_polytope.SHELF
        assert share_met(a, b) >= 0.9999


def test_sketches_bound_products():
    x = cross_polytope.units(np.random.default_rng(3).normal(size=(300, 10)) * np.geomspace(1, 1e-3, 10))
    rows = np.arange(len(x))
    sketch = cross_polytope.Sketches(np.frombuffer(b"".join(cross_polytope.sketches(x)), np.uint8).reshape(len(x), -1))
    z, bounds, cosine = sketch.units(rows), sketch.bounds(rows), x @ x.T
    near = cosine >= 0.93
    assert near.sum() > len(x) and (z @ z.T)[near].min() >= sketch.cut(rows, 0.93)
    assert (bounds @ bounds.T >= z @ z.T - 1e-6).all()


def run_of(x):
    n = len(x)
    none = np.zeros(n, np.int64)
    return pa.table(
        {"cls": np.arange(n), "unit": pa.array(cross_polytope.sketches(x), pa.binary()), "i": none, "j": none, "right": none.astype(bool)}
    )


def test_candidates_of_a_run_join_its_links(monkeypatch):
    """Pairs at the threshold, among a large group that fills its buckets."""
    x, y = pairs_at_the_threshold(1500)
    rng = np.random.default_rng(5)
    group = cross_polytope.units(rng.normal(size=64) + 0.07 * rng.normal(size=(900, 64)))
    vectors = np.concatenate([x, y, group])
    for listed, matrix in ((64, 1024), (16, 100), (5000, 1024)):
        monkeypatch.setattr(cross_polytope, "LISTED", listed)
        monkeypatch.setattr(cross_polytope, "MATRIX", matrix)
        a, b = cross_polytope._candidates([run_of(vectors)], 0.93, cross_polytope.TABLES, cross_polytope.PROBES)
        root = grouped(range(len(vectors)), zip(a.tolist(), b.tolist(), strict=True))
        assert all(root[i] == root[1500 + i] for i in range(1500))
        assert len({root[3000 + i] for i in range(900)}) == 1
        assert len(a) < 1.2 * (1500 + 899)


def test_groups_in_blocks(spark, monkeypatch):
    """Links of groups that are larger than a task holds, with copies of vectors in several files."""
    rows = vectors(6)
    rows += [(1000 + i, v, label) for i, v, label in rows[:40]]
    expect = expected(rows)
    df = spark.createDataFrame([(*r, 5, "z") for r in rows], SCHEMA).repartition(5)
    for group, shelf in ((3, 8192), (7, 10)):
        monkeypatch.setattr(cross_polytope, "GROUP", group)
        monkeypatch.setattr(cross_polytope, "SHELF", shelf)
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cross_polytope.near_vectors(df).collect()}
        assert got == expect


def test_classes_with_one_number_get_others():
    one, other = cross_polytope.Classes(0), cross_polytope.Classes(1)
    assert one.of(3, b"12345678") == cross_polytope.Classes(0).of(3, b"12345678") != other.of(3, b"12345678")
    assert len({one.of(label, v) for label in (3, 4, "3", None) for v in (b"1", b"2", b"12")}) == 12
