"""Periodic runs against brute force over all starts and periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import periodic_runs
from gridloom.llm.periodic_runs import collapse, detect, run_rows, runs_of
from gridloom.llm.queries import QUERIES
from tests.llm.helpers import words

SCHEMA = "doc_id long, text string, n_runs int, seed string"


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            start, length = i, j - i + q
            if j > i and length >= max(24, 3 * q):
                part = w[start : start + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((start, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    w = words(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *shown, sha(listed), sha(" ".join(w[i] for i in range(n) if i not in gone)))


def texts():
    rng = random.Random(4)
    made = [None, "", " \t\n", "a", "a " * 23, "a " * 24, "A " * 100, "x\x0by\x0cz " * 9, "é b " * 30, "a b " * 12 + "a"]
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            unit = [rng.choice("abcdef") for _ in range(rng.choice((1, 2, 3, 7, 15, 16, 17, 33, 40, 70)))]
            parts += unit * rng.randrange(1, 7) + unit[: rng.randrange(len(unit) + 1)]
            parts += [rng.choice("abcdefgh") for _ in range(rng.randrange(12))]
        made.append(" ".join(parts[:600]))
    # Periods in which every 16 words stand twice: neighbours of short seeds do not show the period.
    one, two = " ".join("pqrstuvwxyzabcdefghij"), " ".join("klmnopqrstuvwabcdefgh")
    made.append(" ".join(one if c == "x" else two for c in "xxxyyyxy" * 4))
    return made


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2]), max_size=60), st.integers(1, 8), st.integers(0, 50))
def test_runs_of_small_alphabets(unit, times, cut):
    w = (unit * times)[cut // 2 :] + unit[:cut]
    assert runs_of(np.array(w, np.int32)) == brute_runs(w)


def test_rows_against_brute_force(spark):
    rows = [(k - 3, t, 1, "x") for k, t in enumerate(texts())] + [(7, "a b c " * 30, 1, "x")] * 2 + [(None, "a b " * 30, 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    import pyspark.sql.functions as F

    got = detect(df, F.crc32(F.col("doc_id").cast("string")))
    want = [brute(i, t) for i, t, *_ in rows if i is not None]
    assert sorted(tuple(r) for r in got.collect() if r.doc_id is not None) == sorted(want)
    assert [r.period for r in got.where("doc_id IS NULL").collect()] == [2]
    assert detect(df.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in rows if len(words(r.text)) <= 1500}
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, f"/root/testdata/{sf}").collect()}
    assert len(got) == len(rows)
    assert {i: got[i] for i in short} == {i: brute(i, t) for i, t in short.items()}


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "PIECE", 7)
    monkeypatch.setattr(periodic_runs, "TOGETHER", 5)
    numbering = periodic_runs.Words()
    for text in texts():
        spelled = list(numbering.number)
        numbers = numbering.numbers(text or "")
        spelled = numbering.spelled()
        assert [spelled[k].decode() for k in numbers] == words(text)
    w = np.array([1, 2, 3, 4, 5] * 40_000 + list(range(50)) * 3_000, np.int32)
    assert [r[2] for r in runs_of(w)] == [5, 50]
    assert len(runs_of(np.zeros(400_000, np.int32))) == 1


def test_general_forms(spark):
    df = spark.createDataFrame([(1, "x " + "a b c " * 10 + "y", 5, None), (2, "a\n b", None, "k"), (3, None, 1, "")], SCHEMA)
    assert [tuple(r) for r in run_rows(df).collect()] == [(1, 1, 30, 3)]
    assert sorted(tuple(r) for r in collapse(df).collect()) == [(1, "x a b c y", 5, None), (2, "a\n b", None, "k"), (3, None, 1, "")]
