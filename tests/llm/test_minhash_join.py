"""MinHash join against all pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridloom.llm import common, minhash_join
from tests.llm.helpers import grouped, near_texts, shingles

SCHEMA = "doc_id long, text string, n_shingles string, cls int, component string"


def expected(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = [i for i in sets if sets[i]]
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    root = grouped(list(sets), links)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


@pytest.mark.parametrize("block, long", [(1024, 32), (4, 3)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, block, long):
    monkeypatch.setattr(minhash_join, "BLOCK", block)
    monkeypatch.setattr(minhash_join, "LONG", long)
    texts = dict(enumerate(near_texts(3)))
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in texts.items()], SCHEMA)
    rows = minhash_join.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == expected(texts)
    assert len(rows) == len(texts)
    kept = minhash_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.kept)


@pytest.mark.parametrize("numerator", [60, 80])
def test_lower_thresholds_lose_no_pair(spark, numerator):
    sets = {i: shingles(t) for i, t in enumerate(near_texts(5, n_groups=6))}
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if 100 * len(sets[a] & sets[b]) >= numerator * len(sets[a] | sets[b])]
    docs = spark.createDataFrame(list(enumerate(near_texts(5, n_groups=6))), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(docs, numerator).collect()}
    assert found == grouped(list(sets), links)


def test_matches_follow_the_threshold():
    assert [minhash_join.matches_for(n) for n in (60, 80, 85, 100)] == [19, 34, 38, 64]
    with pytest.raises(ValueError):
        minhash_join.matches_for(10)


def test_repeated_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(7, text), (7, text), (7, "other words " * 20), (None, text), (3, None), (3, None), (None, "alone one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash_join.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id == 7) == sorted(
        [(7, 46, 7, True), (7, 46, 7, True), (7, 2, 7, True)]
    )
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None and r.n_shingles == 46] == [(7, False)]
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None and r.n_shingles == 1] == [(None, True)]
    kept = minhash_join.one_of_each(docs).collect()
    assert len([r for r in kept if r.text == text]) == 1 and len([r for r in kept if r.doc_id == 3]) == 1
    assert len(kept) == 4


def test_nothing_to_link(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash_join.near_duplicates(docs).collect() == []
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {r.doc_id: (r.component_id, r.kept) for r in minhash_join.near_duplicates(docs).collect()} == {1: (1, True), 2: (2, True)}


def test_signatures_of_long_and_short_sets_agree():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 5, 0, 20_000, 40_000, 100)]
    for s, row in zip(sets, minhash_join.signatures_of(sets), strict=True):
        if len(s):
            assert (minhash_join.signature(s) == row).all()


def test_long_lists_are_compared_some_pairs_at_a_time(monkeypatch):
    monkeypatch.setattr(minhash_join, "PAIRS", 1 << 12)
    n, lists = 300, 3
    rng = np.random.default_rng(3)
    each = rng.integers(0, 2**32, (n, minhash_join.COORDINATES)).astype(np.uint32)
    each[:200] = each[0]
    each[:200, 50:] += rng.integers(0, 2, (200, 14)).astype(np.uint32)
    top = np.arange(lists, dtype=np.uint64).repeat(n) << np.uint64(58)
    whole = pa.table(
        {
            "posting": top.view(np.int64),
            "i": np.zeros(n * lists, np.int64),
            "j": np.zeros(n * lists, np.int64),
            "right": np.zeros(n * lists, bool),
            "cls": np.tile(np.arange(n), lists),
            "comp": np.tile(np.arange(n), lists),
            "mask": np.tile(1 << np.arange(n) % lists, lists),
            "marks": pa.array([x.tobytes() for x in each] * lists, pa.binary()),
            "size": np.full(n * lists, -1),
            "own": np.full(n * lists, -1),
        }
    )
    runs = minhash_join._runs(whole)
    parts = list(minhash_join._compared(whole, runs, 85, 38, False))
    assert len(parts) > 1 and max(len(a) for a, _ in parts) <= 2 << 12
    assert {(a, b) for part in parts for a, b in zip(*part)} == {(a, b) for a in range(200) for b in range(a + 1, 200)}
    ((a, b),) = minhash_join._compared(whole, runs, 85, 38, True)
    assert len(a) == 199 and set(grouped(range(200), zip(a.tolist(), b.tolist())).values()) == {0}


def words(key, n=40):
    return " ".join(f"{key}x{i}" for i in range(n))


def test_documents_without_a_near_duplicate_stay_where_they_are(spark):
    texts = [words(i) for i in range(90)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[i]) for i in range(9)] + [(200, words(200))] * 2 + [(None, words(300)), (None, words(301))]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), "doc_id long, text string")
    was = {r.text: r.p for r in docs.select("text", F.spark_partition_id().alias("p")).collect()}
    out = minhash_join.one_of_each(docs).select("doc_id", "text", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.text for r in out) == sorted(set(was)) and all(r.doc_id is None or r.doc_id < 90 or r.doc_id == 200 for r in out)
    alone = [r for r in out if r.doc_id is None or r.doc_id < 90]
    assert sum(was[r.text] == r.p for r in alone) >= 0.9 * len(alone)


@pytest.mark.parametrize("n_words", [1, 1 << 18])
def test_wanted_keys_hit_and_few_others_do(spark, monkeypatch, n_words):
    monkeypatch.setattr(common, "WORDS", n_words)
    rows = spark.createDataFrame([(None if i % 50 == 0 else i, str(i)) for i in range(1000)], "id long, name string")
    wanted = rows.where("id IS NULL OR id % 7 = 0").toDF("a", "b")
    found = common.hits(rows, ["id", "name"], wanted, ["a", "b"]).collect()
    assert len(found) == 1000 and found[0].asDict().keys() == {"id", "name", "hit"}
    assert all(r.hit for r in found if r.id is None or r.id % 7 == 0)
    others = [r.hit for r in found if not (r.id is None or r.id % 7 == 0)]
    assert n_words == 1 or sum(others) <= 10
    assert not any(r.hit for r in common.hits(rows, ["id", "name"], wanted.limit(0), ["a", "b"]).collect())


def test_few_rows_are_kept_in_few_files(spark, monkeypatch):
    made = []
    for name, owner in (("settled", minhash_join), ("stored", minhash_join), ("settled", common)):
        monkeypatch.setattr(owner, name, lambda df, f=getattr(owner, name): made.append((df := f(df)).rdd.getNumPartitions()) or df)
    conf = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame(list(enumerate(near_texts(3))), "doc_id long, text string").coalesce(1)
        minhash_join.near_duplicates(docs).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert sum(n >= 24 for n in made) <= 1
