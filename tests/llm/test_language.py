"""Language filters: held-out accuracy, and the parts against plain Python."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from gridloom.llm import language

PARTS = {"xx": ["ka", "ro", "mi", "tu", "sha"], "yy": ["el", "en", "ost", "ich", "er"], "zz": ["ño", "ción", "al", "ar", "que"]}


def documents(n=300):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        lang = rng.choice(list(PARTS))
        text = " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60)))
        rows.append((i, text.upper() if i % 7 == 0 else text, lang))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(1000, None, "xx"), (1001, "", "yy"), (1002, "123 !!", "zz"), (1003, "Ωμέγα", None), (1004, "² ½ _", None), (None, "karo", "xx"), (1005, "karo mi", "xx"), (1005, "karo mi", "xx")]
    return spark.createDataFrame([(*r, "s", 0.5) for r in documents() + odd], "doc_id long, text string, lang string, source string, score double")


def test_held_out_accuracy(docs):
    rows = language.identify(docs).collect()
    assert len(rows) == 308
    true = {i: lang for i, _, lang in documents()}
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    tested = [r for r in rows if r.doc_id in true and r.held_out]
    assert len(tested) > 30 and sum(r.lang_pred == true[r.doc_id] for r in tested) >= 0.97 * len(tested)
    said = {r.doc_id: r.lang_pred for r in rows}
    assert [said[i] for i in (1000, 1001, 1002, 1004)] == ["und"] * 4 and said[1003] in PARTS and said[1005] == "xx"


def test_prediction_reads_no_label(spark, docs):
    blank = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 'yy' ELSE lang END AS lang")
    a = sorted(map(str, language.identify(docs).collect()))
    assert a == sorted(map(str, language.identify(blank).collect()))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(docs).collect()] == [("und", 0.0)]
    assert language.identify(docs.limit(0)).collect() == []


def grams_of(word):
    padded = f" {word} "
    return [padded[i : i + n] for n in language.ORDERS for i in range(len(padded) - n + 1) if padded[i : i + n] != " "]


def test_grams_are_those_inside_each_word():
    """Equal n-grams and no others have equal hashes, whichever words stand beside them."""
    words = ["a", "ab", "karo", "roka", "ñandú", "x", "a", "日本語", "karo"]
    strings = {n: [] for n in language.ORDERS}
    for k, word in enumerate(words):
        for gram in grams_of(word):
            strings[len(gram)].append((k, gram))
    hash_of = {}
    for n, hashes, word in language.grams(words):
        alone = {k: [h for m, hs, _ in language.grams([w]) if m == n for h in hs.tolist()] for k, w in enumerate(words)}
        for k in range(len(words)):
            own = hashes[word == k].tolist()
            assert sorted(own) == sorted(alone[k]) and len(own) == sum(i == k for i, _ in strings[n])
            for gram, h in zip([g for i, g in strings[n] if i == k], own, strict=True):
                assert hash_of.setdefault(gram, h) == h
    assert len(set(hash_of.values())) == len(hash_of)
    assert [x for x in language.grams([])] == [] or all(not len(h) for _, h, _ in language.grams([]))


def test_gram_counts(spark):
    rows = [("xx", "Karo KA ka1ro"), ("xx", None), ("yy", "ka")]
    got = Counter()
    for r in language.gram_counts(spark.createDataFrame(rows, "lang string, text string")).collect():
        got[r.lang, r.n] += r["count"]
    want = Counter()
    for lang, text in rows:
        for word in language.words_of(text):
            for gram in grams_of(word):
                want[lang, len(gram)] += 1
    assert got == want


def test_filter_has_no_false_negatives_and_the_stated_false_positives():
    rng = np.random.default_rng(1)
    grams, others = rng.integers(0, 2**63, 600).astype(np.uint64), rng.integers(0, 2**63, 2000).astype(np.uint64)
    table = np.zeros((4096, 2), np.uint64)
    for i, rows in enumerate(language.filter_rows(grams, 4096, 3)):
        bit = 70 if i % 2 else 1
        table[rows, bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
    model = language.LanguageFilter([f"l{i}" for i in range(71)], table, 3)
    held = np.bitwise_and.reduce(table[language.filter_rows(grams, 4096, 3)], axis=1)
    assert model.bit(held, 70)[1::2].all() and model.bit(held, 1)[0::2].all()
    held = np.bitwise_and.reduce(table[language.filter_rows(others, 4096, 3)], axis=1)
    assert abs(model.bit(held, 70).mean() - model.false_rate[70]) < 0.01
    words = ["karo", "ka", "日本"]
    counts = model.counts(words)
    assert counts[:, 0].tolist() == [len(grams_of(w)) for w in words]
    looked_up = language.WordCounts(model).sums([["ka", "karo", "ka"], [], ["日本"]])
    assert np.allclose(looked_up, [2 * counts[1] + counts[0], 0 * counts[0], counts[2]])


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_long_words_in_pieces(monkeypatch, piece):
    words = ["karoka", "x", "日本語ñandú" * 3, "ab"]
    whole = {w: sorted((n, h) for n, hs, _ in language.grams([w]) for h in hs.tolist()) for w in words}
    monkeypatch.setattr(language, "PIECE", piece)
    for w in words:
        assert sorted((n, h) for n, hs, at in language.grams([w]) for h in hs.tolist()) == whole[w]
    monkeypatch.setattr(language, "CUT", 2)
    parts = list(language.cut_words(words))
    assert [w for p in parts for w in p] == words and all(len(p) == 1 or len(p) <= 2 and sum(map(len, p)) <= piece for p in parts)


def test_a_text_without_a_break(spark):
    """Four million letters in one word take no more memory than is bounded, and count like any."""
    before = language.CACHE_CHARS
    rows = [(i, t, lang) for i, t, lang in documents(60)] + [(500, "karomi" * 700_000, None), (501, "karomi" * 5, None)]
    said = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert said[500].lang_pred == said[501].lang_pred == "xx" and said[500].score == pytest.approx(said[501].score, abs=0.2)
    assert language.CACHE_CHARS == before


def by_hand(rows):
    """All of ``identify`` with sets for filters, which have no false positives."""
    counts, docs = {}, Counter()
    for i, text, lang in rows:
        if lang is None or i is None or zlib.crc32(str(i).encode()) % 5 == 0:
            continue
        docs[lang] += 1
        for word in language.words_of(text):
            for gram in grams_of(word):
                counts.setdefault((lang, len(gram)), Counter())[gram] += 1
    share = {}
    for (lang, _), found in counts.items():
        for gram, n in found.items():
            share.setdefault(gram, {})[lang] = n / found.total()
    held = {}
    for gram, of in share.items():
        most = max(of.values())
        if most >= language.MIN_SHARE:
            low = language.MIN_RATIO * max(language.MIN_SHARE, most)
            held[gram] = {lang for lang, x in of.items() if x >= low}
    languages = sorted(docs, key=lambda lang: (-docs[lang], lang))
    out = []
    for i, text, _ in rows:
        if not language.has_letter(text):
            out.append((i, "und", 0.0))
            continue
        hits = Counter(lang for word in language.words_of(text) for gram in grams_of(word) for lang in held.get(gram, ()))
        best = max(languages, key=lambda lang: hits[lang])
        out.append((i, best, hits[best] / hits.total() if hits else 0.0))
    return out


def test_identify_against_plain_python(spark):
    rows = documents(200) + [(900, None, "xx"), (901, "KARO el", None), (902, "zzz qqq", None), (903, "12", "yy"), (904, "la ka en", None)]
    got = sorted((r.doc_id, r.lang_pred, r.score) for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect())
    for (i, lang, score), (j, want, share) in zip(got, sorted(by_hand(rows)), strict=True):
        assert (i, lang) == (j, want) and score == pytest.approx(share, abs=2e-3)
