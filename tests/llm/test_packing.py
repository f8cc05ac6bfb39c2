"""Packing against plain encoding of each text."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridloom.llm import packing

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aA sS'tTéÉ́ \n\x85\x1c  <|endoftext|>Σς"), st.characters(exclude_categories=["Cs"])), max_size=50), max_size=4))
def test_word_by_word_is_the_whole(texts):
    tokens = packing.tokens_of(NAME)
    tokens.forget()
    assert encoded(tokens, texts) == [tokens.model.encode(text, add_special_tokens=False).ids + [1] for text in texts]


def encoded(tokens, texts):
    """The ids of each text, of whatever groups they come in."""
    out = []
    for ids, lengths in tokens.encode(texts):
        assert len(ids) == lengths.sum()
        out += [part.tolist() for part in np.split(ids, np.cumsum(lengths)[:-1])]
    return out


def lengths_of(n):
    text, size = packing.binary_lengths(np.array([3, n, 2048]))
    assert text.tolist() == sorted(text.tolist()) and size[text == 0].tolist() == [2, 1] and size[text == 2].tolist() == [2048]
    return size[text == 1].tolist()


@given(st.integers(1, 100_000))
def test_binary_lengths(n):
    lengths = lengths_of(n)
    assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
    assert all(x & (x - 1) == 0 and x <= 2048 for x in lengths)
    assert len(set(lengths)) == len([x for x in lengths if x < 2048]) + (2048 in lengths)


def test_memory_is_given_up(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    monkeypatch.setattr(packing, "ENCODED", 2)
    tokens = packing.WordTokens(NAME, 1)
    for together in (1, 1 << 20):
        monkeypatch.setattr(packing, "TOGETHER", together)
        texts = ["a b c d e", "f g a", "a b", None, "h i j k <|endoftext|>"]
        want = [tokens.model.encode(text or "", add_special_tokens=False).ids + [1] for text in texts]
        assert encoded(tokens, texts) == want


def test_pieces(spark, library, monkeypatch):
    texts = [None, "", "one two three", "word " * 5000, "one two three", "Ünïcode!! 12 <|endoftext|> x"]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, length int")
    monkeypatch.setattr(packing, "ROWS", 3)
    rows = packing.pack(docs, with_ids=True).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    for i, text in enumerate(texts):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [r.length for r in own] == lengths_of(len(ids))
        for r in own:
            assert r.doc_tokens == len(ids) and r.offset == 0 and 1 << r.bucket == r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            assert r.ids == ids[r.start : r.start + r.length].tolist()
    assert packing.pack(docs.limit(0)).collect() == []


def test_buckets_hold_one_length(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "word " * 3000)], "doc_id long, text string")
    packing.write_buckets(packing.pack(docs, with_ids=True), str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert all(len(r.ids) == r.length == 1 << r.bucket for r in rows)


def test_few_words_are_remembered(monkeypatch):
    monkeypatch.setattr(packing, "TOGETHER", 100)
    tokens = packing.WordTokens(NAME, 1, 500)
    texts = [f"often {' '.join(f'w{20 * i + k}' for k in range(20))} seldom{i}" for i in range(200)]
    want = [tokens.model.encode(text, add_special_tokens=False).ids + [1] for text in texts]
    assert encoded(tokens, texts) == want
    held = len(tokens.at)
    assert held <= 500 + 22 and len(tokens.again) <= 2 * held + 22 and b"often" in tokens.at and b"w0" not in tokens.at
    assert list(tokens.at.values()) == list(range(held))
    tokens.forget()
    assert list(tokens.at)[:2] == [packing.END, b"often"]
    assert encoded(tokens, texts) == want
