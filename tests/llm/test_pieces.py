"""Piece encoding against the library, text by text."""

import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import pieces

MODEL = "piece_bpe_32k.model"
CHARS = "aetinoshAB é ßñ 日本語 😀 ▁ \n\t .,!? 0123 ́   \x00"


LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def ids_of(text):
    return [i for chunk in pieces.model_of(MODEL).encode(text)[0] for i in chunk[0]]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(CHARS), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_are_the_librarys(text):
    assert ids_of(text) == LIBRARY.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(CHARS), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6), st.integers(1, 60))
def test_reports_are_what_the_library_encodes_and_decodes(texts, together):
    """Also in small groups and with a memory that is given up all the time."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pieces, "TOGETHER", together)
        patch.setattr(pieces, "CACHE_CHUNKS", together)
        got = list(pieces.reports([None, *texts], MODEL))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for text, (n, ids_sha, decoded_sha, crc) in zip(["", *texts], got, strict=True):
        ids = LIBRARY.encode(text)
        ends = [end for _, _, end in pieces.model_of(MODEL).spans(text)]
        assert (n, ids_sha, decoded_sha) == (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))), text
        assert crc == zlib.crc32(struct.pack(f"<{len(ends)}q", *ends))


def test_words_and_long_texts(library):
    rng = random.Random(5)
    for n in (0, 1, 2, 50, 5000):
        text = "".join(rng.choice(["the ", " ", "  ", "\n", "thing", "é", "▁", "!!", "tion ", "9"]) for _ in range(n))
        assert ids_of(text) == library.encode(text)


def test_spans_cover_the_text_and_match_the_fast_way():
    rng = random.Random(6)
    model = pieces.model_of(MODEL)
    for n in (0, 1, 3, 40, 400):
        text = "".join(rng.choice(["the ", " ", "\n", "thing", "éa", "日", "😀", "x"]) for _ in range(n))
        spans = model.spans(text)
        size = len(text.encode())
        assert [b for _, b, _ in spans] == [0, *(e for _, _, e in spans[:-1])][: len(spans)]
        assert not spans or spans[-1][2] == size
        found, plain = model.encode(text)
        if plain:
            assert pieces.plain_spans(found, text).tolist() == [e for _, _, e in spans]


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
def test_character_map_is_read_as_the_library_reads_it(rule):
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    from sentencepiece import sentencepiece_model_pb2 as format

    proto = format.ModelProto()
    proto.ParseFromString(normalizer.serialized_model_proto())
    spec = proto.normalizer_spec
    own = pieces.Normalizer(
        pieces.CharacterMap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
    )
    for text in ["", " ", "ﬁne ㍿ Ａbc", "  two  words ", "ｶﾞ é  x", "①②③", "日本　語", "­​z", "ÀÉ"]:
        want = normalizer.normalize(text)
        got, align = own(text)
        assert got.decode() == want
        assert len(align) == len(got) + 1 and align == sorted(align) and align[-1] <= len(text.encode())


def test_query_rows(spark, library):
    texts = [None, "", "One  two\nthree é", "x" * 5000, "One  two\nthree é"]
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    rows = {r.doc_id: r for r in pieces.encoded(docs).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert pieces.encoded(docs.limit(0)).collect() == []
    spans = {r.doc_id: r.pieces for r in pieces.piece_rows(docs).collect()}
    assert spans[1] == [] and [p.id for p in spans[2]] == library.encode(texts[2])
