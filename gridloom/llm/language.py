"""Language of a text by n-gram filters that hold one bit per language."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import stored

UNKNOWN = "und"
#: Runs of letters. Digits and underscores part words; the few numbers that are no digits do not.
_WORD = re.compile(r"[^\W\d_]+")
#: Words that a task remembers before it starts afresh, words that are cut into n-grams in one
#: go, and characters of text looked up together.
CACHE_WORDS, CUT, TOGETHER = 1 << 19, 1 << 14, 1 << 20
#: Characters of the words that a task remembers, and characters that are cut into n-grams in one
#: go: a text without breaks is one word, however long it is.
CACHE_CHARS, PIECE = 1 << 25, 1 << 18

ORDERS = (1, 2, 3, 4)
#: Share of a language's n-grams of one order that an n-gram must have: at most 1 / MIN_SHARE of
#: an order belong to a language, however much text there is, which bounds the filter.
MIN_SHARE = 2e-5
#: A language holds an n-gram if its share is at least so much of the largest share.
MIN_RATIO = 0.3
#: Filter rows (each a bit per language) and rows that an n-gram sets.
ROWS, HASHES = 1 << 21, 3

_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def cut_words(words: Iterable[str]) -> Iterator[list[str]]:
    """The words in lists of a bounded number of words and characters, or of one long word."""
    part: list[str] = []
    size = 0
    for word in words:
        if part and (len(part) == CUT or size + len(word) > PIECE):
            yield part
            part, size = [], 0
        part.append(word)
        size += len(word)
    if part:
        yield part


def _long_grams(word: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``grams`` of one word, piece by piece: each n-gram is in the piece that it begins in."""
    padded = f" {word} "
    for begin in range(0, len(padded), PIECE):
        piece = padded[begin : begin + PIECE + max(ORDERS) - 1]
        codes = np.frombuffer(piece.encode("utf-32-le"), np.uint32).astype(np.uint64)
        h = np.zeros(len(codes), np.uint64)
        for n in ORDERS:
            size = len(codes) - n + 1
            if size < 1:
                break
            h = (h[:size] ^ codes[n - 1 :]) * _MIX
            h ^= h >> np.uint64(29)
            mine = h[:PIECE] + np.uint64(n)
            if n == 1:
                mine = mine[codes[: len(mine)] != 0x20]
            yield n, mine, np.zeros(len(mine), np.int64)


def grams(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order, the 64-bit hashes of all n-grams of the words, and the word of each.

    A word stands between two spaces, which are characters of its n-grams; a space alone is none.
    One long word comes in pieces, each order several times.
    """
    if len(words) == 1 and len(words[0]) > PIECE:
        yield from _long_grams(words[0])
        return
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = codes == 0x20
    # The word that a place belongs to; a space belongs to the word after it.
    word = np.cumsum(space) - 1
    h = np.zeros(len(codes), np.uint64)
    for n in ORDERS:
        size = len(codes) - n + 1
        if size < 1:
            break
        h = (h[:size] ^ codes[n - 1 :]) * _MIX
        h ^= h >> np.uint64(29)
        whole = ~space[:size] if n == 1 else np.ones(size, bool)
        for k in range(1, n - 1):
            whole &= ~space[k : k + size]
        whole &= word[:size] < len(words)
        yield n, h[whole] + np.uint64(n), word[:size][whole]


def filter_rows(hashes: np.ndarray, rows: int, k: int) -> np.ndarray:
    """The ``k`` filter rows of each hash, as an array of shape (n, k)."""
    step = (hashes * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
    places = hashes[:, None] + step[:, None] * np.arange(1, k + 1, dtype=np.uint64)
    return ((places ^ (places >> np.uint64(31))) % np.uint64(rows)).astype(np.int64)


@dataclass
class LanguageFilter:
    """A Bloom filter per language, sliced by bits: row ``i`` has the languages whose bit i is set."""

    languages: list[str]
    table: np.ndarray  # (rows, words of 64 languages)
    hashes: int

    def __post_init__(self) -> None:
        bits = np.array([self.bit(self.table, i).mean() for i in range(len(self.languages))])
        self.false_rate = bits**self.hashes

    @staticmethod
    def bit(table: np.ndarray, i: int) -> np.ndarray:
        return (table[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(bool)

    def counts(self, words: list[str]) -> np.ndarray:
        """A row per word: its n-grams, then how many of them each language's filter has."""
        out = np.zeros((len(words), 1 + len(self.languages)), np.float32)
        for _, hashes, word in grams(words):
            held = np.bitwise_and.reduce(self.table[filter_rows(hashes, len(self.table), self.hashes)], axis=1)
            out[:, 0] += np.bincount(word, minlength=len(words))
            for i in range(len(self.languages)):
                out[:, 1 + i] += np.bincount(word, self.bit(held, i), len(words))
        return out

    def decide(self, counts: np.ndarray) -> tuple[str, float]:
        """The language with most n-grams beyond what false positives give, and its share."""
        excess = counts[1:] - counts[0] * self.false_rate
        excess = np.maximum(excess / np.maximum(1 - self.false_rate, 1e-9), 0)
        best = int(np.argmax(excess))
        total = excess.sum()
        return self.languages[best], float(excess[best] / total) if total > 0 else 0.0


class WordCounts:
    """The counts of a filter for texts, looked up word by word; a bounded number is remembered."""

    def __init__(self, model: LanguageFilter) -> None:
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.chars = 0
        self.rows = np.zeros((1 << 12, 1 + len(self.model.languages)), np.float32)

    def sums(self, texts: list[list[str]]) -> np.ndarray:
        """The summed counts of each list of words."""
        if len(self.at) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self.forget()
        words = list(chain.from_iterable(texts))
        which = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(which < 0).tolist()
        for part in cut_words({words[k]: None for k in unknown}):
            k = len(self.at)
            self.chars += sum(map(len, part))
            while k + len(part) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[k : k + len(part)] = self.model.counts(part)
            self.at.update(zip(part, range(k, k + len(part)), strict=True))
        if unknown:
            which[unknown] = [self.at[words[k]] for k in unknown]
        out = np.zeros((len(texts), self.rows.shape[1]))
        at = 0
        for i, text in enumerate(texts):
            out[i] = self.rows[which[at : at + len(text)]].sum(0, dtype=np.float64)
            at += len(text)
        return out


def fold(doc_id: Column | str = "doc_id", folds: int = 5) -> Column:
    """``crc32`` of the id as text, modulo the number of folds; 0 is held out. NULL has no fold."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % folds


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``(lang, n, gram, count)`` over every word of every text with a language; ``gram`` is a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, of_lang in words.items():
                found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
                for cut in cut_words(of_lang):
                    times = np.array([of_lang[w] for w in cut], np.float64)
                    for n, hashes, word in grams(cut):
                        found.setdefault(n, []).append(_summed(hashes, times[word]))
                for n, parts in found.items():
                    hashes, sums = _summed(*(np.concatenate(side) for side in zip(*parts, strict=True)))
                    for i in range(0, len(hashes), 50_000):
                        some = hashes[i : i + 50_000].view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * len(some), pa.string()),
                                pa.array(np.full(len(some), n, np.int32)),
                                pa.array(some),
                                pa.array(sums[i : i + 50_000].astype(np.int64)),
                            ],
                            names=["lang", "n", "gram", "count"],
                        )
            words.clear()

        chars = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                said = text.as_py()
                words.setdefault(lang, Counter()).update(words_of(said))
                chars += len(said or "")
                if chars > CACHE_CHARS:  # of all words, also those that are known: a bound
                    yield from flush()
                    chars = 0
            if sum(map(len, words.values())) > CACHE_WORDS:
                yield from flush()
                chars = 0
        yield from flush()

    parts = labelled.select(F.col("lang").cast("string"), "text").mapInArrow(run, "lang string, n int, gram long, count long")
    return parts.groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))


def _summed(hashes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, which = np.unique(hashes, return_inverse=True)
    return found, np.bincount(which, times, len(found))


def member_bits(counts: DataFrame, languages: list[str], min_share: float, min_ratio: float) -> DataFrame:
    """``(gram, word, bits)``: the languages that hold each n-gram, 64 to a word."""
    order = counts.groupBy("lang", "n").agg(F.sum("count").alias("all"))
    share = counts.join(F.broadcast(order), ["lang", "n"])  # one row per language and order
    share = share.select("gram", "lang", (F.col("count") / F.col("all")).alias("share"))
    each = share.groupBy("gram").agg(F.max("share").alias("most"), F.collect_list(F.struct("lang", "share")).alias("of"))
    held = each.where(F.col("most") >= min_share).select("gram", "most", F.explode("of").alias("of"))
    held = held.where((F.col("of.share") >= min_share * min_ratio) & (F.col("of.share") >= F.col("most") * min_ratio))
    place = F.create_map(*(F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)))
    at = F.element_at(place, F.col("of.lang"))
    held = held.select("gram", F.floor(at / 64).cast("int").alias("word"), F.expr("1L").alias("one"), (at % 64).alias("bit"))
    return held.groupBy("gram", "word").agg(F.bit_or(F.call_function("shiftleft", "one", "bit")).alias("bits"))


def train(
    labelled: DataFrame,
    min_share: float = MIN_SHARE,
    min_ratio: float = MIN_RATIO,
    rows: int = ROWS,
    hashes: int = HASHES,
) -> LanguageFilter | None:
    """The filter learnt from ``(text, lang)``; None where no row has a language.

    Counts cover all rows. What reaches the driver is the filter itself, of a fixed number of
    rows, one long for each 64 languages.
    """
    counts = stored(gram_counts(labelled.where("lang IS NOT NULL")))
    named = labelled.where("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    languages = [r["lang"] for r in named.collect()]  # the label set, one row per language
    if not languages:
        return None
    members = member_bits(counts, languages, min_share, min_ratio)

    @F.pandas_udf("array<long>")
    def places(gram: pd.Series) -> pd.Series:
        return pd.Series(list(filter_rows(gram.to_numpy(np.int64).view(np.uint64), rows, hashes)), dtype=object)

    at = members.select(F.explode(places("gram")).alias("row"), "word", "bits")
    sliced = at.groupBy("row", "word").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros((rows, (len(languages) + 63) // 64), np.uint64)
    table[sliced["row"].to_numpy(np.int64), sliced["word"].to_numpy(np.int64)] = sliced["bits"].to_numpy(np.int64).view(np.uint64)
    return LanguageFilter(languages, table, hashes)


def predict(docs: DataFrame, model: LanguageFilter | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of each row, from its text alone.

    Texts that are NULL or have no letter, and all texts where nothing was learnt, are ``und``
    with score 0. Where no n-gram is known or languages tie, the one with most documents to
    learn from wins. Texts may be of any length, also one word without a break: what a task holds of
    them beside the text is bounded by characters.
    """
    kind = dict(docs.dtypes)["doc_id"]
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by its rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        known = None if model is None else WordCounts(model)
        for batch in batches:
            said: list[tuple[str, float]] = []
            waiting: list[list[str] | None] = []
            size = 0

            def look_up() -> None:
                sums = iter(known.sums([w for w in waiting if w is not None])) if known else iter(())
                said.extend((UNKNOWN, 0.0) if w is None else model.decide(next(sums)) for w in waiting)
                waiting.clear()

            for text in batch.column(1):
                text = text.as_py()
                waiting.append(words_of(text) if known and has_letter(text) else None)
                size += len(text or "")
                if size > TOGETHER:
                    look_up()
                    size = 0
            look_up()
            names, scores = zip(*said, strict=True) if said else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learnt from the other folds, said of all rows."""
    model = train(docs.where(fold("doc_id", folds) != 0).select("text", "lang"))
    said = predict(docs, model)
    held_out = F.coalesce(fold("doc_id", folds) == 0, F.lit(False))
    return said.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
