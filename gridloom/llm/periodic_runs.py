"""Periodic runs: maximal stretches of words that repeat with a period, by seed and extend."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run has so many words, and so many times its period, at least.
MIN_WORDS, MIN_PERIODS = 24, 3
#: Words of the shortest seeds. A run of period q agrees with itself, q words on, in
#: max(24 - q, 2 q) words or more, which is never below this.
SEED = 16
#: Characters that are tokenised together, and words whose seeds are sorted together.
PIECE, TOGETHER = 1 << 20, 1 << 19

Run = tuple[int, int, int]  # start, length, period


class Words:
    """Numbers of the words of texts. Texts are cut at white space, so that no list of all
    words of a long text is needed."""

    def __init__(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__  # a new word gets the next number

    def numbers(self, text: str) -> np.ndarray:
        number, parts, rest = self.number.__getitem__, [], b""
        for begin in range(0, len(text), PIECE):
            piece = rest + text[begin : begin + PIECE].encode()
            words = piece.split()  # bytes split at exactly the ASCII white space
            rest = b""
            if words and begin + PIECE < len(text) and not piece[-1:].isspace():
                rest = words.pop()
            parts.append(np.fromiter(map(number, words), np.int32, len(words)))
        if rest:
            parts.append(np.array([number(rest)], np.int32))
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def spelled(self) -> list[bytes]:
        return list(self.number)


def grams(names: np.ndarray, step: int) -> np.ndarray:
    """Numbers of the stretches of twice ``step`` words, given those of ``step`` words: exact,
    as equal numbers mean equal words."""
    low, high = names[:-step].astype(np.int64), names[step:].astype(np.int64)
    return np.unique(low * (int(names.max(initial=0)) + 1) + high, return_inverse=True)[1]


def seeds(names: np.ndarray, lags: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lags of neighbouring occurrences of a seed whose lag is in ``lags``.

    A seed has at least as many words as the largest lag. Between two occurrences of a seed
    of a run, one period apart, there is then no other, or the run had a smaller period; so
    neighbours are enough, and pairs grow with the text and not with the square of a group.
    """
    order = np.argsort(names, kind="stable")
    lag = np.diff(order)
    found = (np.diff(names[order]) == 0) & (lag >= lags[0]) & (lag <= lags[1])
    return order[:-1][found], lag[found]


def _extended(words: np.ndarray, start: int, lag: int, covered: int) -> tuple[int, int]:
    """The stretch around ``start`` of words that equal those ``lag`` on: its first, and the
    first beyond. It is known to begin at ``covered`` or later."""

    def agree(begin: int, end: int) -> np.ndarray:
        return words[begin:end] == words[begin + lag : end + lag]

    last = len(words) - lag
    end, step = start, 64
    while end < last:
        same = agree(end, min(end + step, last))
        if not same.all():
            end += int(same.argmin())
            break
        end, step = end + len(same), 2 * step
    begin, step = start, 64
    while begin > covered:
        low = max(begin - step, covered)
        same = agree(low, begin)[::-1]
        if not same.all():
            begin -= int(same.argmin())
            break
        begin, step = low, 2 * step
    return begin, end


def runs_of(words: np.ndarray) -> list[Run]:
    """All runs of a document's word numbers, by start, then period.

    Seeds of 16, 32, 64 ... words find the periods up to their length. A seed is extended along
    its diagonal (positions one lag apart) unless the table of the furthest word covered on that
    lag says that an extension has passed it.
    """
    n = len(words)
    found: list[Run] = []
    covered: dict[int, int] = {}
    names, width = words, 1
    while width < SEED and len(names) > width:
        names, width = grams(names, width), 2 * width
    if width < SEED or n < MIN_WORDS:
        return []
    low = 1
    while True:
        starts, lags = seeds(names, (low, width))
        by_place = np.argsort(starts, kind="stable")
        for start, lag in zip(starts[by_place].tolist(), lags[by_place].tolist(), strict=True):
            reached = covered.get(lag, 0)
            if start < reached:
                continue
            begin, end = _extended(words, start, lag, reached)
            covered[lag] = end
            length = end - begin + lag
            if length >= max(MIN_WORDS, MIN_PERIODS * lag):
                found.append((begin, length, lag))
        low = width + 1
        if MIN_PERIODS * low > n or not len(starts) and len(np.unique(names)) == len(names):
            return sorted(found, key=lambda run: (run[0], run[2]))
        names, width = grams(names, width), 2 * width


def repeated_seeds(documents: list[np.ndarray]) -> list[bool]:
    """Whether some ``SEED`` words stand twice in a document: without, it has no run.

    One sort for all the documents, over hashes; equal hashes of different words only cost a look.
    """
    sizes = np.array([len(d) for d in documents])
    words = np.concatenate(documents).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    of = np.repeat(np.arange(len(documents)), sizes)
    mixed, width, factor = words, 1, 0xD6E8FEB86659FD93
    while width < SEED and len(mixed) > width:
        mixed = (mixed[:-width] * np.uint64(factor)) ^ ((mixed[width:] >> np.uint64(29)) + mixed[width:])
        factor, width = factor * factor % 2**64, 2 * width
    if width < SEED:
        return [False] * len(documents)
    whole = of[: len(mixed)] == of[SEED - 1 :]
    document, mixed = of[: len(mixed)][whole], mixed[whole]
    # The document is mixed in as well, so that one sort tells repeats within it.
    mixed ^= document.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) << np.uint64(1)
    order = np.argsort(mixed)
    again = np.zeros(len(documents), bool)
    again[document[order[1:][mixed[order[1:]] == mixed[order[:-1]]]]] = True
    return (again & (sizes >= MIN_WORDS)).tolist()


def damaged(words: np.ndarray, seed: int | None) -> np.ndarray:
    """The words with a made tail of repeats, where the id's checksum ends in 0 (None: untouched)."""
    n = len(words)
    if seed is None or seed % 10 or not n:
        return words
    g = seed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return words[at]


def collapsed(n: int, runs: list[Run]) -> np.ndarray | None:
    """Which words stay when each run keeps its first period only (None: all)."""
    if not runs:
        return None
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest length to a period, exactly; ties: smallest start, then period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def summary(words: np.ndarray, runs: list[Run], spelled: list[bytes]) -> tuple:
    digest = hashlib.sha256()
    for run in runs:
        digest.update(b"%d,%d,%d\n" % run)
    kept = collapsed(len(words), runs)
    stays = words if kept is None else words[kept]
    text = hashlib.sha256()
    for begin in range(0, len(stays), PIECE):
        text.update((b" " if begin else b"") + b" ".join(map(spelled.__getitem__, stays[begin : begin + PIECE].tolist())))
    best = strongest(runs)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *shown, digest.hexdigest(), text.hexdigest())


RESULT = [
    ("n_runs", "long", pa.int64()),
    ("start", "long", pa.int64()),
    ("length", "long", pa.int64()),
    ("period", "long", pa.int64()),
    ("exponent_milli", "long", pa.int64()),
    ("runs_sha256", "string", pa.string()),
    ("collapsed_sha256", "string", pa.string()),
]


def _groups(texts: Iterator[str | None]) -> Iterator[list[str]]:
    """Texts in groups of a bounded number of characters (or one text)."""
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text or "")
        size += len(text or "")
        if size > 4 * TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def _detected(texts: Iterator[str | None], seeds_of: Iterator[int | None]) -> Iterator[tuple[np.ndarray, list[Run], list[bytes]]]:
    """Word numbers, runs and the spelling of words for each text."""
    for group in _groups(texts):
        words = Words()
        documents = [damaged(words.numbers(text), next(seeds_of)) for text in group]
        spelled = words.spelled()
        maybe = [False] * len(documents)
        some: list[int] = []
        size = 0
        for k, document in enumerate(documents):
            some.append(k)
            size += len(document)
            if size > TOGETHER or k + 1 == len(documents):
                for i, flag in zip(some, repeated_seeds([documents[i] for i in some]), strict=True):
                    maybe[i] = flag
                some, size = [], 0
        for document, look in zip(documents, maybe, strict=True):
            yield document, runs_of(document) if look else [], spelled


def detect(docs: DataFrame, seed: Column | None = None) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)``.

    One row per row of ``(doc_id, text)``. A run is a stretch of words with smallest period q,
    ``MIN_WORDS`` and ``MIN_PERIODS`` q words or more, that no neighbouring word extends. The four
    columns in the middle describe the strongest run and are NULL without one; ``runs_sha256`` has all
    runs, ``collapsed_sha256`` the text without the repeats. A NULL text has no words, as an
    empty one. ``seed`` is the checksum by which texts are damaged first.

    A document stays in the task that reads it: all the work is within it, nothing is shuffled.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            damages = (s.as_py() for s in batch.column(2))
            rows = [summary(*found) for found in _detected(texts, damages)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(RESULT)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, (_, _, t) in zip(columns, RESULT, strict=True))],
                names=["doc_id", *(name for name, _, _ in RESULT)],
            )

    schema = ", ".join([f"doc_id {kind}", *(f"{name} {t}" for name, t, _ in RESULT)])
    wanted = docs.select("doc_id", "text", (F.lit(None) if seed is None else seed).cast("long").alias("seed"))
    return wanted.mapInArrow(run, schema)


def run_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, length, period)``: every run of every document."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            found = [(k, *r) for k, (_, runs, _) in enumerate(_detected(texts, iter(lambda: None, 0))) for r in runs]
            at, *numbers = list(zip(*found, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in numbers)],
                names=["doc_id", "start", "length", "period"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, length long, period long")


def collapse(docs: DataFrame) -> DataFrame:
    """The documents with each run reduced to its first period; ``text`` of these has its words
    joined by one space, other texts (and other columns) are as they were."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(at)]
            for k, (words, runs, spelled) in enumerate(_detected(iter(texts), iter(lambda: None, 0))):
                if runs:
                    stays = words[collapsed(len(words), runs)].tolist()
                    texts[k] = b" ".join(map(spelled.__getitem__, stays)).decode()
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
