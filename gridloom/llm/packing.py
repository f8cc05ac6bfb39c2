"""Packing of documents into sequences whose lengths are powers of two."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: The longest sequence; itself a power of two.
MAX_LENGTH = 2048
END_ID = 1
#: Words that a worker remembers, unless told otherwise, before it drops those that it met only once,
#: and ids for each of them; words encoded in one go, and characters of text looked up together.
CACHE_WORDS, CACHE_IDS, ENCODED, TOGETHER = 1 << 21, 8, 1 << 12, 1 << 18
#: Rows of a batch that a task hands on.
ROWS = 20_000


#: Stands for the end of a document among its words, which hold no white space.
END = b" "


class WordTokens:
    """Token ids of texts, one lookup per word.

    The tokenizer drops white space and never joins what stands on both sides of it, so the
    ids of a text are the ids of its words in order. New words are encoded many in one call and
    remembered. Beyond ``remembered`` words, or ``CACHE_IDS`` ids for each, only those met again since
    the last time stay, up to half of that number. A million words take about 170 MB.
    """

    def __init__(self, tokenizer: str, end_id: int, remembered: int | None = None) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        self.most = CACHE_WORDS if remembered is None else remembered
        self.at: dict[bytes, int] = {END: 0}
        self.ids = np.full(1, end_id, np.uint32)
        self.begin = np.arange(2)  # of each word among the ids, and where the last one's end
        self.again = np.zeros(1, bool)

    def forget(self) -> None:
        """Keep the words that were met again, the oldest of them; the end, the first, always stays."""
        self.again[0] = True
        words = list(self.at)
        kept = np.flatnonzero(self.again[: len(words)])[: max(1, self.most // 2)]
        size = self.begin[kept + 1] - self.begin[kept]
        within = np.cumsum(size) <= max(1, CACHE_IDS * self.most // 2)
        kept, size = kept[within], size[within]
        ends = np.cumsum(size)
        self.ids = self.ids[np.repeat(self.begin[kept] - ends + size, size) + np.arange(ends[-1])]
        self.begin = np.concatenate([[0], ends])
        self.again = np.zeros(len(kept), bool)
        self.at = {}  # not held beside the new one
        self.at = {words[k]: i for i, k in enumerate(kept.tolist())}

    def learn(self, words: list[bytes]) -> None:
        """Encode the words as one text; where an id's source begins tells its word."""
        texts = [w.decode() for w in words]
        encoded = self.model.encode(" ".join(texts), add_special_tokens=False)
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        source = np.fromiter((a for a, _ in encoded.offsets), np.int64)
        sizes = np.bincount(np.searchsorted(begin, source, "right") - 1, minlength=len(words))
        k, n = len(self.at), len(encoded.ids)
        used = int(self.begin[k])
        while used + n > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while k + len(words) >= len(self.begin):
            self.begin = np.concatenate([self.begin, np.empty_like(self.begin)])
        while k + len(words) > len(self.again):
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        self.ids[used : used + n] = encoded.ids
        self.begin[k + 1 : k + len(words) + 1] = used + np.cumsum(sizes)
        self.at.update(zip(words, range(k, k + len(words)), strict=True))

    def encode(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For groups of texts, all their ids one after the other, each text's with the end id
        after them, and how many ids each text has."""
        waiting: list[list[bytes]] = []
        size = 0
        for text in texts:
            words = (text or "").encode().split()  # bytes split at exactly the ASCII white space
            words.append(END)
            waiting.append(words)
            size += len(text or "")
            if size > TOGETHER:
                yield self._looked_up(waiting)
                waiting, size = [], 0
        if waiting:
            yield self._looked_up(waiting)

    def _looked_up(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.at) > self.most or self.begin[len(self.at)] > CACHE_IDS * self.most:
            self.forget()
        words = list(chain.from_iterable(texts))
        which = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        self.again[which[which >= 0]] = True
        unknown = np.flatnonzero(which < 0).tolist()
        if unknown:
            new = list({words[k]: None for k in unknown})
            for k in range(0, len(new), ENCODED):
                self.learn(new[k : k + ENCODED])
            which[unknown] = [self.at[words[k]] for k in unknown]
        begin = self.begin[which]
        sizes = self.begin[which + 1] - begin
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(begin - ends + sizes, sizes) + np.arange(ends[-1])]
        last = ends[np.cumsum([len(t) for t in texts]) - 1]
        return ids, np.diff(last, prepend=0)


_known: dict[tuple[str, int, int | None], WordTokens] = {}


def tokens_of(tokenizer: str, end_id: int = END_ID, remembered: int | None = None) -> WordTokens:
    """One memory of words per worker process."""
    key = (tokenizer, end_id, remembered)
    if key not in _known:
        _known[key] = WordTokens(*key)
    return _known[key]


def binary_lengths(lengths: np.ndarray, longest: int = MAX_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Which text, and how long, each piece is: for every text the longest length as often as it
    fits, then the powers of two of what is left, in falling order."""
    whole, rest = lengths // longest, lengths % longest
    powers = 1 << np.arange(longest.bit_length() - 2, -1, -1)
    of, power = np.nonzero(rest[:, None] & powers)
    text = np.concatenate([np.repeat(np.arange(len(lengths)), whole), of])
    size = np.concatenate([np.full(int(whole.sum()), longest), powers[power]])
    order = np.argsort(text, kind="stable")
    return text[order], size[order]


def pack(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    max_length: int = MAX_LENGTH,
    end_id: int = END_ID,
    with_ids: bool = False,
    remembered: int | None = None,
) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, bucket, sequence_id, offset)``.

    A document's ids, with ``end_id`` after them, are cut by the binary digits of their number.
    Every piece is a sequence of its own: no sequence crosses documents, none is padded, and a
    ``bucket`` (the binary logarithm of the length) holds sequences of one length, so batches
    are drawn from one bucket. A text that is NULL or empty is the end id alone.

    ``sequence_id`` has the bucket in its top bits, then the task, then a running number: no
    shuffle is needed for it, sequences of a bucket are neighbours, and a task that runs
    again over the same split gives the same ids. ``with_ids`` adds the ids themselves.
    A worker keeps up to ``remembered`` words (``CACHE_WORDS``, if not given), also while it runs
    other stages later: fewer take less memory and more time, and give the same ids.
    """
    kind = dict(docs.dtypes)["doc_id"]
    numbers = ["start", "length", "ids_crc32", "doc_tokens", "bucket", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer, end_id, remembered)
        task = TaskContext.get().partitionId()
        made = np.zeros(max_length.bit_length(), np.int64)
        for batch in batches:
            row = 0
            for ids, lengths in tokens.encode(x.as_py() for x in batch.column(1)):
                text, size = binary_lengths(lengths, max_length)
                ends = np.cumsum(size)
                begin = ends - size
                start = begin - (np.cumsum(lengths) - lengths)[text]
                bucket = np.log2(size).astype(np.int64)
                nth = np.empty_like(size)
                for b in np.unique(bucket).tolist():
                    here = np.flatnonzero(bucket == b)
                    nth[here] = made[b] + np.arange(len(here))
                    made[b] += len(here)
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                sums = [zlib.crc32(data[a:b]) for a, b in zip((4 * begin).tolist(), (4 * ends).tolist(), strict=True)]
                sequence = bucket << 58 | task << 32 | nth
                columns = [start, size, np.array(sums, np.int64), lengths[text], bucket, sequence, np.zeros_like(size)]
                arrays = [batch.column(0).take(pa.array(row + text)), *(pa.array(c, pa.int64()) for c in columns)]
                if with_ids:
                    cuts = pa.array(np.concatenate([[0], ends]), pa.int32())
                    arrays.append(pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32))))
                row += len(lengths)
                whole = pa.RecordBatch.from_arrays(arrays, names=names)
                for k in range(0, len(size), ROWS):
                    yield whole.slice(k, ROWS)

    names = ["doc_id", *numbers, *(["ids"] if with_ids else [])]
    schema = ", ".join([f"doc_id {kind}", *(f"{c} long" for c in numbers), *(["ids array<int>"] if with_ids else [])])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def write_buckets(sequences: DataFrame, path: str) -> None:
    """The sequences (packed ``with_ids``) as one folder per length, ready to batch."""
    sequences.write.partitionBy("bucket").parquet(path)
