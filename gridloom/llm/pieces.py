"""Encoding by a SentencePiece BPE model, with the place of every piece in the original bytes.

The model file is read here; its normalisation, its merges and the projection of pieces back
to the text are done by this module. Ids of plain texts are decoded here as well, by what each
of them stands for; the tests hold that to the library's decoding.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"  # stands for a space inside pieces
NORMAL, UNKNOWN, BYTE = 1, 2, 6
#: Chunks that a task remembers before it starts afresh, and the longest of them in characters.
CACHE_CHUNKS, CACHE_CHARS = 1 << 20, 64
#: Pieces that such a memory may hold in all, and characters of text that are looked up together.
CACHE_PIECES, TOGETHER = 1 << 24, 1 << 20


class CharacterMap:
    """The compiled character map of a model: a double-array trie and the strings it leads to.

    A blob holds the trie's size in bytes, its units and the NUL-ended replacements. In a unit,
    bits 0-7 and 31 are the label, bit 8 tells that a value follows, and bits 10-30 are the
    offset to the children, in steps of 256 where bit 9 is set; a value's unit holds a place
    among the replacements.
    """

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """What the longest key that begins at ``at`` becomes, and that key's length."""
        if not self.units:
            return None
        units, found = self.units, None
        node = 0
        step = lambda u: (u >> 10) << ((u & 1 << 9) >> 6)
        node ^= step(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & (1 << 31 | 0xFF) != data[i]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                place = units[node] & (1 << 31) - 1
                found = (self.strings[place : self.strings.index(b"\0", place)], i + 1 - at)
        return found


@dataclass
class Normalizer:
    """Replaces by the longest matching prefix and remembers where each byte came from."""

    characters: CharacterMap
    dummy_prefix: bool = True
    remove_extra: bool = False
    escape: bool = True

    def __call__(self, text: str) -> tuple[bytes, list[int]]:
        """The normal form, and for each of its bytes (and its end) the original byte's place.

        Bytes that stay have their own places, those of a replacement that of the key's begin.
        """
        data = text.encode()
        space = SPACE.encode() if self.escape else b" "
        out, align = bytearray(), []

        def put(piece: bytes, at: int, own: bool = False) -> None:
            out.extend(piece)
            align.extend(range(at, at + len(piece)) if own else [at] * len(piece))

        at = 0
        if self.remove_extra:
            while at < len(data):
                piece, used = self._next(data, at)
                if piece != b" ":
                    break
                at += used
        if at == len(data):
            return b"", [at]
        if self.dummy_prefix:
            put(space, at)
        blank = self.remove_extra
        while at < len(data):
            piece, used = self._next(data, at)
            while blank and piece.startswith(b" "):
                piece = piece[1:]
            if piece:
                if piece == data[at : at + used] and b" " not in piece:
                    put(piece, at, own=True)
                else:
                    for char in piece.decode():
                        put(space if char == " " else char.encode(), at)
                blank = self.remove_extra and piece.endswith(b" ")
            at += used
        if self.remove_extra:
            while out.endswith(space):
                at = align[-1]
                del out[-len(space) :], align[-len(space) :]
        return bytes(out), [*align, at]

    def _next(self, data: bytes, at: int) -> tuple[bytes, int]:
        if found := self.characters.longest(data, at):
            return found
        size = 1 + sum(data[at] >= lead for lead in (0xC0, 0xE0, 0xF0))
        return data[at : at + size], size


class PieceModel:
    """A BPE model of normal and byte pieces."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as format

        model = format.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or kinds - {1, 2, 3, 6} or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models without user-defined or unused pieces are known here")
        spec = model.normalizer_spec
        self.normalizer = Normalizer(
            CharacterMap(spec.precompiled_charsmap),
            spec.add_dummy_prefix,
            spec.remove_extra_whitespaces,
            spec.escape_whitespaces,
        )
        self.cost = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.decode = SentencePieceProcessor(model_file=path).decode
        # Where no piece crosses a place, the text can be cut there without a change of ids.
        self.cut_spaces = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        self.cut_lines = all("\n" not in p or p == "\n" for p in self.ids)
        self.plain = not self.normalizer.characters.units and spec.add_dummy_prefix and spec.escape_whitespaces
        self.plain = self.plain and not spec.remove_extra_whitespaces and self.cut_spaces and self.cut_lines and SPACE in self.ids
        self.plain = self.plain and len(self.bytes) == 256
        self.known: dict[str, tuple[tuple[int, ...], str, tuple[int, ...]]] = {}

    def merge(self, text: str) -> list[str]:
        """The symbols left when no two neighbours form a piece; best score first, then leftmost."""
        return self._merge_long(text) if len(text) > CACHE_CHARS else self._merge_short(text)

    def _merge_short(self, text: str) -> list[str]:
        """By a list of the scores of all neighbours, which is searched anew for each merge."""
        cost, none = self.cost.get, float("inf")
        symbols = list(text)
        costs = [cost(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while costs and (least := min(costs)) < none:
            i = costs.index(least)
            symbols[i] += symbols.pop(i + 1)
            del costs[i]
            if i < len(costs):
                costs[i] = cost(symbols[i] + symbols[i + 1], none)
            if i:
                costs[i - 1] = cost(symbols[i - 1] + symbols[i], none)
        return symbols

    def _merge_long(self, text: str) -> list[str]:
        """By a heap of neighbours, in a time that grows little faster than the text."""
        symbols: list[str] = list(text)
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < len(symbols):
                both = symbols[left] + symbols[after[left]]
                if both in self.cost:
                    heapq.heappush(heap, (self.cost[both], left, both))

        for i in range(len(symbols) - 1):
            offer(i)
        while heap:
            _, left, both = heapq.heappop(heap)
            right = after[left]
            if not symbols[left] or right >= len(symbols) or symbols[left] + symbols[right] != both:
                continue
            symbols[left], symbols[right] = both, ""
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [s for s in symbols if s]

    def chunk(self, text: str) -> tuple[tuple[int, ...], str, tuple[int, ...]]:
        """Ids of a normalised chunk, the same as decimal text, and the normalised bytes of each."""
        if got := self.known.get(text):
            return got
        ids: list[int] = []
        sizes: list[int] = []
        for symbol in self.merge(text):
            data = symbol.encode()
            if symbol in self.ids:
                ids.append(self.ids[symbol])
                sizes.append(len(data))
            elif self.bytes:
                ids.extend(self.bytes[b] for b in data)
                sizes.extend([1] * len(data))
            else:
                ids.append(self.unknown)
                sizes.append(len(data))
        got = (tuple(ids), ",".join(map(str, ids)), tuple(sizes))
        if len(text) <= CACHE_CHARS:
            if len(self.known) >= CACHE_CHUNKS:
                self.known.clear()
            self.known[text] = got
        return got

    def chunks(self, normal: str) -> list[str]:
        """The normal form cut where no piece can cross; spaces in a row stay together."""
        if not self.cut_spaces:
            return [normal] if normal else []
        lines = re.split("(\n)", normal) if self.cut_lines else [normal]
        return [c for line in lines for c in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", line)]

    def encode(self, text: str) -> tuple[list[tuple[tuple[int, ...], str, tuple[int, ...]]], bool]:
        """The chunks of a text; whether every normal byte stands for itself or is a space."""
        if self.plain:
            if not text:
                return [], True
            normal = SPACE + text.replace(" ", SPACE)
            if f"{SPACE}{SPACE}" not in normal and SPACE not in text:
                spaced = normal.replace(SPACE, f" {SPACE}").replace("\n", " \n ").split(" ")
                return [self.known.get(c) or self.chunk(c) for c in spaced if c], True
            return [self.chunk(c) for c in self.chunks(normal)], SPACE not in text
        return [self.chunk(c) for c in self.chunks(self.normalizer(text)[0].decode())], False

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """``(id, begin, end)`` of each piece, in bytes of the original text.

        A piece reaches from the source of its first normal byte to that of the byte after it;
        the dummy prefix has no source bytes, and a character in byte pieces is shared out.
        """
        found, _ = self.encode(text)
        _, align = self.normalizer(text)
        out, at = [], 0
        for ids, _, sizes in found:
            for piece, size in zip(ids, sizes, strict=True):
                out.append((piece, align[at], align[at + size]))
                at += size
        return out


    def normal(self, text: str) -> list[str] | None:
        """The chunks of a text whose normal form only adds a space and writes spaces as pieces have
        them; None for any other, which the normaliser has to see."""
        if not self.plain or SPACE in text:
            return None
        if not text:
            return []
        normal = SPACE + text.replace(" ", SPACE)
        if f"{SPACE}{SPACE}" in normal:
            return self.chunks(normal)
        return [c for c in normal.replace(SPACE, f" {SPACE}").replace("\n", " \n ").split(" ") if c]


class ChunkTable:
    """The ids of the chunks of plain texts, one after the other, and where each chunk's begin.

    What follows from ids alone is kept by id: decimal text, decoded bytes, and the bytes of the
    original text that a piece covers. Byte pieces never cross a character, and decoding drops the
    first space of a text, so a text is decoded by joining the bytes of its ids.
    """

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        n = 1 + max(*model.ids.values(), *model.bytes.values(), model.unknown)
        self.decimal = [b"%d" % i for i in range(n)]
        self.decoded = [b""] * n
        self.covers = np.zeros(n, np.int32)
        for piece, i in model.ids.items():
            self.decoded[i] = piece.replace(SPACE, " ").encode()
        for byte, i in model.bytes.items():
            self.decoded[i] = bytes([byte])
        self.covers[:] = [len(d) for d in self.decoded]
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.begin = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def learn(self, chunks: list[str]) -> None:
        """Merge chunks that are not known yet."""
        model, k = self.model, len(self.at)
        ids: list[int] = []
        counts: list[int] = []
        for chunk in chunks:
            before = len(ids)
            for symbol in model.merge(chunk):
                if (piece := model.ids.get(symbol)) is not None:
                    ids.append(piece)
                else:
                    ids.extend(model.bytes[b] for b in symbol.encode())
            counts.append(len(ids) - before)
        while k + len(chunks) > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.at.update(zip(chunks, range(k, k + len(chunks)), strict=True))
        self.count[k : k + len(chunks)] = counts
        self.begin[k : k + len(chunks)] = self.used + np.cumsum([0, *counts[:-1]])
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def report(self, texts: list[list[str]]) -> Iterator[tuple[int, str, str, int]]:
        """Number of ids, digests of ids and decoded text, and checksum of the ends of all pieces."""
        if len(self.at) > CACHE_CHUNKS or self.used > CACHE_PIECES:
            self.forget()
        chunks = list(chain.from_iterable(texts))
        which = np.fromiter(map(self.at.get, chunks, repeat(-1)), np.int64, len(chunks))
        unknown = np.flatnonzero(which < 0).tolist()
        if unknown:
            self.learn(list({chunks[i]: None for i in unknown}))
            which[unknown] = [self.at[chunks[i]] for i in unknown]
        begin, count = self.begin[which], self.count[which]
        at = 0
        for text in texts:
            to = at + len(text)
            b, n = begin[at:to], count[at:to]
            last = np.cumsum(n)
            ids = self.ids[np.repeat(b - last + n, n) + np.arange(last[-1] if len(n) else 0)]
            listed = ids.tolist()
            # The first byte counted is that of the prefix, which is not in the text.
            ends = np.cumsum(self.covers[ids], dtype=np.int64) - 1
            yield (
                len(listed),
                hashlib.sha256(b",".join(map(self.decimal.__getitem__, listed))).hexdigest(),
                hashlib.sha256(b"".join(map(self.decoded.__getitem__, listed))[1:]).hexdigest(),
                zlib.crc32(ends.astype("<i8", copy=False).tobytes()),
            )
            at = to


_model: dict[str, PieceModel] = {}
_table: dict[str, ChunkTable] = {}


def model_of(name: str) -> PieceModel:
    """One model per worker process."""
    if name not in _model:
        _model[name] = PieceModel(public_tokenizers.path(name))
    return _model[name]


def table_of(name: str) -> ChunkTable:
    """One memory of chunks per worker process."""
    if name not in _table:
        _table[name] = ChunkTable(model_of(name))
    return _table[name]


def reports(texts: Iterable[str | None], model: str) -> Iterator[tuple[int, str, str, int]]:
    """``ChunkTable.report`` of each text, plain ones together; others go by the normaliser."""
    pieces, table = model_of(model), table_of(model)
    waiting: list[list[str] | str] = []
    size = 0

    def flush() -> Iterator[tuple[int, str, str, int]]:
        plain = table.report([w for w in waiting if not isinstance(w, str)])
        for w in waiting:
            yield odd_report(pieces, w) if isinstance(w, str) else next(plain)

    for text in texts:
        text = text or ""
        chunks = pieces.normal(text)
        waiting.append(text if chunks is None else chunks)
        size += len(text)
        if size > TOGETHER:
            yield from flush()
            waiting, size = [], 0
    yield from flush()


def odd_report(pieces: PieceModel, text: str) -> tuple[int, str, str, int]:
    """The same for a text that the normaliser has to see."""
    spans = pieces.spans(text)
    ids = [i for i, _, _ in spans]
    ends = np.array([end for _, _, end in spans], "<i8")
    return (
        len(ids),
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(pieces.decode(ids).encode()).hexdigest(),
        zlib.crc32(ends.tobytes()),
    )


def plain_spans(found: list, text: str) -> np.ndarray:
    """Ends of all pieces in original bytes, where the normal form only writes spaces as three bytes."""
    sizes = np.fromiter(chain.from_iterable(f[2] for f in found), np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(text.encode(), np.uint8)
    # Normal place of the end of each original byte: three per space, and three of the prefix.
    normal = 3 + np.cumsum(np.where(data == 0x20, 3, 1))
    return np.searchsorted(normal, ends, "right")


def encoded(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32)`` of each whole text.

    NULL is the empty text, which has no ids. ``spans_crc32`` covers the end of each piece in
    the original UTF-8 bytes, as little-endian 64-bit numbers; a piece begins where the last one ended.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(reports((text.as_py() for text in batch.column(1)), model))
            n, a, b, c = zip(*rows, strict=True) if rows else ((), (), (), ())
            arrays = [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(c, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def piece_rows(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """``(doc_id, pieces)``: each text's ids with their begin and end in its UTF-8 bytes."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model_of(model)
        inner = pa.struct([("id", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            rows = [
                [dict(zip(("id", "begin", "end"), s, strict=True)) for s in pieces.spans(x.as_py() or "")]
                for x in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(inner))], names=["doc_id", "pieces"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, pieces array<struct<id:int,begin:bigint,end:bigint>>"
    )
