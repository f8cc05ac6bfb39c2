"""Word shingles of whole texts as 64-bit hashes, computed over arrays of bytes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np

from gridloom.llm.common import WHITE

#: Bytes of text that are hashed at once; longer texts are cut between words.
SLICE = 1 << 19

_IS_WHITE = np.isin(np.arange(256), list(WHITE.encode()))
_AFTER_SLICE = re.compile(rb"[\x20\x09-\x0d]")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def numbers(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = numbers(1, 256)
_ROOT = int(numbers(2, 1)[0]) | 1
_powers: list[np.ndarray] = []


def _powers_of(root: int, n: int) -> np.ndarray:
    out = np.full(n, root, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the root and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * SLICE)
        _powers[:] = [_powers_of(_ROOT, size), _powers_of(pow(_ROOT, -1, 1 << 64), size)]
    return _powers[0], _powers[1]


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and where it begins."""
    codes = np.frombuffer(data, np.uint8)
    white = _IS_WHITE[codes]
    edge = np.flatnonzero(np.diff(white, prepend=True, append=True))
    begin, end = edge[0::2], edge[1::2]
    power, inverse = _tables(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTE[codes] * power[: len(codes)], out=total[1:])
    h = (total[end] - total[begin]) * inverse[begin]
    return mix(h + (end - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), begin


def _long_words(data: bytes) -> np.ndarray:
    """Hashes of the words of one long text, slice by slice."""
    parts, at = [], 0
    while at < len(data):
        cut = _AFTER_SLICE.search(data, min(at + SLICE, len(data)))
        to = cut.start() if cut else len(data)
        parts.append(_hash_words(data[at:to])[0])
        at = to
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def word_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The hashes of the words of each text, A-Z lower-cased; short texts are hashed together."""
    waiting: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        hashes, begin = _hash_words(b"\n".join(waiting))
        starts = np.cumsum([0] + [len(w) + 1 for w in waiting])
        cuts = np.searchsorted(begin, starts)
        yield from (hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))

    for text in texts:
        data = (text or "").encode().lower()
        if size + len(data) > SLICE and waiting:
            yield from flush()
            waiting, size = [], 0
        if len(data) > SLICE:
            yield _long_words(data)
        else:
            waiting.append(data)
            size += len(data)
    if waiting:
        yield from flush()


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """The distinct shingles, sorted; fewer words are one shingle as a whole, none are none."""
    if not len(words):
        return words
    n = max(len(words) - width + 1, 1)
    h = np.full(n, min(len(words), width), np.uint64)
    for k in range(min(width, len(words))):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return np.unique(h)


def shingle_sets(texts: list[str | None], width: int = 5) -> Iterator[np.ndarray]:
    return (shingle_set(words, width) for words in word_hashes(texts))


def fingerprint(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
