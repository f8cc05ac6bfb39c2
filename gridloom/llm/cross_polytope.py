"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import components, hits, stored

#: Hash tables, and the buckets of each table that a vector is put in, the likeliest first. A
#: bucket joins two cross-polytope hashes where a run has vectors for so many.
TABLES, PROBES = 6, 4
THRESHOLD = 0.93
#: Vectors of one label that share a single shelf; a label with more has ``FEWEST`` shelves or more,
#: of up to twice as many with the probes, on which its vectors are put by coarser hashes of their own
#: tables and at most so many probes.
SHELF, SHELF_TABLES, SHELF_PROBES, FEWEST = 1 << 19, 2, 8, 16
#: Vectors of a shelf that a task holds of either side; fuller shelves go in pairs of blocks.
BLOCK = 1 << 20
#: The same for candidates that hang together, which move as whole vectors.
GROUP = 16_384
#: Vectors to a bucket, not counting probes, and members up to which the pairs of a group are
#: listed; the members of larger ones are compared as matrices of this many rows.
LISTED, MATRIX = 64, 1024
#: Rows hashed at once, and the width up to which a rotation is one matrix.
HASHED, DENSE = 16_384, 256
#: Components of a sketch that are multiplied first; the lengths of the others bound what they add.
HEAD = 32


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, in d log d steps."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform: one pseudo-random rotation."""
    signs = np.random.default_rng(number).choice((-1.0, 1.0), (3, x.shape[1]))
    for row in signs:
        x = hadamard(x * row)
    return x


@cache
def rotation(width: int, number: int) -> np.ndarray:
    """What ``rotated`` does to each axis: for short vectors one product is the faster transform."""
    return rotated(np.eye(width), number).astype(np.float32)


def turned(x: np.ndarray, number: int, kept: int) -> np.ndarray:
    """The first axes of the rotated rows, in single precision."""
    if x.shape[1] > DENSE:
        return rotated(x, number)[:, :kept].astype(np.float32)
    return x.astype(np.float32, copy=False) @ rotation(x.shape[1], number)[:, :kept]


def padded(x: np.ndarray) -> np.ndarray:
    """The rows with zeros up to the next power of two."""
    n, d = x.shape
    width = 1 << max(0, (d - 1).bit_length())
    return x if width == d else np.concatenate([x, np.zeros((n, width - d), x.dtype)], axis=1)


def ranked_vertices(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest vertices (signed axes) of each row, and how much further than the first."""
    n, d = x.shape
    if k > d:
        both = np.concatenate([x, -x], axis=1)
        best = np.argsort(-both, axis=1, kind="stable")[:, :k]
        value = np.take_along_axis(both, best, 1)
    else:
        size = np.abs(x)
        best = np.argpartition(-size, k - 1, axis=1)[:, :k] if k < d else np.broadcast_to(np.arange(d), (n, d))
        value = np.take_along_axis(size, best, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        best, value = np.take_along_axis(best, order, 1), np.take_along_axis(value, order, 1)
        best = best + d * (np.take_along_axis(x, best, 1) < 0)
    return best, (value[:, :1] - value) ** 2


def probed(x: np.ndarray, axes: list[int], number: int, probes: int) -> np.ndarray:
    """``(n, probes)`` cells of one table, the row's own first, -1 where there are no more.

    A cell joins one hash for each of ``axes``, that looks at so many axes of a rotated row. A
    probe swaps the vertices of hashes for the next ones; those that lose least come first.
    """
    both, lose = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1), np.float32)
    rank = np.zeros(1, np.int64)
    for h, kept in enumerate(axes):
        k = min(probes, 2 * kept)
        best, more = ranked_vertices(turned(x, number + h, kept), k)
        # Of two hashes' p-th and q-th choices, p * q pairs are no worse.
        ranks = ((rank[:, None] + 1) * (np.arange(k)[None] + 1) - 1).ravel()
        take = np.flatnonzero(ranks < probes)
        rank = ranks[take]
        both = both[:, take // k] * (2 * kept) + best[:, take % k]
        lose = lose[:, take // k] + more[:, take % k]
    order = np.argsort(lose, axis=1, kind="stable")[:, :probes]
    found = np.take_along_axis(both, order, 1)
    if found.shape[1] < probes:
        found = np.concatenate([found, np.full((len(x), probes - found.shape[1]), -1)], 1)
    return found


def hash_axes(width: int, cells: int) -> list[int]:
    """The axes that hashes look at, for about ``cells`` cells."""
    axes = [min(width, max(1, cells // 2))]
    if cells > 2 * width:
        axes.append(min(width, max(1, -(-cells // (2 * width)) // 2)))
    return axes


def bucket_keys(x: np.ndarray, tables: int, probes: int, buckets: int | None = None) -> np.ndarray:
    """``(n, tables, probes)`` bucket numbers of unit rows; the first probe is the row's own bucket.

    A table has two hashes over all axes, or about as many ``buckets`` as are asked for.
    """
    x = padded(x)
    width = x.shape[1]
    axes = hash_axes(width, buckets or (2 * width) ** 2)
    of_table = math.prod(2 * kept for kept in axes)
    out = np.empty((len(x), tables, probes), np.int64)
    for t in range(tables):
        found = probed(x, axes, 2 * t, probes)
        out[:, t] = np.where(found < 0, -1, found + t * of_table)
    return np.where(out < 0, out[:, :, :1], out)


def shelf_keys(x: np.ndarray, shelves: int, tables: int = SHELF_TABLES, probes: int = SHELF_PROBES) -> np.ndarray:
    """``(n, tables * probes)`` shelf numbers of unit rows, for about ``shelves`` shelves to a table.

    As ``bucket_keys``, with rotations of its own. Where one hash has vertices enough, one table does.
    """
    x = padded(x)
    axes = hash_axes(x.shape[1], shelves)
    out = [probed(x, axes, 1_000 + 2 * t, probes) for t in range(tables if len(axes) > 1 else 1)]
    return np.concatenate([np.where(found < 0, found[:, :1], found) + (t << 40) for t, found in enumerate(out)], axis=1)


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflows nor vanishes when squared
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def sound(column: pa.Array, labels: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and double-precision rows of the sound vectors, those of one length together.

    Vectors that are NULL, zero, empty or hold NULL or non-finite components, and rows without a
    label, are not sound.
    """
    begin = column.offsets.to_numpy()
    values = pc.cast(column.values, pa.float64()).to_numpy(zero_copy_only=False)
    size = np.where(np.asarray(column.is_valid()), np.diff(begin), 0)
    size[[i for i, label in enumerate(labels) if label is None]] = 0
    for d in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == d)
        if begin[at[-1]] - begin[at[0]] == (len(at) - 1) * d:
            x = values[begin[at[0]] : begin[at[-1]] + d].reshape(-1, d)
        else:
            x = values[begin[at][:, None] + np.arange(d)]
        good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        if good.any():
            # Minus zero is zero, so that equal vectors are equal bytes.
            yield at[good], x[good] + 0.0


class Classes:
    """Numbers of classes: equal for rows of one label and one vector, as a digest of 128 bits tells.

    The number is half of the digest; ``salt`` makes others, if two classes of a table share one.
    """

    def __init__(self, salt: int) -> None:
        self.salt = salt
        self.begun: dict[str, hashlib.blake2b] = {}

    def of(self, label: object, vector: bytes) -> bytes:
        name = f"{label!r} {len(vector)} "
        if name not in self.begun:
            if len(self.begun) > 10_000:
                self.begun.clear()
            self.begun[name] = hashlib.blake2b(name.encode(), digest_size=16, salt=self.salt.to_bytes(16, "little"))
        digest = self.begun[name].copy()
        digest.update(vector)
        return digest.digest()

    def numbers(self, labels: list, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """``(n, 2)``: the number, and the other half."""
        size, data = 8 * x.shape[1], memoryview(np.ascontiguousarray(x)).cast("B")
        found = [self.of(labels[i], data[k * size : (k + 1) * size]) for k, i in enumerate(at.tolist())]
        return np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)


def classed(vectors: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``(vec_id, label, dim, cls)`` of all rows, one row ``(cls, copies, head)`` for each class,
    and the salt of the classes' numbers.

    ``cls`` is NULL for vectors that are not ``sound``, ``head`` is the lowest ``vec_id``. The
    vectors themselves stay where they are.
    """
    kinds = dict(vectors.dtypes)
    salt = 0
    while True:

        def run(batches: Iterator[pa.RecordBatch], salt: int = salt) -> Iterator[pa.RecordBatch]:
            classes = Classes(salt)
            for batch in batches:
                labels = batch.column(1).to_pylist()
                dim, made = np.zeros(batch.num_rows, np.int32), np.zeros((batch.num_rows, 2), np.int64)
                for at, x in sound(batch.column(2), labels):
                    dim[at], made[at] = x.shape[1], classes.numbers(labels, at, x)
                none = dim == 0
                columns = [batch.column(0), batch.column(1)]
                columns += [pa.array(v, mask=none) for v in (dim, made[:, 0], made[:, 1])]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "dim", "cls", "other"])

        rows = vectors.select("vec_id", "label", "embedding").mapInArrow(
            run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, dim int, cls long, other long"
        )
        rows = stored(rows)
        classes = rows.where("cls IS NOT NULL").groupBy("cls")
        classes = classes.agg(F.count("*").alias("copies"), F.min("vec_id").alias("head"), (F.min("other") < F.max("other")).alias("shared"))
        classes = stored(classes)
        if not classes.where("shared").take(1):
            return rows.drop("other"), classes.drop("shared"), salt
        salt += 1


def shelves_of(n: int, dim: int, shelf: int = SHELF) -> int:
    """Shelves for a label of so many vectors, a power of two. One hash's, which need fewer copies,
    do for somewhat fuller shelves."""
    if n <= shelf:
        return 1
    shelves, most = FEWEST, 2 << max(0, (dim - 1).bit_length())
    while n * min(SHELF_PROBES, shelves.bit_length()) > 2 * shelf * shelves:
        shelves *= 2
    return min(shelves, most) if shelves <= 8 * most else shelves


def sketches(x: np.ndarray) -> list[bytes]:
    """Each unit row, rotated, in steps of a 127th of its largest component: one byte a component,
    then the step, and a bound of how far off that is."""
    y = turned(padded(x), 999, x.shape[1] and 1 << max(0, (x.shape[1] - 1).bit_length()))
    step = np.abs(y).max(axis=1, keepdims=True) / 127
    near = np.rint(y / step).astype(np.int8)
    off = np.linalg.norm(y - near * step, axis=1, keepdims=True) + 1e-5
    made = np.concatenate([near.view(np.uint8), np.concatenate([step, off], axis=1).astype(np.float32).view(np.uint8)], axis=1)
    data, size = made.tobytes(), made.shape[1]
    return [data[k : k + size] for k in range(0, len(data), size)]


def shelved(vectors: DataFrame, large: DataFrame, salt: int, sketch: bool = True) -> DataFrame:
    """``(label, dim, cls, unit, shelves)``: sketches of sound vectors, and their shelves.

    A label that is not ``large`` has one shelf, and its vectors go there once. Copies are left
    out where a task meets them again.
    """
    sized = vectors.select("label", "embedding", F.size("embedding").alias("dim")).join(F.broadcast(large), ["label", "dim"], "left")

    shelf = SHELF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(salt)
        seen: set[int] = set()
        for batch in batches:
            labels, sizes = batch.column(0).to_pylist(), np.array([n or 0 for n in batch.column(2).to_pylist()], np.int64)
            for at, x in sound(batch.column(1), labels):
                cls = classes.numbers(labels, at, x)[:, 0]
                new = [k for k, c in enumerate(cls.tolist()) if not (c in seen or seen.add(c))]
                at, x, cls = at[new], units(x[new]), cls[new]
                for n in np.unique(sizes[at]).tolist():
                    mine = np.flatnonzero(sizes[at] == n)
                    shelves = shelves_of(n, x.shape[1], shelf)
                    # Any further probe than these finds nothing more where shelves are few.
                    probes = min(SHELF_PROBES, shelves.bit_length())
                    keys = np.zeros((len(mine), 1), np.int64) if shelves == 1 else shelf_keys(x[mine], shelves, probes=probes)
                    columns = [
                        batch.column(0).take(pa.array(at[mine])),
                        pa.array(np.full(len(mine), x.shape[1], np.int32)),
                        pa.array(cls[mine]),
                        pa.array(sketches(x[mine]) if sketch else [b""] * len(mine), pa.binary()),
                        pa.ListArray.from_arrays(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32), pa.array(keys.ravel())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["label", "dim", "cls", "unit", "shelves"])

    kind = dict(vectors.dtypes)["label"]
    made = sized.select("label", "embedding", "n").mapInArrow(run, f"label {kind}, dim int, cls long, unit binary, shelves array<long>")
    return made.withColumn("shelf", F.explode(F.array_distinct("shelves"))).drop("shelves")


def paired(rows: DataFrame, block: int, of: str = "cls") -> DataFrame:
    """The rows of runs with ``n`` rows once for each pair ``(i, j)`` of the run's blocks; ``right``
    are those of the second."""
    blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1))
    rows = rows.withColumn("of", F.pmod(F.xxhash64(of), blocks))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    i, j = F.least("of", "with").cast("int"), F.greatest("of", "with").cast("int")
    pair = [i.alias("i"), j.alias("j"), (F.col("of") > F.col("with")).alias("right")]
    return rows.select(*(c for c in rows.columns if c not in ("n", "of", "with")), *pair)


def by_run(rows: DataFrame, run_of: list[str], compare: Callable[[list, list], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``compare`` makes of the rows, sorted by run, and of the bounds of the runs among them.

    It gets whole runs as the one table of a list, from which it may take it away.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, *run_of).sortWithinPartitions(*run_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def whole() -> Iterator[pa.RecordBatch]:
            tables = [pa.Table.from_batches(held)]
            held.clear()
            yield from compare(tables, _runs(tables[0], run_of))

        for batch in batches:
            if not batch.num_rows:
                continue
            last = _runs(pa.Table.from_batches([batch]), run_of)[-1][0]
            if last or (held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in run_of)):
                if last:
                    held.append(batch.slice(0, last))
                yield from whole()
            held.append(batch.slice(last))
        if held:
            yield from whole()

    return rows.mapInArrow(run, schema)


def candidates(vectors: DataFrame, rows: DataFrame, salt: int, threshold: float, tables: int, probes: int) -> DataFrame:
    """Pairs ``(a, b)`` of classes that hang together as all pairs do whose buckets meet and whose
    sketches may be as near as ``threshold``.

    A vector moves as a sketch once for each of its shelves (one, unless its label is large), and its
    buckets are made where it arrives. Full shelves are cut into blocks.
    """
    sized = rows.where("cls IS NOT NULL").groupBy("label", "dim").agg(F.count("*").alias("n"))
    large = stored(sized.where(F.col("n") > SHELF))
    run_of = ["label", "dim", "shelf"]
    moved = shelved(vectors, large, salt)
    if SHELF > BLOCK or large.take(1):
        full = shelved(vectors, large, salt, sketch=False).groupBy(*run_of).agg(F.count("*").alias("n"))
        moved = moved.join(F.broadcast(stored(full.where(F.col("n") > BLOCK))), run_of, "left")
    else:
        moved = moved.withColumn("n", F.lit(1))

    def compare(held: list[pa.Table], runs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        parts = [held[0].slice(begin, end - begin) for begin, end in reversed(runs)]
        held.clear()
        while parts:
            a, b = _candidates([parts.pop()], threshold, tables, probes)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return stored(by_run(paired(moved, BLOCK), [*run_of, "i", "j"], compare, "a long, b long"))


def linked_pairs(vectors: DataFrame, classes: DataFrame, salt: int, edges: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Exact links among candidates: ``(cls, links)`` sums, and ``(a, b)`` edges that span them.

    Every vector with a candidate moves as a whole to those that it hangs together with, where all
    pairs are compared once. Large groups are cut into blocks, and each pair of blocks is a run. A task
    adds up links without listing them, and hands on no more edges than join what its links join.
    """
    groups = components(edges).select(F.col("id").alias("cls"), F.col("component").alias("group"))
    wanted = hits(classes, ["cls"], groups, ["cls"]).where("hit").select("cls", "copies")
    groups = stored(wanted.join(groups, "cls"))
    full = groups.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > GROUP)
    single = dict(vectors.dtypes)["embedding"] == "array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Classes(salt)
        seen: set[int] = set()
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for at, x in sound(batch.column(1), labels):
                cls = made.numbers(labels, at, x)[:, 0]
                new = [k for k, c in enumerate(cls.tolist()) if not (c in seen or seen.add(c))]
                x = x[new].astype(np.float32) if single else x[new]
                data, size = x.tobytes(), x.itemsize * x.shape[1]
                v = [data[k : k + size] for k in range(0, len(data), size)]
                yield pa.RecordBatch.from_arrays([pa.array(cls[new]), pa.array(v, pa.binary())], names=["cls", "v"])

    whole = vectors.select("label", "embedding").mapInArrow(run, "cls long, v binary")
    whole = hits(whole, ["cls"], groups, ["cls"]).where("hit").select("cls", "v")
    moved = whole.join(groups, "cls").join(F.broadcast(stored(full)), "group", "left")

    def compare(held: list[pa.Table], runs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        for a, b, links in _linked(held[0], runs, threshold, np.float32 if single else np.float64):
            columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "links"])

    found = stored(by_run(paired(moved, GROUP), ["group", "i", "j"], compare, "a long, b long, links long"))
    sums = found.where("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    return sums, found.where("b IS NOT NULL").select("a", "b").distinct()


def _runs(table: pa.Table, columns: list[str]) -> list[tuple[int, int]]:
    if not len(table):
        return []
    new = np.zeros(len(table), bool)
    new[0] = True
    for name in columns:
        key = table.column(name).to_numpy(zero_copy_only=False)
        new[1:] |= key[1:] != key[:-1]
    begin = np.flatnonzero(new)
    return list(zip(begin.tolist(), [*begin[1:].tolist(), len(table)], strict=True))


class Joined:
    """Which of ``n`` rows hang together, and the edges that made them."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def roots(self, rows: np.ndarray) -> np.ndarray:
        found = self.root[rows]
        while True:
            up = self.root[found]
            if (up == found).all():
                break
            found = up
        self.root[rows] = found
        return found

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        u, v = self.roots(a), self.roots(b)
        apart = np.flatnonzero(u != v)
        if not len(apart):
            return
        codes, first = np.unique(np.minimum(u[apart], v[apart]) * len(self.root) + np.maximum(u[apart], v[apart]), return_index=True)
        root, kept = self.root, []
        for at, u, v in zip(apart[first].tolist(), (codes // len(root)).tolist(), (codes % len(root)).tolist(), strict=True):
            while root[u] != u:
                root[u] = u = root[root[u]]
            while root[v] != v:
                root[v] = v = root[root[v]]
            if u != v:
                root[v] = u
                kept.append(at)
        self.edges.append((a[kept], b[kept]))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *(e[side] for e in self.edges)]) for side in (0, 1))

    def near(self, rows: np.ndarray, columns: np.ndarray, near: np.ndarray) -> None:
        """Joins the rows and columns of a matrix of links."""
        if np.count_nonzero(near) > 4 * sum(near.shape):
            u, v = map(np.array, zip(*_spanning(near), strict=True))
        else:
            u, v = np.nonzero(near)
        if len(u):
            self.join(rows[u], columns[v])


def _spanning(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges (row, column) that join what a matrix of links joins, rows and columns being apart."""
    edges = []
    rows_left, columns_left = near.any(axis=1), near.any(axis=0)
    for start in range(len(near)):
        if not rows_left[start]:
            continue
        rows_left[start] = False
        waiting = [start]
        while waiting:
            row = waiting.pop()
            columns = np.flatnonzero(near[row] & columns_left)
            columns_left[columns] = False
            edges += [(row, c) for c in columns.tolist()]
            if not len(columns):
                continue
            reached = near[:, columns] & rows_left[:, None]
            rows = np.flatnonzero(reached.any(axis=1))
            edges += [(r, int(columns[reached[r].argmax()])) for r in rows.tolist()]
            rows_left[rows] = False
            waiting += rows.tolist()
    return edges


def _bytes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """``(n, size)`` bytes of binaries of one size."""
    parts = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(chunk):
            _, ends, data = chunk.buffers()
            wide = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
            ends = np.frombuffer(ends, wide)[chunk.offset : chunk.offset + len(chunk) + 1]
            parts.append(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].reshape(len(chunk), -1))
    return np.concatenate(parts)


class Sketches:
    """The rows of ``sketches``: as unit vectors, but for what the bytes leave off."""

    def __init__(self, data: np.ndarray) -> None:
        self.near = np.ascontiguousarray(data[:, :-8]).view(np.int8)
        self.step, self.off = np.ascontiguousarray(data[:, -8:]).view(np.float32).T
        self.head = min(HEAD, self.near.shape[1])
        self.front = np.ascontiguousarray(self.near[:, : self.head])
        #: How long the components after the first are.
        self.rest = np.empty(len(data), np.float32)
        for lo in range(0, len(data), HASHED):
            x = self.units(np.arange(lo, min(len(data), lo + HASHED)))[:, self.head :]
            self.rest[lo : lo + HASHED] = np.sqrt(np.einsum("ij,ij->i", x, x))

    def units(self, rows: np.ndarray) -> np.ndarray:
        return self.near.take(rows, axis=0) * self.step[rows][:, None]

    def bounds(self, rows: np.ndarray) -> np.ndarray:
        """Rows of a product that is no less than that of ``units``, and cheaper."""
        out = np.empty((len(rows), self.head + 1), np.float32)
        np.multiply(self.front.take(rows, axis=0), self.step[rows][:, None], out=out[:, :-1])
        out[:, -1] = self.rest[rows]
        return out

    def cut(self, rows: np.ndarray, threshold: float) -> float:
        """No two of the rows have a cosine of ``threshold`` if their sketches' product is below."""
        off = float(self.off[rows].max())
        return threshold - 2 * off - 3 * off * off - 1e-5

    def meet(self, p: np.ndarray, q: np.ndarray, bound: tuple[np.ndarray, np.ndarray], cut: float, joined: Joined) -> None:
        """Joins the rows ``p`` to those of ``q`` (others, or the same) whose product is ``cut`` or more."""
        product = bound[0] @ (bound[1].copy() if p is q else bound[1]).T  # a slower routine is taken for one matrix
        if p is q:
            np.fill_diagonal(product, -2)
        if product.max() < cut:
            return
        at = np.flatnonzero(product >= cut)
        if len(at) > product.size // 32:
            joined.near(p, q, self.units(p) @ self.units(q).T >= cut)
            return
        u, v = p[at // len(q)], q[at % len(q)]
        apart = np.flatnonzero(joined.root[u] != joined.root[v])
        u, v = u[apart], v[apart]
        near = np.einsum("ij,ij->i", self.units(u), self.units(v)) >= cut
        if near.any():
            joined.join(u[near], v[near])


def _candidates(held: list[pa.Table], threshold: float, tables: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the pairs of one run, the only table of a list, which share a bucket and may be near."""
    table = held.pop()
    cls, at = np.unique(table.column("cls").to_numpy(), return_index=True)  # copies come from other tasks
    n = len(cls)
    if n < 2:
        return cls[:0], cls[:0]
    right = None
    if table.column("i")[0].as_py() != table.column("j")[0].as_py():
        right = table.column("right").to_numpy()[at]
    data = _bytes(table.column("unit"))
    del table
    sketch = Sketches(data[at])
    del data
    joined = Joined(n)
    buckets = 1 << (-(-n // LISTED) - 1).bit_length()
    width = sketch.near.shape[1]
    axes = hash_axes(width, buckets)
    for t in range(tables if buckets > 1 else 1):
        rows, bounds = np.arange(n), [0, n]
        if buckets > 1:
            keys = np.empty((n, probes), np.int32)
            for lo in range(0, n, HASHED):
                keys[lo : lo + HASHED] = probed(sketch.units(np.arange(lo, min(n, lo + HASHED))), axes, 2 * t, probes)
            keys = keys.ravel()
            rows = np.argsort(keys, kind="stable").astype(np.int32)
            keys = keys[rows]
            bounds = [*np.flatnonzero(np.concatenate([keys[:1] >= 0, keys[1:] != keys[:-1]])).tolist(), n * probes]
            rows //= probes
            del keys
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            if end - begin > 1:
                _meet(rows[begin:end], sketch, right, joined, threshold)
    a, b = joined.pairs()
    return cls[a], cls[b]


def _meet(rows: np.ndarray, sketch: Sketches, right: np.ndarray | None, joined: Joined, threshold: float) -> None:
    """Joins the rows of a bucket that may be near: all pairs are compared, but for those which hang
    together already."""
    if right is not None and right[rows].all() == right[rows].any():
        return  # pairs of one side are another run's
    cut = sketch.cut(rows, threshold)
    if len(rows) > MATRIX:
        # Whatever is near one of a few rows hangs together; what is left of a large group is little.
        some = rows[:: max(1, len(rows) // 32)]
        leaders = sketch.units(some)
        for lo in range(0, len(rows), HASHED):
            p = rows[lo : lo + HASHED]
            u, v = np.nonzero(sketch.units(p) @ leaders.T >= cut)
            joined.join(p[u], some[v])
    root = joined.root[rows]
    if (root == root[0]).all():
        return
    if len(rows) <= MATRIX and np.count_nonzero(root == rows) > len(rows) // 2:
        bound = sketch.bounds(rows)
        sketch.meet(rows, rows, (bound, bound), cut, joined)
        return
    # In blocks that end where a large group does.
    root = joined.roots(rows)
    order = np.argsort(root, kind="stable")
    rows, root = rows[order], root[order]
    edge = np.flatnonzero(np.concatenate([[True], root[1:] != root[:-1]]))
    size = np.diff(np.append(edge, len(rows)))
    big = size > LISTED
    cuts = np.unique(np.concatenate([edge[big], (edge + size)[big], np.arange(0, len(rows), MATRIX), [len(rows)]])).tolist()
    bound = sketch.bounds(rows)
    blocks = [(rows[lo:hi], bound[lo:hi], int(root[lo]) if root[lo] == root[hi - 1] else -1) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    for k, (p, of_p, one) in enumerate(blocks):
        for q, of_q, other in blocks[k:]:
            if one < 0 or one != other:
                sketch.meet(p, q, (of_p, of_q), cut, joined)


def _linked(table: pa.Table, runs: list[tuple[int, int]], threshold: float, kind: type) -> Iterator[tuple]:
    """Columns ``(cls, None, links)`` and ``(a, b, None)`` of the pairs that runs own.

    Short runs of one length are compared together.
    """
    cls, copies = (table.column(c).to_numpy() for c in ("cls", "copies"))
    right, i, j = (table.column(c).to_numpy(zero_copy_only=False) for c in ("right", "i", "j"))
    size = pc.binary_length(table.column("v")).to_numpy()
    short: dict[int, list[tuple[int, int]]] = {}
    for begin, end in runs:
        if i[begin] == j[begin] and end - begin <= LISTED:
            short.setdefault(int(size[begin]), []).append((begin, end))
    parts = [(np.concatenate([np.arange(*r) for r in some]), np.repeat(np.arange(len(some)), [e - b for b, e in some])) for some in short.values()]
    parts += [(np.arange(b, e), None) for b, e in runs if not (i[b] == j[b] and e - b <= LISTED)]
    for at, run in parts:
        _, first = np.unique(cls[at] if run is None else np.stack([run, cls[at]]), axis=-1, return_index=True)
        first.sort()
        at, run = at[first], None if run is None else run[first]  # copies come from other tasks
        v = table.column("v").take(pa.array(at))
        x = units(_bytes(v).view(kind).astype(np.float64))
        many, total, joined = copies[at], np.zeros(len(at), np.int64), Joined(len(at))
        if run is not None:
            for lag in range(1, int(np.bincount(run).max())):
                a = np.flatnonzero(run[lag:] == run[:-lag])
                a = a[np.einsum("ij,ij->i", x[a], x[a + lag]) >= threshold]
                np.add.at(total, a, many[a + lag])
                np.add.at(total, a + lag, many[a])
                joined.join(a, a + lag)
        else:
            _compare(x, many, right[at] if i[at[0]] != j[at[0]] else None, threshold, total, joined)
        have, (a, b) = np.flatnonzero(total), joined.pairs()
        yield (
            [*cls[at[a]].tolist(), *cls[at[have]].tolist()],
            [*cls[at[b]].tolist(), *[None] * len(have)],
            [*[None] * len(a), *total[have].tolist()],
        )


def _compare(x: np.ndarray, copies: np.ndarray, right: np.ndarray | None, threshold: float, total: np.ndarray, joined: Joined) -> None:
    """Adds up the links of a run, matrix by matrix. Products in single precision decide but for
    those that are too close to the threshold."""
    z = x.astype(np.float32)
    close = (x.shape[1] + 8) * 1.2e-7
    ones = bool((copies == 1).all())
    every = np.arange(len(x))
    sides = (every, every) if right is None else (np.flatnonzero(~right), np.flatnonzero(right))
    for lo in range(0, len(sides[0]), MATRIX):
        p = sides[0][lo : lo + MATRIX]
        for hi in range(lo if right is None else 0, len(sides[1]), MATRIX):
            q = sides[1][hi : hi + MATRIX]
            product = z[p] @ z[q].T
            near = product >= threshold
            u, v = np.nonzero(np.abs(product - np.float32(threshold)) <= close)
            near[u, v] = np.einsum("ij,ij->i", x[p[u]], x[q[v]]) >= threshold
            if right is None and lo == hi:
                near &= np.arange(len(p))[:, None] < np.arange(len(q))[None]
            if not near.any():
                continue
            if ones:
                total[p] += np.count_nonzero(near, axis=1)
                total[q] += np.count_nonzero(near, axis=0)
            else:
                total[p] += near @ copies[q]
                total[q] += copies[p] @ near
            ends = joined.roots(np.concatenate([p, q]))
            if (ends != ends[0]).any():
                joined.near(p, q, near)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``(vec_id, embedding, label)``.

    Vectors of one label link at a cosine of ``threshold`` or more, in double precision; every
    pair that shares a bucket (and, of a large label, a shelf) is checked. Copies of a vector are compared once, and each counts
    as a link. Vectors that are not ``sound`` have no links and are kept. The table is read several times.
    """
    rows, classes, salt = classed(vectors)
    found = candidates(vectors, rows, salt, threshold, tables, probes)
    sums, edges = linked_pairs(vectors, classes, salt, found, threshold)
    groups = components(edges).select(F.col("id").alias("cls"), F.col("component").alias("group"))
    linked = hits(classes, ["cls"], groups, ["cls"]).where("hit").select("cls", "head").join(groups, "cls")
    heads = linked.groupBy("group").agg(F.min("head").alias("component_id"))
    linked = groups.join(sums, "cls", "left").join(heads, "group").select("cls", "links", "component_id", F.lit(True).alias("linked"))
    of_class = classes.join(linked, "cls", "left").select(
        "cls",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("head")).alias("component_id"),
    )
    together = rows.where("cls IS NOT NULL").join(of_class, "cls").select("vec_id", "n_links", "component_id")
    alone = rows.where("cls IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = together.union(alone)
    return out.select("vec_id", "n_links", F.col("component_id").cast("long"), F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
