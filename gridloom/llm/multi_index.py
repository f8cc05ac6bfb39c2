"""Approximate nearest neighbours: an inverted multi-index over two halves of each vector."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import stored

#: Neighbours of a query, and the queries: ids that this divides.
NEIGHBOURS, EVERY = 10, 100
#: Rows that the codebooks are fitted to (the bound on what the driver holds), centroids of each
#: half at most, and rounds of their refinement.
SAMPLE, CENTROIDS, ROUNDS = 16_384, 128, 10
#: Share of true neighbours that traversals of the sample must catch, queries of the sample that
#: measure it, and rows that every traversal visits at least.
TARGET, TRIALS, LEAST = 0.97, 512, 1000
#: Rows of a shelf that a task holds at once; fuller shelves are split.
SHELF = 8192


@dataclass(frozen=True)
class Codebook:
    """Centroids of both halves of vectors of one length, and the share of rows to visit."""

    left: np.ndarray
    right: np.ndarray
    share: float

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of each row's halves to the centroids."""
        cut = self.left.shape[1]
        return squared(x[:, :cut], self.left), squared(x[:, cut:], self.right)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.parts(x)
        return a.argmin(axis=1), b.argmin(axis=1)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all of ``y``, up to rounding."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0)


def centroids(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from ``k`` distinct rows; a centroid that loses all rows stays."""
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    c = distinct[np.random.default_rng(seed).choice(len(distinct), k, replace=False)]
    for _ in range(ROUNDS):
        at = squared(x, c).argmin(axis=1)
        size = np.bincount(at, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
    return c


def codebook(x: np.ndarray, k: int, neighbours: int) -> Codebook:
    """Codebooks of sampled rows, and the share of rows in order of summed distance that a
    traversal must visit to catch ``TARGET`` of the true neighbours within the sample."""
    cut = x.shape[1] // 2
    k = max(1, min(k, len(x) // 8))
    book = Codebook(centroids(x[:, :cut], k, 1), centroids(x[:, cut:], k, 2), 1.0)
    trial = np.arange(0, len(x), max(1, len(x) // TRIALS))
    near = squared(x[trial], x)
    near[np.arange(len(trial)), trial] = np.inf
    n = min(neighbours, len(x) - 1)
    if n < 1:
        return book
    best = np.argpartition(near, n - 1, axis=1)[:, :n]
    a, b = book.cells(x)
    d1, d2 = book.parts(x[trial])
    summed = d1[:, a] + d2[:, b]
    ranks = [np.searchsorted(np.sort(row), row[own], "right") for row, own in zip(summed, best, strict=True)]
    return Codebook(book.left, book.right, float(np.quantile(np.concatenate(ranks), TARGET)) / len(x))


def traversal(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray, wanted: int) -> float:
    """The summed distance up to which cells must be visited to meet ``wanted`` rows.

    Pairs of centroids leave a heap in order of their sum: ``(i, j)`` in the order of both
    halves lets in ``(i, j + 1)`` and, from the first of its row, ``(i + 1, 0)``.
    """
    first, second = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    left, right = d1[first].tolist(), d2[second].tolist()
    count = sizes[first][:, second]
    met, reached = 0, 0.0
    heap = [(left[0] + right[0], 0, 0)]
    while heap and met < wanted:
        reached, i, j = heapq.heappop(heap)
        met += int(count[i, j])
        if j + 1 < len(right):
            heapq.heappush(heap, (left[i] + right[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(left):
            heapq.heappush(heap, (left[i + 1] + right[0], i + 1, 0))
    return reached if met >= wanted else math.inf


def sound_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)`` in double precision, each pair once, of the rows that take part.

    Rows without an id, and vectors that are NULL, empty, zero or hold NULL or non-finite
    components, take none.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))
    # Minus zero is zero, so that equal vectors are equal arrays.
    return rows.select("vec_id", F.transform("v", lambda x: x + 0.0).alias("v")).distinct()


def fitted(rows: DataFrame, k: int, neighbours: int, sample: int) -> dict[int, Codebook]:
    """A codebook for each length of vector in the ``sample`` rows whose ids hash lowest."""
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()  # at most ``sample`` rows
    lengths = {len(r.v) for r in drawn}
    return {
        d: codebook(np.array(sorted(r.v for r in drawn if len(r.v) == d), np.float64), k, neighbours) for d in lengths
    }


def _book(books: dict[int, Codebook], dim: int) -> Codebook:
    """Vectors of a length that the sample lacks are in one cell and all visited."""
    return books.get(dim) or Codebook(np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)), 1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in column), np.float64).reshape(len(column), -1)


def indexed(rows: DataFrame, books: dict[int, Codebook]) -> DataFrame:
    """``(vec_id, unit, dim, c1, c2)``: every row with its cell; ``unit`` has the vector's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                part = batch.take(pa.array(at))
                x = part.column(1).flatten().to_numpy().reshape(len(at), dim)
                c1, c2 = _book(books, dim).cells(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([r.tobytes() for r in x], pa.binary()),
                        pa.array(np.full(len(at), dim), pa.int32()),
                        pa.array(c1, pa.int32()),
                        pa.array(c2, pa.int32()),
                    ],
                    names=["vec_id", "unit", "dim", "c1", "c2"],
                )

    return rows.mapInArrow(run, "vec_id long, unit binary, dim int, c1 int, c2 int")


def probes(
    searched: DataFrame, books: dict[int, Codebook], sizes: dict[int, np.ndarray], splits: dict[tuple[int, int], int]
) -> DataFrame:
    """``(search, unit, dim, c1, block, reach)``: the shelves that each searched vector visits.

    A shelf has the rows of one first centroid. ``reach`` is what the traversal left for the
    second half: cells of the shelf whose second centroid is within it are visited.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                dim = row["dim"]
                book, size = _book(books, dim), sizes[dim]
                d1, d2 = (d[0] for d in book.parts(np.frombuffer(row["unit"], np.float64)[None]))
                wanted = max(LEAST, math.ceil(book.share * int(size.sum())))
                reached = traversal(d1, d2, size, wanted)
                reach = reached + 1e-9 * (1 + reached) - d1  # sums are rounded
                for c1 in np.flatnonzero((reach >= d2.min()) & (size.sum(axis=1) > 0)).tolist():
                    for block in range(splits[dim, c1]):
                        out.append((row["search"], row["unit"], dim, c1, block, float(reach[c1])))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["search", "unit", "dim", "c1", "block", "reach"],
            )

    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    return searched.mapInArrow(run, "search long, unit binary, dim int, c1 int, block int, reach double")


def _nearest(rows: np.ndarray, ids: np.ndarray, query: np.ndarray, rough: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The ``k`` nearest rows: those that the rough squared distances leave, by exact distance."""
    if len(rough) > k:
        limit = np.partition(rough, k - 1)[k - 1]
        at = np.flatnonzero(rough <= limit + 1e-9 * (1 + limit))
    else:
        at = np.arange(len(rough))
    exact = np.sqrt(((rows[at] - query) ** 2).sum(axis=1))
    order = np.lexsort((ids[at], exact))[:k]
    return list(zip(exact[order].tolist(), ids[at][order].tolist(), strict=True))


def reranked(rows: DataFrame, asked: DataFrame, books: dict[int, Codebook], k: int) -> DataFrame:
    """``(search, score, vec_id)``: of every shelf visited, the ``k`` nearest rows of its cells.

    Rows and probes of a shelf's block meet in one sorted run, rows first: a task holds the at
    most ``SHELF`` or so rows of a block and streams the probes past them.
    """
    shelf = ["dim", "c1", "block"]
    both = rows.select(*shelf, F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "unit", "c2", F.lit(0.0).alias("reach"))
    both = both.unionByName(
        asked.select(*shelf, F.lit(1).alias("kind"), F.col("search").alias("id"), "unit", F.lit(0).alias("c2"), "reach")
    )
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(n, *shelf).sortWithinPartitions(*shelf, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts = None, []
        held = ids = c2 = norms = None
        for batch in batches:
            found: list[tuple[int, float, int]] = []
            dims, firsts, blocks, kinds = (batch.column(c).to_numpy() for c in range(4))
            new = np.flatnonzero((np.diff(dims) != 0) | (np.diff(firsts) != 0) | (np.diff(blocks) != 0) | (np.diff(kinds) != 0))
            bounds = [0, *(new + 1).tolist(), batch.num_rows]
            for begin, end in zip(bounds, bounds[1:], strict=False):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                key = (int(dims[begin]), int(firsts[begin]), int(blocks[begin]))
                if key != here:
                    here, parts, held = key, [], None
                x = _matrix(part.column(5))
                if kinds[begin] == 0:
                    parts.append((x, part.column(4).to_numpy(), part.column(6).to_numpy()))
                    continue
                if held is None:
                    if not parts:
                        continue
                    held, ids, c2 = (np.concatenate(c) for c in zip(*parts, strict=True))
                    norms, parts = (held * held).sum(axis=1), []
                reach, searches = part.column(7).to_numpy(), part.column(4).to_numpy()
                seconds = _book(books, key[0]).parts(x)[1]
                for lo in range(0, len(x), 512):
                    some = x[lo : lo + 512]
                    rough = norms[None] - 2 * (some @ held.T) + (some * some).sum(axis=1)[:, None]
                    for i, row in enumerate(rough):
                        inside = np.flatnonzero(seconds[lo + i][c2] <= reach[lo + i])
                        for score, vec in _nearest(held[inside], ids[inside], some[i], row[inside], k):
                            found.append((int(searches[lo + i]), score, vec))
            columns = list(zip(*found, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.float64(), pa.int64()), strict=True)],
                names=["search", "score", "vec_id"],
            )

    return both.mapInArrow(run, "search long, score double, vec_id long")


def nearest(
    vectors: DataFrame,
    neighbours: int = NEIGHBOURS,
    every: int = EVERY,
    k: int = CENTROIDS,
    sample: int = SAMPLE,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: nearest rows of each row whose id ``every`` divides.

    Candidates are all other rows, of any label, whose vectors have the query's length; nearness
    is Euclidean, ``score`` the exact distance in double precision, ties go to the smaller id.
    Vectors are quantised by halves; each query visits pairs of centroids in order of summed
    distance, and what their cells hold is ranked by exact distance. How many rows are visited
    follows from the sample, where the traversal must catch ``TARGET`` of the true neighbours.

    Codebooks are fitted to a bounded sample and every row is indexed. Rows that repeat an id
    and a vector are one. Of copies under different ids only the first ``neighbours + 1`` ids can
    come up in any answer, so only these are searched, and equal queries are searched once.
    Rows that ``sound_vectors`` leaves out take no part; an empty table gives no rows.
    """
    keep = neighbours + 1
    rows = stored(sound_vectors(vectors))
    queries = rows.where(F.col("vec_id") % every == 0)
    copy = Window.partitionBy("v").orderBy("vec_id")
    distinct = rows.withColumn("nth", F.row_number().over(copy)).where(F.col("nth") <= keep).select("vec_id", "v")
    books = fitted(rows, k, neighbours, sample)
    index = stored(indexed(distinct, books))
    sizes: dict[int, np.ndarray] = {}
    for r in index.groupBy("dim", "c1", "c2").count().collect():  # at most CENTROIDS squared for a length
        book = _book(books, r.dim)
        sizes.setdefault(r.dim, np.zeros((len(book.left), len(book.right)), np.int64))[r.c1, r.c2] = r["count"]
    splits = {
        (dim, c1): -(-int(n) // SHELF) for dim, size in sizes.items() for c1, n in enumerate(size.sum(axis=1)) if n
    }
    spark = vectors.sparkSession
    shelves = spark.createDataFrame([(d, c, n) for (d, c), n in splits.items()], "dim int, c1 int, blocks int")
    shelved = index.join(F.broadcast(shelves), ["dim", "c1"])  # at most CENTROIDS rows for a length
    shelved = shelved.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))

    # An id may come with several vectors, so a search has a number of its own.
    searched = stored(queries.groupBy("v").agg(F.min("vec_id").alias("least")).withColumn("search", F.xxhash64("least", "v")))
    cells = indexed(searched.select(F.col("search").alias("vec_id"), "v"), books)
    asked = probes(cells.select(F.col("vec_id").alias("search"), "unit", "dim"), books, sizes, splits)
    found = reranked(shelved, asked, books, keep)
    best = Window.partitionBy("search").orderBy("score", "vec_id")
    found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= keep)

    named = queries.join(searched, "v").select(F.col("vec_id").alias("query_id"), "search")
    near = named.join(found, "search").where("query_id <> vec_id")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "search").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
