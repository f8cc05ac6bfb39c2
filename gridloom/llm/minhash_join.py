"""Near-duplicate documents: MinHash signatures, inverted by coordinate and value."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import PART_EDGES, components, gathered, hits, packed, settled, stored, unpacked
from gridloom.llm.shingles import fingerprint, mix, numbers, shingle_sets

#: Coordinates of a signature, and how often a pair at the threshold may agree in fewer than ``matches_for`` asks.
COORDINATES, MISSED = 64, 5e-7
WIDTH, NUMERATOR = 5, 85

#: Documents of one posting list that a task compares at once; longer lists go in pairs of blocks.
BLOCK = 1024
#: Pairs that a task compares and holds at once, however long its lists are.
PAIRS = 1 << 18
#: In lists longer than this, the shingles that one document alone has are counted, which tells
#: most pairs that agree by signature but cannot be linked.
LONG = 32
#: Classes whose postings are kept in one partition, where there are partitions enough.
PART_CLASSES = 2000

_A, _B = numbers(11, COORDINATES) | np.uint64(1), numbers(12, COORDINATES)


def matches_for(numerator: int) -> int:
    """How many coordinates must agree for a pair to be confirmed on full sets.

    At similarity s the number that agree is binomial (64, s). The most that a pair at the
    threshold falls short of with a probability of ``MISSED`` at most: 38 at 0.85, 34 at 0.80.
    """
    p, fewer = numerator / 100, 0.0
    for m in range(COORDINATES + 1):
        fewer += comb(COORDINATES, m) * p**m * (1 - p) ** (COORDINATES - m)
        if fewer > MISSED:
            break
    if not m:
        raise ValueError(f"{COORDINATES} coordinates cannot find pairs at a similarity of {p}")
    return m


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over the set."""
    out = np.full(COORDINATES, np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 1 << 14):
        part = shingles[at : at + (1 << 14)]
        for k in range(COORDINATES):
            least = (part * _A[k] + _B[k]).min()
            out[k] = min(out[k], least)
    return out


def signatures_of(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of several sets; short ones share each pass over the hash functions."""
    out = np.full((len(sets), COORDINATES), np.uint64(2**64 - 1))
    at, n = [i for i, s in enumerate(sets) if len(s)], 0
    group: list[int] = []

    def flush() -> None:
        joined = np.concatenate([sets[i] for i in group])
        starts = np.cumsum([0] + [len(sets[i]) for i in group[:-1]])
        for k in range(COORDINATES):
            out[group, k] = np.minimum.reduceat(joined * _A[k] + _B[k], starts)

    for i in at:
        if len(sets[i]) > 1 << 14:
            out[i] = signature(sets[i])
            continue
        if n + len(sets[i]) > 1 << 15 and group:
            flush()
            group, n = [], 0
        group.append(i)
        n += len(sets[i])
    if group:
        flush()
    return out


def signed(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, n_shingles, fp, postings, marks)`` per row; the text does not leave its task.

    ``postings`` has one long per coordinate, the coordinate's number in its top six bits;
    ``marks`` has 32 bits of each value, for counting. ``fp`` stands for the whole set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(58)
        for batch in batches:
            texts = batch.column(2)
            for at in range(0, len(texts), 256):
                sets = list(shingle_sets([x.as_py() for x in texts[at : at + 256]], WIDTH))
                values = mix(signatures_of(sets))
                postings = (values >> np.uint64(6) | top).view(np.int64)
                marks = values.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[at : at + 256],
                        batch.column(1)[at : at + 256],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([fingerprint(s) for s in sets], pa.binary()),
                        pa.array([p if len(s) else None for p, s in zip(postings, sets, strict=True)], pa.list_(pa.int64())),
                        pa.array([m.tobytes() for m in marks], pa.binary()),
                    ],
                    names=["doc_id", "th", "n_shingles", "fp", "postings", "marks"],
                )

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, th long, n_shingles long, fp binary, postings array<long>, marks binary"
    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, schema)


def prefixes(classes: DataFrame, matches: int, most: int) -> DataFrame:
    """``(cls, posting, list_size, mask)``: the lists in which a class can meet a partner.

    Postings that one class alone has go first. A class then needs at least ``matches`` others;
    of these, in order from the rarest, all but the last ``matches - 1`` are its prefix. Two
    classes that agree in ``matches`` coordinates share a posting of both prefixes. Bit k of
    ``mask`` tells that coordinate k is in the prefix. There are ``most`` classes at most.
    """
    each = classes.select("cls", F.explode("postings").alias("posting"))
    often = each.groupBy("posting").agg(F.count("*").alias("df")).where("df > 1")
    shared = each.join(often, "posting").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "posting"))).alias("p"))
    shared = shared.where(F.size("p") >= matches)
    prefix = shared.select("cls", F.expr(f"slice(p, 1, size(p) - {matches - 1}).posting").alias("p"))
    mask = F.expr("aggregate(p, 0L, (m, x) -> m | shiftleft(1L, CAST(shiftrightunsigned(x, 58) AS INT)))")
    posted = prefix.select("cls", mask.alias("mask"), F.explode("p").alias("posting"))
    posted = settled(gathered(posted, most // PART_CLASSES + 1))
    size = posted.groupBy("posting").agg(F.count("*").alias("list_size")).where("list_size > 1")
    return gathered(posted.join(size, "posting"), posted.count() // PART_EDGES + 1)


def full_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``(cls, shingles)`` of the classes, sorted 64-bit hashes, from the text of one of their documents."""
    want = classes.select("cls", F.col("of.doc_id").alias("_doc"), F.col("of.th").alias("_th"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    rows = hits(rows, ["doc_id", "th"], want, ["_doc", "_th"]).where("hit")
    same = rows["doc_id"].eqNullSafe(want["_doc"]) & (rows["th"] == want["_th"])
    rows = rows.join(want.hint("shuffle_hash"), same).select("cls", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                sets = [s.tobytes() for s in shingle_sets([x.as_py() for x in batch.column(1)[at : at + 64]], WIDTH)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[at : at + 64], pa.array(sets, pa.binary())], names=["cls", "shingles"]
                )

    return rows.mapInArrow(run, "cls long, shingles binary")


def own_shingles(sets: DataFrame) -> DataFrame:
    """``(cls, size, own)``: how many of a class's shingles no other of these classes has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cls, data in zip(batch.column(0), batch.column(1), strict=True):
                shingles = np.frombuffer(data.as_py(), np.int64)
                for at in range(0, len(shingles), 1 << 16):
                    part = shingles[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), pa.array(np.full(len(part), cls.as_py()))], names=["shingle", "cls"]
                    )

    alone = sets.mapInArrow(run, "shingle long, cls long").groupBy("shingle").agg(F.count("*").alias("n"), F.min("cls").alias("cls"))
    alone = alone.where("n = 1").groupBy("cls").agg(F.count("*").alias("own"))
    size = sets.select("cls", (F.octet_length("shingles") / 8).cast("long").alias("size"))
    return size.join(alone, "cls", "left").select("cls", "size", F.coalesce("own", F.lit(0)).alias("own"))


def possible(size: np.ndarray, own: np.ndarray, u: np.ndarray, v: np.ndarray, numerator: int) -> np.ndarray:
    """Whether pairs can be linked, by their sizes and the shingles that only one of the two has.

    No more than a set's other shingles can be common. ``own`` is -1 where it is not known.
    """
    most = np.minimum(size[u] - own[u], size[v] - own[v])
    return (own[u] < 0) | (own[v] < 0) | (100 * most >= numerator * (size[u] + size[v] - most))


def candidate_pairs(posted: DataFrame, marks: DataFrame, numerator: int, matches: int, forest: bool) -> DataFrame:
    """``(a, b)`` of different components that agree in ``matches`` coordinates or more.

    ``posted`` has ``(cls, posting, mask, comp, list_size)``, ``marks`` ``(cls, marks, size, own)``. Lists are cut in blocks and every
    pair of blocks is a run of sorted rows, so that a task holds two blocks at most. A pair
    counts in the list of its lowest common prefix coordinate only. With ``forest``, of the
    pairs in a run those that agree most are taken until they join all that can be joined;
    without it, all are.
    """
    blocks = F.ceil(F.col("list_size") / BLOCK)
    rows = posted.withColumn("of", F.pmod(F.xxhash64("cls"), blocks))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = rows.select(
        "posting",
        F.least("of", "with").alias("i"),
        F.greatest("of", "with").alias("j"),
        (F.col("of") > F.col("with")).alias("right"),
        "cls",
        "comp",
        "mask",
    )
    n = int(posted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.join(marks, "cls").repartition(n, "posting", "i", "j").sortWithinPartitions("posting", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            whole = pa.Table.from_batches([*held, batch]).combine_chunks()
            runs = _runs(whole)
            yield from pairs(whole, runs[:-1])
            held = whole.slice(runs[-1][0]).to_batches() if runs else []
        if held:
            whole = pa.Table.from_batches(held).combine_chunks()
            yield from pairs(whole, _runs(whole))

    def pairs(whole: pa.Table, runs: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        for a, b in _compared(whole, runs, numerator, matches, forest):
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    columns = ["posting", "i", "j", "right", "cls", "comp", "mask", "marks", "size", "own"]
    return rows.select(*columns).mapInArrow(run, "a long, b long").distinct()


def _runs(whole: pa.Table) -> list[tuple[int, int]]:
    """Begin and end of each run of rows of one list and pair of blocks."""
    if not len(whole):
        return []
    keys = [whole.column(c).to_numpy() for c in ("posting", "i", "j")]
    new = np.zeros(len(whole), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    begin = np.flatnonzero(new)
    return list(zip(begin.tolist(), [*begin[1:].tolist(), len(whole)], strict=True))


def _compared(
    whole: pa.Table, runs: list[tuple[int, int]], numerator: int, matches: int, forest: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of all runs that agree enough, about ``PAIRS`` at a time; of a forest, all at once."""
    if not runs:
        return
    cls, comp = (whole.column(c).to_numpy() for c in ("cls", "comp"))
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n = 0

    def take() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What is held; of a forest only the edges, as no later pair makes another one of them."""
        u, v, agree = (np.concatenate(part) for part in zip(*held, strict=True))
        held.clear()
        if not forest:
            return u, v, agree
        order = np.argsort(-agree, kind="stable")
        taken = order[_forest(u[order], v[order], comp)]
        return u[taken], v[taken], agree[taken]

    for part in _agreeing(whole, runs, numerator, matches):
        held.append(part)
        n += len(part[0])
        if n >= PAIRS:
            u, v, agree = take()
            n = 0
            if forest:
                held.append((u, v, agree))
            else:
                yield np.minimum(cls[u], cls[v]), np.maximum(cls[u], cls[v])
    if held:
        u, v, _ = take()
        yield np.minimum(cls[u], cls[v]), np.maximum(cls[u], cls[v])


def _agreeing(
    whole: pa.Table, runs: list[tuple[int, int]], numerator: int, matches: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of pairs and their agreement; short runs are compared together, long ones in slices."""
    comp, mask, posting, i, j = (whole.column(c).to_numpy() for c in ("comp", "mask", "posting", "i", "j"))
    size, own = whole.column("size").to_numpy(), whole.column("own").to_numpy()
    right = whole.column("right").to_numpy(zero_copy_only=False)
    coordinate = (posting.view(np.uint64) >> np.uint64(58)).astype(np.int64)
    prefix = (mask.view(np.uint64)[:, None] >> np.arange(COORDINATES, dtype=np.uint64) & np.uint64(1)).astype(bool)
    marks = np.frombuffer(b"".join(whole.column("marks").to_pylist()), np.uint32).reshape(-1, COORDINATES)
    short: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def compare_short() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        u, v = (np.concatenate(side) for side in zip(*short, strict=True))
        short.clear()
        for at in range(0, len(u), 1 << 15):
            p, q = u[at : at + (1 << 15)], v[at : at + (1 << 15)]
            may = (comp[p] != comp[q]) & possible(size, own, p, q, numerator)
            p, q = p[may], q[may]
            same = marks[p] == marks[q]
            agree = same.sum(1)
            common = same & prefix[p] & prefix[q]
            owned = (np.argmax(common, 1) == coordinate[p]) & (agree >= matches)
            yield p[owned], q[owned], agree[owned]

    def compare_long(x: np.ndarray, y: np.ndarray, k0: int, owned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        agree = np.zeros(owned.shape, np.uint8)
        for k in range(COORDINATES):
            same = marks[x, k][:, None] == marks[y, k][None, :]
            agree += same
            if k < k0:
                owned &= ~(same & prefix[x, k][:, None] & prefix[y, k][None, :])
        u, v = np.nonzero(owned & (agree >= matches))
        may = possible(size, own, x[u], y[v], numerator)
        u, v = u[may], v[may]
        return x[u], y[v], agree[u, v].astype(np.int64)

    for begin, end in runs:
        n = end - begin
        if n < 2:
            continue
        if i[begin] == j[begin] and n <= 64:
            u, v = np.triu_indices(n, 1)
            short.append((u + begin, v + begin))
            waiting += len(u)
            if len(short) >= 2000 or waiting >= PAIRS:
                yield from compare_short()
                waiting = 0
            continue
        at = np.arange(begin, end)
        both = i[begin] != j[begin]
        left, y = (at[~right[begin:end]], at[right[begin:end]]) if both else (at, at)
        step = max(1, PAIRS // max(1, len(y)))
        for x in (left[s : s + step] for s in range(0, len(left), step)):
            owned = comp[x][:, None] != comp[y][None, :]
            if not both:
                owned &= x[:, None] < y[None, :]
            if owned.any():
                yield compare_long(x, y, coordinate[begin], owned)
    if short:
        yield from compare_short()


def _forest(u: np.ndarray, v: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Which edges, in order, join what no earlier one has joined."""
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while (up := root.get(c, c)) != c:
            root[c] = root.get(up, up)
            c = up
        return c

    taken = []
    for k, (p, q) in enumerate(zip(comp[u].tolist(), comp[v].tolist(), strict=True)):
        p, q = find(p), find(q)
        if p != q:
            root[p] = q
            taken.append(k)
    return np.array(taken, np.int64)


def confirmed(pairs: DataFrame, sets: DataFrame, numerator: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= numerator * union."""
    a, b = (sets.select(F.col("cls").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for p, q in zip(batch.column(2), batch.column(3), strict=True):
                p, q = (np.frombuffer(x.as_buffer(), np.uint64) for x in (p, q))
                small, large = (p, q) if len(p) < len(q) else (q, p)
                place = np.searchsorted(large, small)
                common = int((large[np.minimum(place, len(large) - 1)] == small).sum())
                good.append(100 * common >= numerator * (len(p) + len(q) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    # A pair's sets can differ in size by the ratio that the threshold allows, no more.
    size = "octet_length(s{0}) * 100 >= octet_length(s{1}) * {2}"
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb")
    both = both.where(size.format("a", "b", numerator)).where(size.format("b", "a", numerator))
    return both.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, numerator: int = NUMERATOR, matches: int | None = None) -> DataFrame:
    """``(doc_id, th, n_shingles, component_id, kept, stays)`` per row; ``th`` is ``xxhash64`` of the text.

    1. Rows with equal sets of shingles form a class, so that copies are never paired.
    2. Classes are posted under their rarest coordinate values (``prefixes``).
    3. Among the classes of long lists, shingles of one class alone bound what a pair can share:
       a class with too many leaves those lists, and a pair with too many is passed over.
       The bound holds for all their pairs, so no link is lost.
    4. In each list, the pairs that agree most, a forest of them, are confirmed on full sets.
    5. Lists whose classes are all in one component by now are skipped; in the others every
       pair of different components is counted and confirmed.

    ``component_id`` is the smallest ``doc_id`` that links reach (NULL ids are passed over);
    ``kept`` is ``doc_id = component_id``. ``stays`` differs where ids repeat: it holds for one
    text of each group. Rows without words are linked with nothing. ``matches`` follows the
    numerator unless given.
    """
    matches = matches_for(numerator) if matches is None else matches
    rows = stored(signed(docs.select("doc_id", "text")).withColumn("row", F.monotonically_increasing_id()))
    n = rows.count()
    classes = rows.where("n_shingles > 0").groupBy("fp")
    classes = classes.agg(F.min("row").alias("cls"), F.min_by(F.struct("doc_id", "th"), "row").alias("of"))
    classes = settled(gathered(classes, n // PART_EDGES + 1))
    signs = rows.select("row", "postings", "marks").join(classes.select(F.col("cls").alias("row")), "row", "left_semi")
    signs = signs.withColumnRenamed("row", "cls")
    posted = settled(prefixes(signs, matches, n))
    # Each table down to the first links has about as many rows at most, so that small ones go in few files.
    files = posted.count() // PART_EDGES + 1
    active = posted.select("cls").distinct()
    sets = stored(gathered(full_sets(docs, classes.join(active, "cls", "left_semi")), files))
    long = posted.where(F.col("list_size") > LONG).select("cls").distinct()
    own = settled(gathered(own_shingles(sets.join(long, "cls", "left_semi")), files))
    lost = own.where(F.col("own") * 100 > F.col("size") * (100 - numerator)).select("cls", F.lit(True).alias("_lost"))
    posted = posted.join(lost, "cls", "left").where((F.col("list_size") <= LONG) | F.col("_lost").isNull()).drop("_lost", "list_size")
    size = posted.groupBy("posting").agg(F.count("*").alias("list_size")).where("list_size > 1")
    posted = settled(gathered(posted.join(size, "posting"), files))
    known = [F.coalesce(c, F.lit(-1)).cast("long").alias(c) for c in ("size", "own")]
    marks = signs.select("cls", "marks").join(active, "cls", "left_semi").join(own, "cls", "left")
    marks = stored(gathered(marks.select("cls", "marks", *known), files))

    first = candidate_pairs(posted.withColumn("comp", F.col("cls")), marks, numerator, matches, forest=True)
    links = settled(gathered(confirmed(first, sets, numerator), files))
    groups = settled(gathered(components(links, most=links.count()), files)).select(F.col("id").alias("cls"), "component")
    placed = posted.join(groups, "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")
    mixed = placed.groupBy("posting").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    rest = candidate_pairs(placed.join(mixed.select("posting"), "posting", "left_semi"), marks, numerator, matches, forest=False)
    links = links.union(confirmed(rest, sets, numerator))
    groups = components(links).select(F.col("id").alias("cls"), F.col("component").alias("group"))

    member = rows.select("doc_id", "th", "n_shingles", "row", "fp")
    linked = member.where("n_shingles > 0").join(classes.select("fp", "cls"), "fp").join(groups, "cls", "left")
    linked = linked.select("doc_id", "th", "n_shingles", "row", F.coalesce("group", "cls").alias("group"))
    heads = linked.groupBy("group").agg(
        F.min("doc_id").alias("component_id"), F.min_by("row", F.struct(F.expr("doc_id IS NULL"), "doc_id", "th", "row")).alias("head")
    )
    linked = linked.join(heads, "group")
    alone = member.where("n_shingles = 0").select("doc_id", "th", "n_shingles", "row", F.col("doc_id").alias("component_id"), F.col("row").alias("head"))
    every = linked.select("doc_id", "th", "n_shingles", "row", "component_id", "head").union(alone)
    return every.select(
        "doc_id",
        "th",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("row") == F.col("head")).alias("stays"),
    )


def one_of_each(docs: DataFrame, numerator: int = NUMERATOR) -> DataFrame:
    """The documents, one text of each group of near duplicates, with all their columns.

    A row that repeats both ``doc_id`` and text is the same document and stays once.
    """
    found = near_duplicates(docs, numerator).groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"))
    found = found.agg(F.max("stays").alias("stays"), F.count("*").alias("n"))
    # Texts that go, and those that stay once; all others stay without a shuffle of their rows.
    listed = settled(found.where("NOT stays OR n > 1").select("_doc", "_th", "stays"))
    rows = hits(packed(docs), ["id", "hash"], listed, ["_doc", "_th"])
    same = rows["id"].eqNullSafe(listed["_doc"]) & (rows["hash"] == listed["_th"])
    looked = rows.where("hit").join(listed.hint("shuffle_hash"), same, "left").select("row", "id", "hash", "stays")
    out = rows.where("NOT hit").select("row").union(looked.where("stays IS NULL").select("row"))
    if not listed.where("stays").isEmpty():
        out = out.union(looked.where("stays").dropDuplicates(["id", "hash"]).select("row"))
    return unpacked(out, docs)
