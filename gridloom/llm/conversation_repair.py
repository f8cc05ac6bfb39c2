"""Repair of conversations: faults found, and the cheapest edits to a legal order of roles.

An audit has one letter for each edit: D deletes a row, I inserts an empty turn, K keeps a row, R
gives it another role. The roles that stay must be ``(s?(ua)+)?`` by their initials.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.audit_prefixes import (
    BLANK,
    CUT,
    DUPLICATE,
    NONE,
    Best,
    Prefixes,
    apply_edits,
    cheapest,
    edit_rows,
    offer,
)
from gridloom.llm.common import WHITE, stored

#: Rows, and characters, of a conversation that a task takes at once; longer ones go in blocks.
BLOCK_ROWS, BLOCK_CHARS = 4096, 1 << 24
LEGAL = ("su", "ua", "au")
NO_TEXT = hashlib.sha256(b"").hexdigest()

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with rows dropped, emptied, cut, repeated or given another
    role, by a checksum of conversation and turn. NULLs read as one space."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fate = F.crc32(F.concat(told[0], F.lit(":"), told[1])) % 20
    role, text = told[2:]
    copies = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    )
    return rows.drop("copy")


def fault_of(text: str, repeated: bool) -> str | None:
    """A row's first fault."""
    body = text.rstrip(WHITE)
    if not body:
        return BLANK
    if repeated:
        return DUPLICATE
    return None if body[-1] in ".!?" else CUT


class Tally:
    """Counts over rows in order: ``(gaps, blank, duplicate, truncated, illegal)`` can be told from it."""

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "first", "last")

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def row(self, turn: int | None, initial: str, fault: str | None) -> None:
        if fault is not None:
            setattr(self, fault, getattr(self, fault) + 1)
        self.illegal += self.last is not None and self.last + initial not in LEGAL
        self.first = initial if self.first is None else self.first
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def join(self, then: dict) -> None:
        """Add the counts of the rows that follow."""
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + then[name])
        self.illegal += self.last is not None and self.last + then["first"] not in LEGAL
        self.first = then["first"] if self.first is None else self.first
        self.last = then["last"]
        if then["low"] is not None:
            self.turns -= then["low"] == self.high
            self.low = then["low"] if self.low is None else self.low
            self.high = then["high"]

    def values(self) -> tuple:
        return tuple(getattr(self, f) for f in self.FIELDS)

    def counts(self) -> tuple[int, ...]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal)


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of sorted rows with equal first ``width`` columns."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:width] != key:
                if key is not None:
                    yield key, held
                key, held = row[:width], []
            held.append(row[width:])
    if key is not None:
        yield key, held


def _emitted(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _arrow(df: DataFrame, ddl: str) -> tuple[str, pa.Schema]:
    """A schema that begins with the conversations' id, for Spark and for Arrow."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    whole = f"conv_id {df.schema['conv_id'].dataType.simpleString()}, {ddl}"
    return whole, to_arrow_schema(StructType.fromDDL(whole))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _digest(lines: list[tuple]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for _, _, role, text in lines).encode()).hexdigest()


def _solved(rows: list[tuple]) -> tuple[tuple, str, list[tuple]]:
    """Counts and cost, audit and repaired rows of a whole conversation ``(turn, role, text)``."""
    tally, seen, judged = Tally(), set(), []
    for turn, role, text in rows:
        fault = fault_of(text, (role, text) in seen)
        seen.add((role, text))
        tally.row(turn, role[:1], fault)
        judged.append((role[:1], fault))
    strings = Prefixes()
    cost, node = cheapest(strings, edit_rows(judged, NONE, True, strings))
    audit = "".join(strings.pieces(node))
    return (*tally.counts(), cost), audit, apply_edits(audit, rows, NONE)[0]


def _matched(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join on equal values, NULLs among them."""
    other = right.select(*(F.col(c).alias(f"_{c}" if c in names else c) for c in right.columns))
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return left.join(other, same, how).drop(*(f"_{name}" for name in names))


def _told(rows: DataFrame) -> DataFrame:
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    )


def _parts(rows: DataFrame, block_rows: int, block_chars: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of conversations that fit in a task, and of those that do not (None: there are none)."""
    size = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.char_length("text")).alias("chars"))
    long = stored(size.where((F.col("n") > block_rows) | (F.col("chars") > block_chars)).select("conv_id"))
    if long.isEmpty():
        return rows, None
    return _matched(rows, long, ["conv_id"], "left_anti"), _matched(rows, long, ["conv_id"], "left_semi")


def _short(rows: DataFrame) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", *_order())


def _in_blocks(rows: DataFrame, block_rows: int, block_chars: int) -> DataFrame:
    """``(conv_id, block, position, turn, role, text, again)`` of long conversations, as a table.

    Rows are ranged by their order, so that a conversation lies over many tasks, and numbered
    within those; how many rows the tasks before hold is added. ``again`` tells rows whose role
    and text came before. Blocks have at most ``block_rows`` rows and about ``block_chars`` characters.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))  # NULL first
    first = rows.groupBy("conv_id", "role", "text").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    rows = _matched(rows, first.drop("n"), ["conv_id", "role", "text"], "left")
    rows = rows.withColumn("later", place > F.col("first")).drop("first")
    # The beginning of a text is enough to range by: what agrees in it stays in one task.
    ranged = rows.repartitionByRange(n, "conv_id", F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 40))
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()))
    own = Window.partitionBy("conv_id", "part").orderBy(*_order())
    before = F.lag(F.struct("turn", "role", "text")).over(own)
    numbered = ranged.select(
        "*",
        F.row_number().over(own).alias("nth"),
        F.sum(F.char_length("text")).over(own.rowsBetween(Window.unboundedPreceding, 0)).alias("chars"),
        before.eqNullSafe(F.struct("turn", "role", "text")).alias("copy"),
    )
    size = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.sum(F.char_length("text")).alias("chars"))
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    size = size.select(
        "conv_id",
        "part",
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("rows_ahead"),
        F.coalesce(F.sum("chars").over(ahead), F.lit(0)).alias("chars_ahead"),
    )
    position = F.col("rows_ahead") + F.col("nth") - 1
    ahead_of = F.col("chars_ahead") + F.col("chars") - F.char_length("text")  # none for the first row: block 0 is there
    by_rows, by_chars = F.floor(position / block_rows), F.floor(ahead_of / block_chars)
    placed = _matched(numbered, size, ["conv_id", "part"], "inner").select(
        "conv_id",
        (by_rows + by_chars).cast("long").alias("block"),  # both only grow, and so does their sum
        position.alias("position"),
        "turn",
        "role",
        "text",
        (F.coalesce("later", F.lit(False)) | F.coalesce("copy", F.lit(False))).alias("again"),
    )
    return stored(placed)


def _block_runs(blocks: DataFrame) -> DataFrame:
    """``(conv_id, block, tally, paths)``: for each block the counts, and the cheapest edits from
    each state to each."""
    ddl = (
        "block long, tally struct<blank: long, duplicate: long, truncated: long, illegal: long, low: long, high: long, "
        "turns: long, first: string, last: string>, paths array<struct<start: int, stop: int, cost: long, audit: string>>"
    )
    whole, schema = _arrow(blocks, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved() -> Iterator[tuple]:
            for (conv, block), rows in _groups(batches, 2):
                tally, judged = Tally(), []
                for turn, role, text, again in rows:
                    fault = fault_of(text, again)
                    tally.row(turn, role[:1], fault)
                    judged.append((role[:1], fault))
                paths = []
                for start in range(4):
                    strings = Prefixes()
                    # Before the first row of all, and only there, turns are inserted ahead.
                    for stop, held in enumerate(edit_rows(judged, start, block == 0, strings)):
                        if held is not None:
                            paths.append((start, stop, held[0], "".join(strings.pieces(held[1]))))
                keys = ("start", "stop", "cost", "audit")
                yield conv, block, dict(zip(Tally.FIELDS, tally.values(), strict=True)), [dict(zip(keys, p, strict=True)) for p in paths]

        yield from _emitted(solved(), schema, 16)

    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = blocks.repartition(n, "conv_id", "block").sortWithinPartitions("conv_id", "block", "position")
    return ordered.select("conv_id", "block", "turn", "role", "text", "again").mapInArrow(run, whole)


def _joined(runs: DataFrame) -> DataFrame:
    """``(conv_id, counts, cost, audit, block, start, edits)``: rows of the whole conversation have no
    block; rows of a block have the edits chosen for it and the state they begin in.

    Blocks stream past in order; what is held of a conversation are the audits of four states.
    """
    whole, schema = _arrow(runs, f"{REPORT}, block long, start int, edits string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(conv, tally: Tally, strings: Prefixes, best: Best, came: dict[int, tuple[int, int]]) -> Iterator[tuple]:
            cost, node = cheapest(strings, best)
            pieces = strings.pieces(node)
            yield conv, *tally.counts(), cost, "".join(pieces), None, None, None
            at = node
            for piece in reversed(pieces):
                block, start = came[at]
                yield conv, *[None] * 7, block, start, piece
                at = strings.up[at][0]

        def folded() -> Iterator[tuple]:
            here, state = None, None
            for batch in batches:
                for row in batch.to_pylist():
                    if state is None or row["conv_id"] != here:
                        if state is not None:
                            yield from finished(here, *state)
                        here, strings, came = row["conv_id"], Prefixes(), {}
                        best: Best = [(0, 0), None, None, None]
                        tally = Tally()
                    now: Best = [None] * 4
                    for p in row["paths"]:
                        held = best[p["start"]]
                        if held is not None:
                            before = now[p["stop"]]
                            offer(strings, now, p["stop"], held[0] + p["cost"], held[1], p["audit"])
                            if now[p["stop"]] != before:
                                came[now[p["stop"]][1]] = (row["block"], p["start"])
                    best = now
                    tally.join(row["tally"])
                    state = (tally, strings, best, came)
            if state is not None:
                yield from finished(here, *state)

        yield from _emitted(folded(), schema, 64)

    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = runs.repartition(n, "conv_id").sortWithinPartitions("conv_id", "block")
    return ordered.mapInArrow(run, whole)


def _edited_blocks(blocks: DataFrame, chosen: DataFrame) -> DataFrame:
    """``(conv_id, block, lines)``: the rows of each block after its edits."""
    edits = chosen.where("block IS NOT NULL").select("conv_id", "block", "start", "edits")
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The edits of a block stand on one row ahead of its own rows.
    both = blocks.select("conv_id", "block", "position", "turn", "role", "text", F.lit(None).cast("int").alias("start"))
    both = both.union(
        edits.select("conv_id", "block", F.lit(-1), F.lit(None).cast("long"), F.lit(""), F.col("edits"), F.col("start"))
    )
    ordered = both.repartition(n, "conv_id", "block").sortWithinPartitions("conv_id", "block", "position")
    ddl = "block long, lines array<struct<edit: string, turn: long, role: string, text: string>>"
    whole, schema = _arrow(blocks, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edited() -> Iterator[tuple]:
            for (conv, block), ((_, _, audit, start), *rows) in _groups(batches, 2):
                lines, _ = apply_edits(audit, [r[:3] for r in rows], start)
                yield conv, block, [dict(zip(("edit", "turn", "role", "text"), x, strict=True)) for x in lines]

        yield from _emitted(edited(), schema, 1)

    return ordered.select("conv_id", "block", "turn", "role", "text", "start").mapInArrow(run, whole)


def _digests(edited: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: blocks stream through one hash, which has to take them in order."""
    whole, schema = _arrow(edited, "repaired_sha256 string")
    line = F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    n = int(edited.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    written = edited.select("conv_id", "block", F.size("lines").alias("n"), F.array_join(line, "\n").alias("body"))
    ordered = written.repartition(n, "conv_id").sortWithinPartitions("conv_id", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed() -> Iterator[tuple]:
            here, value, begun = None, None, False
            for batch in batches:
                for conv, n, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if value is None or conv != here:
                        if value is not None:
                            yield here, value.hexdigest()
                        here, value, begun = conv, hashlib.sha256(), False
                    if n:
                        value.update((("\n" if begun else "") + body).encode())
                        begun = True
            if value is not None:
                yield here, value.hexdigest()

        yield from _emitted(hashed(), schema)

    return ordered.select("conv_id", "n", "body").mapInArrow(run, whole)


def _long(rows: DataFrame, block_rows: int, block_chars: int) -> tuple[DataFrame, DataFrame]:
    blocks = _in_blocks(rows, block_rows, block_chars)
    chosen = stored(_joined(_block_runs(blocks)))
    return chosen, _edited_blocks(blocks, chosen)


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``.

    One row per conversation of ``(conv_id, turn, role, text)``, taken by turn (NULL first), role
    and text; NULL roles and texts are empty, and a NULL ``conv_id`` is a conversation too. Audits are the
    cheapest, among these the least; the digest is of the ``role:text`` lines that are left.

    A conversation goes through one task if it is short. A longer one is cut in blocks: each gives
    the cheapest edits from every state to every state, and those are joined in order. Only
    the digest, which must take the text in order, streams a whole conversation through one task.
    """
    rows = _told(rows)
    short, long = _parts(rows, block_rows, block_chars)
    whole, schema = _arrow(rows, f"{REPORT}, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def reports() -> Iterator[tuple]:
            for (conv,), found in _groups(batches, 1):
                counts, audit, lines = _solved(found)
                yield conv, *counts, audit, _digest(lines)

        yield from _emitted(reports(), schema)

    out = _short(short).mapInArrow(run, whole)
    if long is None:
        return out
    chosen, edited = _long(long, block_rows, block_chars)
    digests = _digests(edited)
    told = chosen.where("block IS NULL").drop("block", "start", "edits")
    return out.union(_matched(told, digests, ["conv_id"], "inner"))


def repaired_turns(rows: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(conv_id, block, nth, edit, turn, role, text)``: the rows that repaired conversations have,
    in order of ``block`` and ``nth``. Inserted rows have no turn."""
    rows = _told(rows)
    short, long = _parts(rows, block_rows, block_chars)
    ddl = "block long, nth long, edit string, turn long, role string, text string"
    whole, schema = _arrow(rows, ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[tuple]:
            for (conv,), found in _groups(batches, 1):
                for nth, line in enumerate(_solved(found)[2]):
                    yield conv, 0, nth, *line

        yield from _emitted(turns(), schema)

    out = _short(short).mapInArrow(run, whole)
    if long is None:
        return out
    edited = _long(long, block_rows, block_chars)[1]
    lines = edited.select("conv_id", "block", F.posexplode("lines").alias("nth", "line"))
    return out.union(lines.select("conv_id", "block", F.col("nth").cast("long"), "line.*"))


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows, with a row for every conversation of the table."""
    found = repair(damaged(conversations))
    ids = conversations.select("conv_id").distinct()
    zero = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return _matched(ids, found, ["conv_id"], "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in zero),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(NO_TEXT)).alias("repaired_sha256"),
    )
