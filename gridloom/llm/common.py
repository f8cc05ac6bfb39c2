"""What the operators share: tables, intermediate results and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space between words: space and the ASCII controls 9 to 13.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Up to so many edges, ``components`` looks up neighbours in a broadcast table (two longs a vertex).
FEW_EDGES = 100_000
#: Edges of one partition that ``components`` keeps, where there are partitions enough.
PART_EDGES = 10_000
#: 64-bit words of the table in which ``hits`` looks keys up, at most, however many there are.
WORDS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    A local session without that setting gets a temporary folder; a cluster must name one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="shared-"))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """A small, narrow table behind a reliable checkpoint, which goes once nothing refers to it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def gathered(df: DataFrame, files: int) -> DataFrame:
    """The rows in ``files`` partitions, if a shuffle has many more: for small tables of narrow rows.

    They move once more: tasks that ran several partitions of joins and sorts one after the other
    would hold the memory of all.
    """
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(files) if 4 * files <= shuffled else df


def hits(rows: DataFrame, keys: list[str], wanted: DataFrame, wanted_keys: list[str]) -> DataFrame:
    """The rows with a boolean ``hit``, false only where ``wanted`` lacks the row's key.

    Keys are marked by one bit of their hash in a broadcast table of ``WORDS`` words at most, so
    that rows which cannot match need no shuffle. Rows with other keys may hit, the more the
    fuller the table is: an exact join follows.
    """
    word, bit = "pmod(xxhash64({0}), {1})", "shiftleft(1L, CAST(shiftrightunsigned(xxhash64({0}), 58) AS INT))"
    of, to = (", ".join(f"`{k}`" for k in names) for names in (wanted_keys, keys))
    bits = wanted.select(F.expr(word.format(of, WORDS)).alias("_word"), F.expr(bit.format(of)).alias("_bit"))
    bits = bits.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    found = rows.withColumn("_word", F.expr(word.format(to, WORDS))).join(F.broadcast(bits), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.expr(bit.format(to))) != 0, F.lit(False))
    return found.withColumn("hit", hit).drop("_word", "_bits")


def packed(docs: DataFrame) -> DataFrame:
    """``(row, id, hash)``: whole rows out of reach of clashing names, their id and text's hash."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))


def unpacked(rows: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The rows as ``docs`` has them, with another ``text`` if given (``n_chars`` follows, if there)."""
    if text is not None:
        rows = rows.select("row", text.alias("text"))
    columns = []
    for f in docs.schema:
        column = F.col("row").getField(f.name)
        if text is not None and f.name == "text":
            column = F.col("text")
        elif text is not None and f.name == "n_chars":
            column = F.char_length("text").cast(f.dataType)
        columns.append(column.alias(f.name))
    return rows.select(*columns)


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int | None = None) -> DataFrame:
    """Each end of an edge with the smallest id that edges lead to: ``(id, component)``.

    Rounds of large-star and small-star: each vertex links its larger neighbours, then itself
    and its smaller ones, to the smallest of them, until only stars are left. The number of
    rounds grows as the logarithm of the longest path. A hub is never gathered: the smallest
    neighbour comes from an aggregation that each task begins on its own rows. A round moves the
    edges six times, few edges only three, in few files: a round never has more edges than the last.
    Where the number of ``edges`` is known, ``most``, they begin in few files, too.
    """
    left, right = F.col(a).cast("long"), F.col(b).cast("long")
    now = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    now = now.where("u > v").distinct()
    now = settled(now if most is None else now.coalesce(most // PART_EDGES + 1))
    seen = now.groupBy().agg(*digest(("u", "v"))).first()
    while True:
        few = seen.n <= FEW_EDGES
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(F.broadcast(least) if few else least, "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large if few else large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(F.broadcast(low) if few else low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        small = small.union(low.select("u", F.col("m").alias("v"))).distinct()
        now = settled(small.coalesce(seen.n // PART_EDGES + 1))
        before, seen = seen, now.groupBy().agg(*digest(("u", "v"))).first()
        if seen == before:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def digest(columns: Iterable[str]) -> list[Column]:
    """Count and order-free hash of rows, to tell whether a table changed."""
    mixed = F.xxhash64(*columns)
    return [F.count("*").alias("n"), F.bit_xor(mixed).alias("x"), F.sum(mixed % 1_000_003).alias("s")]
