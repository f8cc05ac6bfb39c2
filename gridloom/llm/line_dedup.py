"""Lines that many documents share, dropped by bitmap and not by rewriting text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import WHITE, lower_ascii, packed, stored, unpacked

#: Documents of a key that one sorted run may hold, so that a hot key spreads over tasks.
RUN_DOCS = 8192


def line_occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """``(h1, h2, run, doc_id, th, pos)`` of every line whose key has ``min_chars`` code points.

    A key is the line stripped of ASCII white space, A-Z lower-cased, hashed to 128 bits.
    """
    lines = docs.select(
        "doc_id",
        F.xxhash64("text").alias("th"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"),
    )
    key = lower_ascii(F.btrim("line", F.lit(WHITE)))
    keyed = lines.select("doc_id", "th", "pos", key.alias("key"))
    keyed = keyed.where(F.char_length("key") >= min_chars)
    return keyed.select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("line"), F.reverse("key")).alias("h2"),
        F.expr(f"doc_id div {RUN_DOCS}").alias("run"),
        "doc_id",
        "th",
        "pos",
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``(doc_id, th, dropped)`` of every document that loses a line.

    ``th`` is ``xxhash64`` of the text. ``dropped`` has bit ``i % 64`` of word ``i // 64`` set
    where line ``i`` goes; words after the last such line are left out, and a document that
    keeps all its lines has no row. A key of at least ``min_chars`` code points that at least
    ``min_docs`` different ``doc_id`` hold stays in the largest of them only.

    Hashes are dealt in ranges and sorted by document and position, each run of a key streams
    its documents from the largest down, and only one row per run goes on to the counts. A hot
    key has many runs, each of at most ``RUN_DOCS`` document ids.
    Rows without ``doc_id`` count as no document but lose frequent lines as well.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = Window.partitionBy("h1", "h2", "run").orderBy(F.desc_nulls_last("doc_id"))
    # Stored, as dealing in ranges looks at its rows twice and would split and hash all lines twice.
    seen = stored(
        stored(line_occurrences(docs, min_chars))
        .repartitionByRange(n, "h1", "h2", "run")
        .sortWithinPartitions("h1", "h2", "run", F.desc_nulls_last("doc_id"), "pos")
        .withColumn("nth_doc", F.dense_rank().over(run))
    )
    runs = seen.where("doc_id IS NOT NULL").groupBy("h1", "h2", "run")
    firsts = runs.agg(F.max("doc_id").alias("first"), F.max("nth_doc").alias("docs"))
    keys = firsts.groupBy("h1", "h2").agg(F.max("first").alias("keeper"), F.sum("docs").alias("docs"))
    frequent = keys.where(F.col("docs") >= min_docs).select("h1", "h2", "keeper")
    # Each run learns its keeper, so that the occurrences of a hot key meet it run by run.
    every = seen.select("h1", "h2", "run").where("run IS NULL").distinct()  # of rows without an id
    keeper = firsts.select("h1", "h2", "run").union(every).join(frequent, ["h1", "h2"]).select(
        "h1", "h2", F.coalesce("run", F.lit(-(2**62))).alias("run"), "keeper"
    )
    dealt = seen.withColumn("run", F.coalesce("run", F.lit(-(2**62))))
    lost = dealt.join(keeper, ["h1", "h2", "run"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    words = lost.groupBy("doc_id", "th", F.expr("pos div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")
    )
    packed = words.groupBy("doc_id", "th").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"))
    dense = F.expr(
        "flatten(transform(w, (x, i) -> concat(array_repeat(0L, CAST(x.word - if(i = 0, -1L, "
        "try_element_at(w, i).word) - 1 AS INT)), array(x.bits))))"
    )
    return packed.select("doc_id", "th", dense.alias("dropped"))


def with_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``(row, dropped)``: each document as a struct, with its words (NULL: every line stays).

    The texts move once, to be matched by hash; they are not sorted.
    """
    marks = keep_bitmaps(docs, min_chars, min_docs)
    rows = packed(docs)
    same = rows["id"].eqNullSafe(marks["doc_id"]) & (rows["hash"] == marks["th"])
    return rows.join(marks.hint("shuffle_hash"), same, "left").select("row", "dropped")


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines that stay, joined by line feeds; a NULL text is empty."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    word = lambda i: F.coalesce(F.try_element_at(dropped, F.floor(i / 64).cast("int") + 1), F.lit(0))
    stays = F.filter(lines, lambda line, i: F.getbit(word(i), F.pmod(i, F.lit(64))) == 0)
    return F.when(dropped.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(stays, "\n"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The documents with frequent lines gone from ``text`` (``n_chars`` follows, if there)."""
    marked = with_bitmaps(docs, min_chars, min_docs)
    text = F.when(F.col("row.text").isNotNull(), kept_text(F.col("row.text"), F.col("dropped")))
    return unpacked(marked, docs, text)


def line_report(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)``, one row per row of the documents."""
    marked = with_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs)
    dropped = F.coalesce(
        F.aggregate("dropped", F.lit(0).cast("long"), lambda total, w: total + F.bit_count(w)), F.lit(0)
    )
    return marked.select(
        "row.doc_id",
        F.size(F.split(F.coalesce("row.text", F.lit("")), "\n")).cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
        F.sha2(kept_text(F.col("row.text"), F.col("dropped")), 256).alias("kept_sha256"),
    )
