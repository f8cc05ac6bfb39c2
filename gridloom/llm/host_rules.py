"""Quality rules for documents and for the hosts they come from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import WHITE, stored

SYMBOLS = "[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: A document fails a rule when its expression holds; hosts are judged by each rule.
RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 10 * n_words",
    "copied_lines": "100 * n_dup_lines > 50 * n_lines",
}
BASE_RULES = ("short", "repetitive")

#: Rows with their texts that a task copies and hands on at once.
ROWS = 512

#: A host goes when the shrunk share of its documents that fail some rule is above this.
MAX_RATE = 0.9
#: The prior weighs as much as so many documents at least, so that one or two damn no host.
MIN_STRENGTH = 2.0


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside a window of ``width`` words that stands at least twice in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    windows = codes[:n]
    for k in range(1, width):
        # Renumbered at each step, a code stays below the number of words squared.
        windows = np.unique(windows, return_inverse=True)[1] * len(ids) + codes[k : k + n]
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(times[which] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` of one whole text; NULL has neither words nor lines."""
    if not text:
        return (0, 0, 0, 0, 0, 0)
    words = text.encode().split()  # bytes split at exactly the ASCII white space
    seen: set[str] = set()
    lines = copies = 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            lines += 1
            copies += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, "#*$%&|<>")),
        lines,
        copies,
        repeated_words(words),
    )


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, *COUNTS)``; the text does not leave the task that reads it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_counts(x.as_py()) for x in batch.column(2)]
            counts = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *counts], names=out)

    out = ["doc_id", "source", *COUNTS]
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"doc_id {kinds['doc_id']}", f"source {kinds['source']}", *(f"{c} long" for c in COUNTS)])
    return docs.select("doc_id", "source", "text").mapInArrow(run, schema)


def shrunk(failed: Column, n: Column, p: Column, strength: Column) -> Column:
    """Posterior mean of a failure rate under the beta prior (p * strength, (1 - p) * strength)."""
    return (failed + p * strength) / (n + strength)


def host_verdicts(counts: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """``(source, n_docs, <rule>_rate.., host_failed)`` of each host that is not NULL.

    A prior is fitted per rule by the moments of the hosts' rates, each weighted by its
    documents. Where hosts differ no more than chance would have them (or there is one host),
    every rate is the overall one. Hosts are summed within each task first, so a hot one
    weighs no more than others; all else runs on one row per host or one row in all.
    """
    fails = [F.sum(F.expr(f"CAST({rule} AS LONG)")).alias(f"f_{name}") for name, rule in RULES.items()]
    hosts = counts.where("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("n_docs"), *fails)
    sums = [
        F.count("*").alias("k"),
        F.sum("n_docs").alias("n"),
        F.sum(F.col("n_docs") * F.col("n_docs").cast("double")).alias("n2"),
    ]
    for name in RULES:
        f = F.col(f"f_{name}")
        sums += [F.sum(f).alias(f"t_{name}"), F.sum(f * f.cast("double") / F.col("n_docs")).alias(f"q_{name}")]
    total = hosts.agg(*sums)
    k, n, n2 = F.col("k"), F.col("n"), F.col("n2")
    priors = []
    for name in RULES:
        p = F.col(f"t_{name}") / n
        chance = p * (1 - p)
        between = (F.col(f"q_{name}") - n * p * p - (k - 1) * chance) / (n - n2 / n)
        fitted = (k > 1) & (n > n2 / n) & (chance > 0) & (between > 0)
        priors += [p.alias(f"p_{name}"), F.when(fitted, F.greatest(chance / between - 1, F.lit(MIN_STRENGTH))).alias(f"s_{name}")]
    judged = hosts.crossJoin(F.broadcast(total.select(*priors)))  # one row beside each host
    rates = [
        F.coalesce(
            shrunk(F.col(f"f_{name}"), F.col("n_docs"), F.col(f"p_{name}"), F.col(f"s_{name}")), F.col(f"p_{name}")
        ).alias(f"{name}_rate")
        for name in RULES
    ]
    judged = judged.select("source", "n_docs", *rates)
    worst = F.greatest(*(F.col(f"{name}_rate") for name in RULES))
    return judged.withColumn("host_failed", worst > max_rate)


def judge(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """``(doc_id, source, *COUNTS, base_failed, host_failed, kept)``, one row per document.

    A document is kept unless it fails a base rule itself or its host fails. Documents
    without a source have no host. Texts of any length are measured once, to a narrow table that
    both hosts and rows are judged from. Only hosts that failed are joined back, as a stored table, so
    that few of them are broadcast by their measured size and many are not.
    """
    counts = stored(measured(docs))
    failed = stored(host_verdicts(counts, max_rate).where("host_failed").select("source", "host_failed"))
    base = " OR ".join(f"({RULES[name]})" for name in BASE_RULES)
    out = counts.withColumn("base_failed", F.expr(base)).join(failed, "source", "left")
    out = out.withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
    columns = ["doc_id", "source", *COUNTS, "base_failed", "host_failed"]
    return out.select(*columns, (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"))


def marked(docs: DataFrame) -> DataFrame:
    """``(row, source, *COUNTS, good)``: each document measured once; those that fail a base rule
    leave their counts and no ``row``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, ROWS) for k in range(0, len(whole), ROWS)):
                rows = [text_counts(x.as_py()) for x in batch.column(2)]
                good = [n >= 50 and not 100 * repeats > 50 * n for n, *_, repeats in rows]
                counts = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                kept = batch.column(0).take(pa.array([i if g else None for i, g in enumerate(good)], pa.int64()))
                yield pa.RecordBatch.from_arrays([kept, batch.column(1), *counts, pa.array(good, pa.bool_())], names=names)

    names = ["row", "source", *COUNTS, "good"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "source", "text")
    fields = [rows.schema["row"], rows.schema["source"], *(T.StructField(c, T.LongType()) for c in COUNTS), T.StructField("good", T.BooleanType())]
    nullable = [T.StructField(f.name, f.dataType, True) for f in fields]
    return rows.mapInArrow(run, T.StructType(nullable))


def keep_good(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns.

    One pass measures the texts and writes those that pass the base rules; hosts are judged from the
    counts beside them. No text is dealt by its host: the hosts that failed come as a stored table, and
    if they are too many to be broadcast, the engine splits what a hot one has.
    """
    rows = stored(marked(docs))
    failed = stored(host_verdicts(rows.select("source", *COUNTS), max_rate).where("host_failed").select("source"))
    kept = rows.where("good").join(failed, "source", "left_anti")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
