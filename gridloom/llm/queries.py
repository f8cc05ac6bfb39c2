"""The operators as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import (
    conversation_repair,
    credentials,
    cross_polytope,
    host_rules,
    host_trust,
    language,
    line_dedup,
    minhash_join,
    multi_index,
    packing,
    periodic_runs,
    pieces,
    tool_chat,
)
from gridloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op2_tool_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per row of the table: calls, results, and messages of other roles."""
    calls, results, messages = tool_chat.as_chat(table(spark, sf_dir, "conversations"))
    rows = tool_chat.linked(calls, results, tool_chat.ASK, messages)
    return rows.select(
        "conv_id", "turn", "part", "call_id", "status", "level", "valid", F.sha2("line", 256).alias("line_sha256")
    )


@query
def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op4_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_trust.judged(table(spark, sf_dir, "pages"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


@query
def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op10_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.secret_report(table(spark, sf_dir, "documents"))


@query
def op11_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts are damaged by the checksum of their ids, so that there are runs to be found."""
    return periodic_runs.detect(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_and_repair(table(spark, sf_dir, "conversations"))
