"""A training corpus from raw documents, in stages that each write a table.

Rejected documents go, frequent lines go, one document of each group of near duplicates
stays, secrets are masked, and what is left is packed into sequences.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import credentials, host_rules, line_dedup, minhash_join, packing
from gridloom.llm.common import shared_dir, table

#: Documents are near duplicates when their five-word shingles have this similarity, in hundredths, or more.
NEAR = 80
#: Words that a worker remembers for packing. It lives on beside other stages, which need the memory more.
REMEMBERED = 1 << 17

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no base rule and whose host does not fail."""
    return host_rules.keep_good(docs)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that later documents repeat."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return minhash_join.one_of_each(docs, NEAR)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with secrets and linked credential parts masked."""
    return credentials.redact(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids as pieces of power-of-two lengths, one sequence each; pieces of one
    ``bucket`` have one length and can be batched as they are."""
    return packing.pack(docs, with_ids=True, remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", shared_lines),
    ("minhash_near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("packing", sequences),
]

#: The last stage needs a tokenizer, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
