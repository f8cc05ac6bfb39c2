"""Where small derived tables are kept, and when one may be broadcast.

Joins are plain equi-joins whose looked-up side has one row per key (or few): the
engine broadcasts that side where its measured bytes allow, and else splits the
partitions of hot keys. Only a narrow side that was counted is broadcast by force.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Most rows of narrow (few numbers or short names) rows that are broadcast.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as ``spark.checkpoint.dir`` names it.

    A session of one machine gets a temporary folder where none is set.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors reach.")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="gridloom-"))
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Compute a small derived table once, in the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def fits(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    return df.limit(limit + 1).count() <= limit
