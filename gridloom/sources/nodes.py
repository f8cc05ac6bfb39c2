"""Parsed catalog documents, kept from walk to walk.

Layout under the root::

    commits/<number>.json          the order of refreshes
    nodes/token=<t>/               the documents that a refresh found new, changed or gone

A refresh compares documents with what is kept by a hash of the body, parses those that differ and
no others, and commits them as one batch. The newest row of a document counts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import WriteConflictError
from ..model import CatalogKeys
from ..plans.sizing import settle
from ..plans.walk import PARSED, Catalog, parse_documents, walk_parsed
from .commits import TOKEN, CommitLog, Folder

_NODES = f"{PARSED}, hash string, gone boolean, token string"
_CHANGE = "inserted", "updated", "deleted"


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the number of its commit (None if nothing differed) and one row
    ``(href, part, change)`` for each document that was inserted, updated or deleted."""

    number: int | None
    changes: DataFrame


@dataclass(frozen=True)
class CatalogStore:
    """A catalog tree whose documents are parsed when they change."""

    spark: SparkSession
    root: str
    keys: CatalogKeys = CatalogKeys()

    def _rows(self) -> DataFrame:
        """Every committed row with the number of its refresh."""
        log = CommitLog(self.spark, self.root)
        try:
            rows = self.spark.read.schema(_NODES).parquet(f"{self.root}/nodes")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing.getCondition()):
                raise
            rows = self.spark.createDataFrame([], _NODES)
        return rows.join(log.entries().select(TOKEN, "number"), TOKEN)

    def parsed(self) -> DataFrame:
        """The kept documents as ``parse_documents`` makes them, with the ``hash`` of their body."""
        row = F.struct("node", "item", "hash", "gone")
        newest = self._rows().groupBy("href", "part").agg(F.max_by(row, "number").alias("row"))
        return newest.where(~F.col("row.gone")).select("href", "part", "row.node", "row.item", "row.hash")

    def hashes(self) -> DataFrame:
        """``(href, part, hash)`` of the kept documents."""
        row = F.struct("hash", "gone")
        newest = self._rows().groupBy("href", "part").agg(F.max_by(row, "number").alias("row"))
        return newest.where(~F.col("row.gone")).select("href", "part", "row.hash")

    def walk(self, root_href: str, require_root: bool = False) -> Catalog:
        """Flat tables of the tree, from the kept documents; no body is read."""
        return walk_parsed(self.parsed(), root_href, self.keys, require_root)

    def refresh(self, docs: DataFrame) -> Refresh:
        """Take over the documents as they are now: ``href``, ``body`` and, if there, ``part``.

        Only hashes are compared, and only documents that differ are parsed and written. Of rows
        that repeat ``href`` and ``part``, one counts (that of the greatest hash); rows without
        ``href`` are none. Another refresh that finished in between is a ``WriteConflictError``.
        """
        log = CommitLog(self.spark, self.root)
        seen = log.head()
        part = (F.col("part") if "part" in docs.columns else F.lit(0)).cast("int")
        hashed = docs.where(F.col("href").isNotNull()).select(
            "href", F.coalesce(part, F.lit(0)).alias("part"), "body", F.sha2(F.coalesce("body", F.lit("")), 256).alias("hash")
        )
        now = hashed.groupBy("href", "part").agg(F.max("hash").alias("now"))
        kept = self.hashes().withColumnRenamed("hash", "before")
        both = now.join(kept, ["href", "part"], "full_outer").where(~F.col("now").eqNullSafe(F.col("before")))
        change = F.when(F.col("before").isNull(), _CHANGE[0]).when(F.col("now").isNull(), _CHANGE[2]).otherwise(_CHANGE[1])
        changes = settle(both.select("href", "part", F.col("now").alias("hash"), change.alias("change")))
        if changes.isEmpty():
            return Refresh(None, changes.drop("hash"))
        new = hashed.join(changes.where("hash IS NOT NULL").select("href", "part", "hash"), ["href", "part", "hash"], "left_semi")
        new = new.groupBy("href", "part", "hash").agg(F.any_value("body").alias("body"))  # equal hashes are equal bodies
        told = parse_documents(new, self.keys).join(new.select("href", "part", "hash"), ["href", "part"])
        token = uuid.uuid4().hex
        gone = changes.where("hash IS NULL").select("href", "part", F.lit(True).alias("gone"))
        rows = told.withColumn("gone", F.lit(False)).unionByName(gone, allowMissingColumns=True)
        rows.write.parquet(f"{self.root}/nodes/{TOKEN}={token}")
        if not log.append(seen + 1, token, "refresh"):
            raise WriteConflictError("Another refresh of this catalog was finished first.")
        return Refresh(seen + 1, changes.drop("hash"))

    def compact(self) -> None:
        """Write what is kept as one batch and drop the batches before it. Not while it is read."""
        log, folder = CommitLog(self.spark, self.root), Folder(self.spark, self.root)
        old = {r["number"]: r[TOKEN] for r in log.entries().collect()}  # a row per refresh
        if len(old) < 2:
            return
        token = uuid.uuid4().hex
        self.parsed().withColumn("gone", F.lit(False)).write.parquet(f"{self.root}/nodes/{TOKEN}={token}")
        if not log.append(max(old) + 1, token, "compact"):
            raise WriteConflictError("A refresh of this catalog was finished first.")
        for number, token in old.items():
            log.drop(number)
            folder.delete(f"nodes/{TOKEN}={token}")
