"""Series of variants, kept joined and brought up to date write by write.

Layout under the root::

    commits/<number>.json          the order of updates
    cells/token=<t>/               cells that an update added
    state/token=<t>/               one row per variant after the update

Of each variant the cells after some coordinate are held (``held_from``), and shown are those after
its cut-off, the last coordinate of all variants preferred to it. A write of a preferred variant that
reaches further raises cut-offs and so takes cells out of the series without touching them; one
that replaces it by a shorter variant lowers them, and only the cells between are fetched.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import WriteConflictError
from ..operators.concat import DEFAULT_DIMENSION, place_variants
from ..plans.sizing import settle
from .cells import APPEND, OVERWRITE
from .commits import TOKEN, CommitLog, Folder


@dataclass(frozen=True)
class KeptSeries:
    """One series for each value of the ``group`` columns, joined along ``dim``."""

    spark: SparkSession
    root: str
    dim: str = DEFAULT_DIMENSION
    group: tuple[str, ...] = ("collection", "dataset")
    variant: str = "variant"

    @property
    def keys(self) -> list[str]:
        return [*self.group, self.variant]

    def _tokens(self) -> list[str]:
        entries = CommitLog(self.spark, self.root).entries()
        return [r[TOKEN] for r in entries.orderBy("number").collect()]  # a row per update

    def state(self) -> DataFrame | None:
        """One row per variant: its keys, ``priority``, ``tie``, ``variant_last``, ``cutoff``,
        ``held_from`` and ``generation``; None before the first update."""
        tokens = self._tokens()
        return self.spark.read.parquet(f"{self.root}/state/{TOKEN}={tokens[-1]}") if tokens else None

    def read(self) -> DataFrame:
        """The joined series: cells with their group and variant."""
        tokens = self._tokens()
        if not tokens:
            raise ValueError("Nothing has been written to this series.")
        batches = [self.spark.read.parquet(f"{self.root}/cells/{TOKEN}={t}") for t in tokens]
        cells = batches[0]
        for more in batches[1:]:
            cells = cells.unionByName(more, allowMissingColumns=True)
        state = self.spark.read.parquet(f"{self.root}/state/{TOKEN}={tokens[-1]}")
        shown = state.select(*self.keys, F.col("generation").alias("_generation"), F.col("cutoff").alias("_cutoff"))
        rows = cells.join(shown, [*self.keys, "_generation"])
        rows = rows.where(F.col("_cutoff").isNull() | (F.col(self.dim) > F.col("_cutoff")))
        return rows.select(*[c for c in cells.columns if c != "_generation"])

    def apply(
        self,
        tagged: DataFrame,
        mode: str = APPEND,
        source: DataFrame | None = None,
        priority: str = "concat_priority",
        order: str = "ord",
    ) -> int:
        """Take over cells of some variants; returns the number of the update.

        ``tagged`` has the keys, ``priority`` (NULL = last), ``order`` (which settles ties) and the
        cells. ``append`` adds them to their variants, ``overwrite`` replaces these; variants
        that are not in ``tagged`` stay. ``source`` has the cells of all variants after the write
        and is read where a cut-off falls, between the old one and the new.

        Everything but the cells themselves runs on one row per variant.
        """
        if mode not in (APPEND, OVERWRITE):
            raise ValueError(f"mode is {APPEND} or {OVERWRITE}.")
        dtype = tagged.schema[self.dim].dataType
        if isinstance(dtype, T.StringType):
            raise ValueError("Series are kept along numbers, dates or instants; convert text first.")
        log = CommitLog(self.spark, self.root)
        seen, before = log.head(), self.state()
        tagged = self._known(tagged)
        new = tagged.groupBy(*self.keys).agg(
            F.min(priority).cast("double").alias("new_priority"),
            F.min(order).cast("long").alias("new_tie"),
            F.max(self.dim).alias("new_last"),
            F.lit(True).alias("written"),
        )
        replaced = F.lit(mode == OVERWRITE) & F.coalesce("written", F.lit(False))
        if before is None:
            kind = dtype.simpleString()
            old = new.select(*self.keys).limit(0)
            for name, of in (("priority", "double"), ("tie", "long"), ("variant_last", kind), ("held_from", kind), ("generation", "long"), ("known", "boolean")):
                old = old.withColumn(name, F.lit(None).cast(of))
        else:
            old = before.drop("cutoff").withColumn("known", F.lit(True))
        both = new.join(old, self.keys, "full_outer")
        known = F.coalesce("known", F.lit(False))
        summary = both.select(
            *self.keys,
            F.when(F.col("written"), F.col("new_priority")).otherwise(F.col("priority")).alias("priority"),
            F.coalesce("new_tie", "tie").alias("tie"),
            F.when(replaced, F.col("new_last")).otherwise(F.greatest("variant_last", "new_last")).alias("variant_last"),
            F.when(known & ~replaced, F.col("held_from")).alias("held_before"),
            (known & ~replaced).alias("continued"),
            (F.coalesce("generation", F.lit(0)) + replaced.cast("long")).alias("generation"),
            F.coalesce("written", F.lit(False)).alias("written"),
        )
        placed = place_variants(summary, self.group, self.variant).drop("concat_position")
        # NULL stands below every coordinate: all cells are held, or shown.
        lower = F.when(F.col("held_before").isNull() | F.col("cutoff").isNull(), F.lit(None)).otherwise(F.least("held_before", "cutoff"))
        placed = placed.withColumn("held_from", F.when(F.col("continued"), lower).otherwise(F.col("cutoff")))
        fallen = F.col("continued") & F.col("held_before").isNotNull() & (F.col("held_from").isNull() | (F.col("held_from") < F.col("held_before")))
        placed = settle(placed.withColumn("fallen", fallen))

        extra = {priority, order} - set(self.keys)
        shown = [c for c in tagged.columns if c not in extra]
        own = placed.where("written").select(
            *self.keys, F.col("generation").alias("_generation"), F.when(F.col("continued"), F.col("held_before")).otherwise(F.col("held_from")).alias("_from")
        )
        added = tagged.join(own, self.keys).where(F.col("_from").isNull() | (F.col(self.dim) > F.col("_from")))
        added = added.select(*shown, "_generation")
        back = placed.where("fallen").select(
            *self.keys, F.col("generation").alias("_generation"), F.col("held_from").alias("_from"), F.col("held_before").alias("_to")
        )
        if not back.isEmpty():
            if source is None:
                raise ValueError("A cut-off falls: the cells of all variants are needed as the source.")
            between = F.col("_from").isNull() | (F.col(self.dim) > F.col("_from"))
            fetched = self._known(source).join(back, self.keys).where(between & (F.col(self.dim) <= F.col("_to")))
            cells = [c for c in source.columns if c not in extra]
            added = added.unionByName(fetched.select(*cells, "_generation"), allowMissingColumns=True)
        token = uuid.uuid4().hex
        added.write.parquet(f"{self.root}/cells/{TOKEN}={token}")
        state = placed.select(*self.keys, "priority", "tie", "variant_last", "cutoff", "held_from", "generation")
        state.write.parquet(f"{self.root}/state/{TOKEN}={token}")
        if not log.append(seen + 1, token, mode):
            raise WriteConflictError("Another update of this series was finished first.")
        return seen + 1

    def _known(self, cells: DataFrame) -> DataFrame:
        """Cells with a coordinate: NULL and NaN are on no place of the series."""
        here = F.col(self.dim).isNotNull()
        if isinstance(cells.schema[self.dim].dataType, (T.DoubleType, T.FloatType)):
            here = here & ~F.isnan(self.dim)
        return cells.where(here)

    def compact(self) -> None:
        """Write what is shown as one batch and drop the others. Not while the series is read."""
        log, folder = CommitLog(self.spark, self.root), Folder(self.spark, self.root)
        old = {r["number"]: r[TOKEN] for r in log.entries().collect()}  # a row per update
        if len(old) < 2:
            return
        token, state = uuid.uuid4().hex, self.state()
        generation = state.select(*self.keys, F.col("generation").alias("_generation"))
        self.read().join(generation, self.keys).write.parquet(f"{self.root}/cells/{TOKEN}={token}")
        state.withColumn("held_from", F.col("cutoff")).write.parquet(f"{self.root}/state/{TOKEN}={token}")
        if not log.append(max(old) + 1, token, "compact"):
            raise WriteConflictError("An update of this series was finished first.")
        for number, token in old.items():
            log.drop(number)
            for part in ("cells", "state"):
                folder.delete(f"{part}/{TOKEN}={token}")
