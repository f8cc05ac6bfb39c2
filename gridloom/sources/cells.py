"""Cell store: Parquet tables by content id and year, with tables of what they hold.

Layout under the root, where every write has a token of its own::

    commits/<number>.json                          the order of writes
    datasets/token=<t>/                            one row per written dataset
    files/token=<t>/                               one row per file of cells, with its zones
    cells/token=<t>/cid=<cid>/cell_year=<year>/
    axes/<dimension>/token=<t>/cid=<cid>/

A write makes its cells, axes and tables first and its commit last. What failed half-way is
never seen, a replaced dataset is seen whole, and other datasets are left alone. ``vacuum``
removes what no reader can see.

Files are ranged by place and time. The zones (lowest and highest value of each dimension) choose
the files that a selection opens, in a Spark job over the file table; row-group statistics prune
within these; and the axis tables answer nearest lookups without touching the cells.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import WriteConflictError
from ..model import LATITUDE_KEYS, LONGITUDE_KEYS, TIME_KEYS, YEAR_PARTITION, infer_coord, infer_dims
from .commits import TOKEN, CommitLog, Folder

CID = "cid"
TILE_DEGREES = 10.0

ERROR, APPEND, OVERWRITE = "errorifexists", "append", "overwrite"

#: One row per dataset and write: columns as JSON fields, dimensions among them, and the
#: dimension whose UTC year is the directory.
_DATASETS = "cid STRING, fields ARRAY<STRING>, dims ARRAY<STRING>, year_of STRING, token STRING"
#: One row per file of cells: its name under the root, its rows, and the zone of each dimension
#: whose values are numbers, dates or instants.
_FILES = "cid STRING, year INT, path STRING, n LONG, zones MAP<STRING, STRUCT<low: DOUBLE, high: DOUBLE>>, token STRING"

#: Inclusive bounds by dimension as zone numbers, None for an open side; all must be met.
Bounds = dict[str, tuple[float | None, float | None]]
#: Conditions that must all be met, each by one of its alternatives.
Conditions = list[list[Bounds]]


def cid_required(cid: str | None) -> str:
    if not cid:
        raise ValueError("A content id must be given to open a dataset.")
    return cid


def utc_year(column: Column, dtype: T.DataType) -> Column:
    """Year of the instant in UTC, whatever the zone of the session."""
    if isinstance(dtype, T.TimestampType):
        days = F.floor(F.unix_micros(column) / F.lit(86_400_000_000))
        return F.year(F.date_from_unix_date(days.cast("int")))
    return F.year(column)


def _dated(df: DataFrame, dims) -> str | None:
    """The first time dimension, if it holds dates or instants."""
    key = infer_coord(dims, TIME_KEYS)
    dated = key and isinstance(df.schema[key].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
    return key if dated else None


def zone_number(column: Column, dtype: T.DataType) -> Column | None:
    """A number that grows with the value: itself, or microseconds. None for other types.

    Rounding to a double keeps the order, so zones made of these never miss a value.
    """
    if isinstance(dtype, T.NumericType):
        return column.cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(column) * F.lit(86_400_000_000.0)
    return None


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def _datasets(spark: SparkSession, root: str) -> DataFrame:
    """The visible rows with their commit's ``number``: from the last write that replaced a
    dataset on. Writes without a commit are not there."""
    rows = _read(spark, f"{root}/datasets", _DATASETS).join(CommitLog(spark, root).entries(), TOKEN)
    newest = F.max(F.when(F.col("mode") != APPEND, F.col("number"))).over(Window.partitionBy(CID))
    return rows.withColumn("_since", newest).where(F.col("_since").isNull() | (F.col("number") >= F.col("_since"))).drop("_since")


def _file_rows(written: DataFrame, root: str, dims) -> DataFrame:
    """One row per file just written; only the dimensions are read."""
    # The name is an encoded URI; a plus stands for itself in it.
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    zones = []
    for dim in dims:
        number = zone_number(F.col(dim), written.schema[dim].dataType)
        if number is not None:
            zones.append((dim, F.nanvl(number, F.lit(float("inf")))))
    low_high = [x for dim, number in zones for x in (F.lit(dim), F.struct(F.min(number).alias("low"), F.max(number).alias("high")))]
    zone_map = F.create_map(*low_high) if low_high else F.create_map().cast("map<string, struct<low: double, high: double>>")
    rows = written.groupBy(CID, YEAR_PARTITION, name.alias("file")).agg(F.count("*").alias("n"), zone_map.alias("zones"))
    # Behind the root, so that a store can be moved.
    return rows.select(CID, F.col(YEAR_PARTITION).alias("year"), F.regexp_extract("file", "(cells/token=.*)$", 1).alias("path"), "n", "zones")


def write_cells(
    df: DataFrame,
    root: str,
    cid_column: str = CID,
    dims=None,
    tile_degrees: float = TILE_DEGREES,
    mode: str = ERROR,
) -> int:
    """Write the cells of one or many datasets, and their axes; returns the number of the commit.

    ``dims`` are the dimensions (by default those with a coordinate's name); with the types and
    attributes of all columns they are stored. ``mode`` is about the datasets in ``df`` alone:
    ``errorifexists`` refuses those that are there, ``append`` adds cells to them, and
    ``overwrite`` replaces them. Rows without a content id are refused.

    Writers may run at once. One that finishes after another takes the next number, and fails
    with ``WriteConflictError`` if both had the same dataset, unless both appended.

    The range partitioning uses tile, time and position, so a dataset or tile
    with most of the cells is still cut into even files.
    """
    if mode not in (ERROR, APPEND, OVERWRITE):
        raise ValueError(f"mode is {ERROR}, {APPEND} or {OVERWRITE}.")
    spark = df.sparkSession
    cells = df.withColumnRenamed(cid_column, CID).withColumn(CID, F.col(cid_column).cast("string"))
    if {TOKEN, YEAR_PARTITION} & set(cells.columns):
        raise ValueError(f"Columns called {TOKEN} or {YEAR_PARTITION} cannot be stored.")
    seen = CommitLog(spark, root).head()
    dims = tuple(dims or infer_dims(T.StructType([f for f in cells.schema if f.name != CID])))
    present = cells.select(CID).distinct()
    if not present.where(f"{CID} IS NULL OR {CID} = ''").isEmpty():
        raise ValueError("Every cell needs a content id.")
    if mode == ERROR and not present.join(_datasets(spark, root), CID, "left_semi").isEmpty():
        raise ValueError("A dataset of this content id is stored already.")
    token = uuid.uuid4().hex
    lat, lon = infer_coord(dims, LATITUDE_KEYS), infer_coord(dims, LONGITUDE_KEYS)
    time_key, year_of = infer_coord(dims, TIME_KEYS), _dated(cells, dims)
    year = utc_year(F.col(year_of), cells.schema[year_of].dataType) if year_of else F.lit(0)
    tiles = [F.floor(F.col(d) / tile_degrees) for d in (lat, lon) if d]
    place = [d for d in (lat, lon) if d]
    order = [CID, YEAR_PARTITION, *tiles, *[F.col(d) for d in (time_key, *place) if d]]
    (
        cells.withColumn(YEAR_PARTITION, year)
        .repartitionByRange(*order)
        .sortWithinPartitions(CID, YEAR_PARTITION, *place, *([time_key] if time_key else []))
        .write.partitionBy(CID, YEAR_PARTITION)
        .parquet(f"{root}/cells/{TOKEN}={token}")
    )
    fields = [f for f in cells.schema if f.name != CID]
    stored = [T.StructField(CID, T.StringType()), T.StructField(YEAR_PARTITION, T.IntegerType())]
    written = spark.read.schema(T.StructType([*fields, *stored])).parquet(f"{root}/cells/{TOKEN}={token}")
    for dim in dims:
        axis = written.select(CID, dim).where(F.col(dim).isNotNull()).distinct()
        # Ordered by dataset, so that the number of files follows the axes and not the tasks.
        axis.repartitionByRange(CID, dim).write.partitionBy(CID).parquet(f"{root}/axes/{dim}/{TOKEN}={token}")
    files = _file_rows(written, root, dims)
    files.repartitionByRange(CID, "year").sortWithinPartitions(CID, "year").write.parquet(f"{root}/files/{TOKEN}={token}")
    rows = spark.read.parquet(f"{root}/files/{TOKEN}={token}").select(CID).distinct().select(
        CID,
        F.array(*[F.lit(f.json()) for f in fields]).cast("array<string>").alias("fields"),
        F.array(*[F.lit(d) for d in dims]).cast("array<string>").alias("dims"),
        F.lit(year_of).cast("string").alias("year_of"),
    )
    rows.write.parquet(f"{root}/datasets/{TOKEN}={token}")
    return _commit(spark, root, token, mode, seen)


def _commit(spark: SparkSession, root: str, token: str, mode: str, seen: int) -> int:
    """Take the next number, after a look at the commits since ``seen``."""
    log = CommitLog(spark, root)
    while True:
        head = log.head()
        if head > seen:
            since = log.entries().where(F.col("number") > seen)
            if mode == APPEND:
                since = since.where(F.col("mode") != APPEND)
            all_rows = _read(spark, f"{root}/datasets", _DATASETS)
            theirs = all_rows.join(since, TOKEN).select(CID)
            if not all_rows.where(F.col(TOKEN) == token).join(theirs, CID, "left_semi").isEmpty():
                raise WriteConflictError("Another write of the same dataset was finished first.")
            seen = head
        if log.append(head + 1, token, mode):
            return head + 1


def vacuum(spark: SparkSession, root: str, retain_seconds: float = 86_400.0) -> int:
    """Remove what no read can see and what has been so for ``retain_seconds``; returns how many
    directories and commits went.

    That is what unfinished writes left, and datasets that a later write replaced. Reads that
    began before the replacement need their files, and a write without a commit may still
    be going on: the time kept should be longer than both take. The age is read from the file system.
    """
    log, folder = CommitLog(spark, root), Folder(spark, root)
    before = time.time() - retain_seconds
    taken = log.numbers()
    commits = {r["number"]: r["token"] for r in log.entries().collect()}  # a row per write
    known = set(commits.values())
    rows = _read(spark, f"{root}/datasets", _DATASETS).select(CID, TOKEN, "dims").join(log.entries(), TOKEN)
    newest = F.max(F.when(F.col("mode") != APPEND, F.col("number"))).over(Window.partitionBy(CID))
    rows = rows.withColumn("since", newest).withColumn("dead", F.coalesce(F.col("number") < F.col("since"), F.lit(False)))
    old = [n for n, at in taken.items() if at <= before]
    settled = F.col("since").isin(old) if old else F.lit(False)  # replaced long enough ago
    # What goes is told before anything does: a row per write, and a row per directory.
    left = rows.groupBy("number", TOKEN).agg(F.min(F.col("dead") & settled).alias("all_dead")).where("all_dead")
    whole = {r["number"]: r[TOKEN] for r in left.collect()}
    dead = [r for r in rows.where(F.col("dead") & settled).collect() if r[TOKEN] not in whole.values()]
    gone = 0
    parts = ["cells", "files", "datasets", *(f"axes/{d}" for d in folder.names("axes"))]
    for part in parts:
        for name, at in folder.names(part).items():
            if name.startswith(f"{TOKEN}=") and name.removeprefix(f"{TOKEN}=") not in known and at <= before:
                folder.delete(f"{part}/{name}")
                gone += 1
    for r in dead:
        for part in ("cells", *(f"axes/{d}" for d in r["dims"])):
            target, name = f"{part}/{TOKEN}={r[TOKEN]}", f"{CID}={_escaped(r[CID])}"
            if name in folder.names(target):
                folder.delete(f"{target}/{name}")
                gone += 1
    for number, token in whole.items():
        if number != max(taken):  # the head stays, as the next number follows it
            log.drop(number)
        for part in parts:
            folder.delete(f"{part}/{TOKEN}={token}")
        gone += 1
    return gone


@dataclass(frozen=True)
class OpenedCells:
    """Cells of one dataset with what the store knows of them.

    ``cells`` may carry the year directory as a column; it is the UTC year of ``year_of``.
    ``within`` gives the cells of the files that meet some bounds, where the store has zones.
    """

    cells: DataFrame
    dims: tuple[str, ...] | None = None
    axes: dict[str, DataFrame] = field(default_factory=dict)
    year_of: str | None = None
    within: Callable[[Conditions], DataFrame] | None = None


def _meets(conditions: Conditions) -> Column:
    """Whether a file's zones meet the conditions. A dimension without a zone may hold anything, one
    whose zone is NULL holds NULL alone, which no bound takes in."""

    def met(bounds: Bounds) -> Column:
        found = F.lit(True)
        for dim, (low, high) in bounds.items():
            zone = F.try_element_at("zones", F.lit(dim))
            here = F.lit(True)
            if low is not None:
                here = here & (zone["high"] >= F.lit(float(low)))
            if high is not None:
                here = here & (zone["low"] <= F.lit(float(high)))
            found = found & (zone.isNull() | F.coalesce(here, F.lit(False)))
        return found

    return reduce(and_, [reduce(or_, map(met, alternatives)) for alternatives in conditions], F.lit(True))


def _union_of(fields: list[str]) -> list[T.StructField]:
    """Columns by name, from JSON fields; one name has one type."""
    found: dict[str, T.StructField] = {}
    for text in fields:
        f = T.StructField.fromJson(json.loads(text))
        known = found.setdefault(f.name, f)
        if known.dataType != f.dataType:
            raise ValueError(f"Column {f.name} is stored as {known.dataType.simpleString()} and {f.dataType.simpleString()}.")
    return [T.StructField(f.name, f.dataType, True, f.metadata) for f in found.values()]


@dataclass(frozen=True)
class CellStore:
    """Datasets written by ``write_cells``."""

    spark: SparkSession
    root: str

    def datasets(self) -> DataFrame:
        """One row per visible write of a dataset: ``cid``, columns, dimensions, ``token`` and ``number``."""
        return _datasets(self.spark, self.root)

    def head(self) -> int:
        """Number of the last commit; 0 before the first."""
        return CommitLog(self.spark, self.root).head()

    def changes(self, since: int = 0) -> DataFrame:
        """``(cid, replaced)`` of the datasets written after a commit: replaced, or only added to."""
        later = self.datasets().where(F.col("number") > since)
        return later.groupBy(CID).agg(F.bool_or(F.col("mode") != APPEND).alias("replaced"))

    def files(self, bounds: Bounds | None = None, cids: DataFrame | None = None, since: int = 0) -> DataFrame:
        """One row per visible file: ``cid``, ``year``, ``path``, rows ``n`` and ``zones``.

        ``bounds`` keeps the files that may hold a cell within them, ``cids`` those of the
        datasets of a table with a ``cid`` column, ``since`` those of later commits. Ends are numbers
        as ``zone_number`` makes them.
        """
        rows = _read(self.spark, f"{self.root}/files", _FILES)
        visible = self.datasets().where(F.col("number") > since)
        rows = rows.join(visible.select(CID, TOKEN), [CID, TOKEN], "left_semi")
        if bounds:
            rows = rows.where(_meets([[bounds]]))
        return rows.join(cids.select(CID), CID, "left_semi") if cids is not None else rows

    def emptiness(self, wanted: DataFrame) -> DataFrame:
        """The rows of ``wanted`` with ``is_empty``: whether the dataset ``cid`` has no cells, and
        ``is_dataset_empty``: or no variables. One job, and no cell is read."""
        variables = F.max(F.size("fields") - F.size("dims")).alias("variables")
        held = self.datasets().groupBy(CID).agg(variables)
        cells = self.files().groupBy(CID).agg(F.sum("n").alias("cells"))
        known = held.join(cells, CID, "left").select(CID, F.struct("variables", "cells").alias("held"))
        rows = wanted.select(F.struct(*(F.col(f"`{c}`") for c in wanted.columns)).alias("row"), CID).join(known, CID, "left")
        empty = F.coalesce(F.col("held.cells"), F.lit(0)) == 0
        return rows.select(
            *(F.col("row").getField(c).alias(c) for c in wanted.columns),
            empty.alias("is_empty"),
            (empty | (F.coalesce(F.col("held.variables"), F.lit(0)) == 0)).alias("is_dataset_empty"),
        )

    def open(self, cid: str) -> OpenedCells:
        """Lazy cells of one dataset; only its directories are listed."""
        writes = self.datasets().where(F.col(CID) == cid_required(cid)).orderBy("number").collect()  # a row per write
        if not writes:
            raise ValueError(f"No dataset {cid} is stored.")
        fields = _union_of([f for w in writes for f in w["fields"]])
        dims = tuple(dict.fromkeys(d for w in writes for d in w["dims"]))
        years = {w["year_of"] for w in writes}
        year_of = years.pop() if len(years) == 1 else None
        schema = T.StructType([*fields, T.StructField(YEAR_PARTITION, T.IntegerType())])
        shown = schema.names if year_of else [f.name for f in fields]
        axes = {}
        for dim in dims:
            having = [w for w in writes if dim in w["dims"]]
            kind = next(f for f in fields if f.name == dim)
            axis = self._directories(T.StructType([kind]), f"axes/{dim}", cid, having)
            axes[dim] = axis.distinct() if len(having) > 1 else axis

        tables = [f"{self.root}/files/{TOKEN}={w[TOKEN]}" for w in writes]

        def within(conditions: Conditions) -> DataFrame:
            rows = self.spark.read.schema(_FILES).option("basePath", f"{self.root}/files").parquet(*tables)
            chosen = rows.where((F.col(CID) == cid) & _meets(conditions)).select("path").collect()  # the files to be opened
            return self._opened(schema, [r[0] for r in chosen]).select(*shown)

        cells = self._directories(schema, "cells", cid, writes).select(*shown)
        return OpenedCells(cells, dims, axes, year_of, within)

    def _directories(self, schema: T.StructType, part: str, cid: str, writes) -> DataFrame:
        """One part of a dataset over all its writes."""
        names = [f.name for f in schema]
        whole = None
        for w in writes:
            path = f"{self.root}/{part}/{TOKEN}={w[TOKEN]}/{CID}={_escaped(cid)}"
            read = self.spark.read.schema(schema).parquet(path).select(*names)
            whole = read if whole is None else whole.unionByName(read)
        return whole

    def _opened(self, schema: T.StructType, paths: list[str]) -> DataFrame:
        """The cells of some files; no other file or directory is looked at."""
        if not paths:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema).option("basePath", f"{self.root}/cells")
        return read.parquet(*(f"{self.root}/{p}" for p in paths))

    def read(self, cid: str) -> DataFrame:
        """The cells as they were written."""
        return self.open(cid).cells.drop(YEAR_PARTITION)

    def table(self, cids: DataFrame | None = None, bounds: Bounds | None = None, since: int = 0) -> DataFrame:
        """Cells of all datasets with their ``cid``: a column that a dataset lacks is NULL.

        ``cids`` (a table with a ``cid`` column), ``bounds`` and ``since`` (a commit) leave out files that hold
        nothing else; they are no filter on the cells of the files that stay. Superseded
        writes and other datasets are not listed: the file table names what is opened.
        """
        visible = self.datasets()
        fields = _union_of([r[0] for r in visible.select(F.explode("fields")).distinct().collect()])  # a row per column
        schema = T.StructType([*fields, T.StructField(CID, T.StringType())])
        chosen = [r[0] for r in self.files(bounds, cids, since).select("path").collect()]  # the files to be opened
        return self._opened(schema, chosen).select(CID, *[f.name for f in fields])

    def axis_table(self, dim: str) -> DataFrame:
        """Axis values of all datasets with their ``cid``."""
        visible = self.datasets().where(F.array_contains("dims", dim))
        stored = [r[0] for r in visible.select(F.explode("fields")).distinct().collect()]
        fields = [f for f in _union_of(stored) if f.name == dim]
        directories = [T.StructField(TOKEN, T.StringType()), T.StructField(CID, T.StringType())]
        rows = self.spark.read.schema(T.StructType([*fields, *directories])).parquet(f"{self.root}/axes/{dim}")
        return rows.join(visible.select(CID, TOKEN), [CID, TOKEN], "left_semi").select(CID, dim).distinct()


def _escaped(name: str) -> str:
    """A directory's name as Spark writes it: control and special characters by their codes."""
    special = "\"#%'*/:=?\\{}[]^\x7f"
    return "".join(f"%{ord(c):02X}" if c in special or c < " " else c for c in name)


@dataclass(frozen=True)
class CellTable:
    """Datasets held in any table with a content id column."""

    cells: DataFrame
    cid_column: str = CID
    dims: tuple[str, ...] | None = None

    def open(self, cid: str) -> OpenedCells:
        return OpenedCells(self.read(cid), self.dims)

    def read(self, cid: str) -> DataFrame:
        return self.cells.where(F.col(self.cid_column) == cid_required(cid)).drop(self.cid_column)

    def table(self, cids: DataFrame | None = None, bounds: Bounds | None = None) -> DataFrame:
        return self.cells.withColumnRenamed(self.cid_column, CID)  # the predicates of its reader prune it

    def axis_table(self, dim: str) -> DataFrame:
        return self.table().select(CID, dim)


def read_cells(spark: SparkSession, root: str, cid: str) -> DataFrame:
    return CellStore(spark, root).read(cid)
