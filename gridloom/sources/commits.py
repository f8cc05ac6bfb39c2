"""The order of writes: one numbered file for each, and each number taken once.

A write prepares its files under a token of its own, which nobody reads, and becomes visible when
the file of the next number is created with that token. Creating it succeeds for one writer only, so
the order needs no clock. A folder like HDFS, whose rename refuses a name that is taken, or a local
one is needed.
"""

from __future__ import annotations

import json
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TOKEN = "token"
_COMMIT = "number LONG, token STRING, mode STRING"


class Folder:
    """The few file operations that a store needs, on the file system that Spark uses."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path
        self._jvm = spark._jvm
        self._fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> dict[str, float]:
        """Names in a folder and the seconds of their last change; none if it is not there."""
        if not self._fs.exists(self._at(name)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self._fs.listStatus(self._at(name))}

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def create_once(self, name: str, text: str, token: str) -> bool:
        """Whether this call has made the file, whole; False if it is there already."""
        self._fs.mkdirs(self._at())
        draft = f"_{token}"  # hidden from readers
        out = self._fs.create(self._at(draft), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            uri = self._fs.makeQualified(self._at()).toUri()
            if uri.getScheme() != "file":
                return bool(self._fs.rename(self._at(draft), self._at(name)))
            here = uri.getPath()  # a local rename would replace the file, a link does not
            try:
                os.link(f"{here}/{draft}", f"{here}/{name}")
            except FileExistsError:
                return False
            return True
        finally:
            self._fs.delete(self._at(draft), False)


class CommitLog:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.path = spark, f"{root}/commits"
        self.folder = Folder(spark, self.path)

    def numbers(self) -> dict[int, float]:
        """Numbers taken, and when by the clock of the file system (for age only, never for order)."""
        names = self.folder.names()
        return {int(n.removesuffix(".json")): at for n, at in names.items() if n.endswith(".json") and n[0] != "_"}

    def head(self) -> int:
        return max(self.numbers(), default=0)

    def entries(self) -> DataFrame:
        """One row per commit: ``number``, ``token`` and ``mode``."""
        try:
            return self.spark.read.schema(_COMMIT).json(self.path)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing.getCondition()):
                raise
            return self.spark.createDataFrame([], _COMMIT)

    def append(self, number: int, token: str, mode: str) -> bool:
        text = json.dumps({"number": number, "token": token, "mode": mode})
        return self.folder.create_once(f"{number:020d}.json", text, token)

    def drop(self, number: int) -> None:
        self.folder.delete(f"{number:020d}.json")
