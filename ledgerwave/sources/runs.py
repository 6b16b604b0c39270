"""Several tables of one run, seen together or not at all.

A run writes its slices aside. Once all are there, ``commit`` lists them, sets one
mark and moves them into their places. A run that stops before its mark leaves
nothing behind it in the tables; one that stops after it is finished by the next
``finish_runs``, which every reader of the lake may call first. One run writes
to a lake at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerwave.session import drop_shuffles

RUNS, SLICES, MARK = "_runs", "slices", "committed"
SLICE = "table_name string, by string, value string, filled boolean"


class Files:
    """The few calls to the folder tree that runs need, on any file system."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(conf)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def matching(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self._path(pattern)) or []
        return sorted(s.getPath().getName() for s in found)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def move(self, source: str, target: str) -> None:
        """Put a folder in the place of another."""
        parent = self._path(target).getParent()
        self._fs.mkdirs(parent)
        self.delete(target)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")


class Run:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.path = f"{root}/{RUNS}/{uuid.uuid4().hex}"
        self.slices: list[tuple[str, str, str, bool]] = []

    def stage(self, df: DataFrame, table: str, by: str, values: Iterable) -> None:
        """Write the slices of ``df``, one per value of ``by``. ``values`` are all
        slices that this run replaces; those without rows will be emptied."""
        target = f"{self.path}/{table}"
        df.hint("rebalance", F.col(by)).write.partitionBy(by).option("compression", "zstd").parquet(target)
        drop_shuffles(self.spark)
        there = set(Files(self.spark, self.root).children(target))
        for value in values:
            self.slices.append((table, by, str(value), f"{by}={value}" in there))

    def staged(self, table: str, schema: StructType) -> DataFrame | None:
        """The slices of a table as this run has written them, if it has."""
        mine = [s for s in self.slices if s[0] == table]
        if not mine:
            return None
        if not any(filled for *_, filled in mine):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    def mark(self) -> None:
        """From here on the run counts."""
        self.spark.createDataFrame(self.slices, SLICE).coalesce(1).write.json(f"{self.path}/{SLICES}")
        Files(self.spark, self.root).touch(f"{self.path}/{MARK}")

    def commit(self) -> None:
        if self.slices:
            self.mark()
            finish_runs(self.spark, self.root)


def finish_runs(spark: SparkSession, root: str) -> None:
    """Move the slices of marked runs into place and drop what has no mark.

    May be repeated: a slice that is no longer aside has been moved already, and
    a slice listed as empty is deleted again.
    """
    files = Files(spark, root)
    for name in files.children(f"{root}/{RUNS}"):
        run = f"{root}/{RUNS}/{name}"
        if files.exists(f"{run}/{MARK}"):
            # One row per table and year of the run.
            for s in spark.read.schema(SLICE).json(f"{run}/{SLICES}").collect():
                part = f"{s.table_name}/{s.by}={s.value}"
                if not s.filled:
                    files.delete(f"{root}/{part}")
                elif files.exists(f"{run}/{part}"):
                    files.move(f"{run}/{part}", f"{root}/{part}")
        files.delete(run)
