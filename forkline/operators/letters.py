"""Stores of dead letters: one set of operations over any place that can read a log and append to it."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DLQ_LOG
from . import dlq


class Letters(ABC):
    """A backend gives log() and append(); the rest is the same for all. The last row of an id is its state."""

    @abstractmethod
    def log(self) -> DataFrame:
        """All rows, with the columns of DLQ_LOG."""

    @abstractmethod
    def append(self, rows: DataFrame) -> None:
        """Add rows, which are all seen from then on or not at all."""

    @abstractmethod
    def replace(self, rows: DataFrame) -> None:
        """Put rows in the place of the whole log."""

    def entries(self) -> DataFrame:
        return dlq.state(self.log())

    def insert(self, rows: DataFrame) -> None:
        self.append(rows.select(*DLQ_LOG.names))

    update = insert

    def get(self, id: str) -> DataFrame:
        return self.entries().where(F.col("id") == id)

    def unresolved(self, limit: int | None = None) -> DataFrame:
        return dlq.unresolved(self.entries(), limit)

    def by_category(self, category: str, limit: int | None = None) -> DataFrame:
        return dlq.by_category(self.entries(), category, limit)

    def resolve(self, ids: list[str], at: Column) -> None:
        """Mark entries as resolved; unknown ids change nothing."""
        log = self.log()
        rows = dlq.state(log).where(F.col("id").isin(ids)).withColumns({"is_resolved": F.lit(True), "resolved_at": at})
        last = log.groupBy("id").agg((F.max("ord") + 1).alias("ord"))
        self.append(rows.join(last, "id").select(*DLQ_LOG.names))

    def purge(self, days: int, now: Column) -> int:
        """Delete entries that were resolved more than so many days ago; how many went."""
        log, entries = self.log(), self.entries()
        kept = dlq.purged(entries, days, now).select("id")
        gone = entries.count() - kept.count()
        if gone:
            self.replace(log.join(kept, "id", "left_semi").select(*DLQ_LOG.names))
        return gone


class MemoryLetters(Letters):
    """Rows of this session, for tests and small tools: each change is held as a DataFrame of its own."""

    def __init__(self, spark: SparkSession):
        self.parts = [spark.createDataFrame([], DLQ_LOG)]

    def log(self) -> DataFrame:
        out = self.parts[0]
        for part in self.parts[1:]:
            out = out.unionByName(part)
        return out

    def append(self, rows: DataFrame) -> None:
        self.parts.append(rows)

    def replace(self, rows: DataFrame) -> None:
        self.parts = [rows]


class FolderLetters(Letters):
    """A folder of Parquet folders, one a change; the highest replacement hides what came before it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm

    def _names(self) -> list[str]:
        path = self._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = lambda x: fs.exists(self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{x}/_SUCCESS"))
        names = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path)) if done(n))
        base = max((i for i, n in enumerate(names) if n.endswith("-all")), default=0)
        return names[base:]

    def _put(self, rows: DataFrame, kind: str) -> None:
        names = self._names()
        n = int(names[-1].split("-")[0]) + 1 if names else 0
        rows.write.parquet(f"{self.path}/{n:012d}-{kind}")

    def log(self) -> DataFrame:
        names = self._names()
        return self.spark.read.schema(DLQ_LOG).parquet(*(f"{self.path}/{n}" for n in names)) if names else self.spark.createDataFrame([], DLQ_LOG)

    def append(self, rows: DataFrame) -> None:
        self._put(rows, "more")

    def replace(self, rows: DataFrame) -> None:
        self._put(rows, "all")
