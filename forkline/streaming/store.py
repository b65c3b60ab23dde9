"""Append-only logs of Parquet folders, made visible together by a manifest that is renamed into place."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dlq, fold
from ..schemas import TABLES


class Store:
    """commit() writes a batch's tables and then its manifest; readers join what manifests name, so a batch is seen whole or not at all.

    A manifest also holds the position and the tracker's state after its batch: data, cursor and chain have one commit point.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ---- files, through Hadoop's file systems

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self._conf)

    def _read(self, path) -> str:
        stream = self._fs().open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def manifests(self) -> list[dict]:
        """Published commits in order, from the last compaction on."""
        folder = self._path("manifests")
        if not self._fs().exists(folder):
            return []
        names = sorted(s.getPath().getName() for s in self._fs().listStatus(folder) if s.getPath().getName().endswith(".json"))
        out = [json.loads(self._read(self._path(f"manifests/{n}"))) for n in names]
        base = max((i for i, m in enumerate(out) if m.get("compacted")), default=0)
        return out[base:]

    def last(self) -> dict:
        found = self.manifests()
        return found[-1] if found else {"commit": 0, "last_batch": -1, "last_seen": None, "next_seq": 1, "next_arrival": 1, "tracker": None, "cursor": None}

    def publish(self, manifest: dict) -> None:
        """Write beside, then rename: the commit point."""
        name = f"{manifest['commit']:020d}.json"
        beside = self._path(f"manifests/_{name}")
        out = self._fs().create(beside, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._fs().rename(beside, self._path(f"manifests/{name}")):
            raise RuntimeError(f"manifest {name} exists already: another writer is at work")

    # ---- tables

    def write(self, df: DataFrame, table: str, commit: int) -> DataFrame:
        """Write a table's part of a commit; what a failed attempt left is replaced."""
        path = f"{self.root}/{table}/commit={commit:020d}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, name: str) -> DataFrame:
        """All published rows of a log."""
        paths = [f"{self.root}/{name}/commit={m['commit']:020d}" for m in self.manifests() if name in m["tables"]]
        schema = TABLES[name]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def events(self, legacy: bool = False) -> DataFrame:
        return fold.events_current(self.table("event_log"), self.table("action_log"), legacy)

    def slots(self) -> DataFrame:
        return fold.slots_current(self.table("slot_log"), self.table("action_log"))

    def compact(self) -> None:
        """Rewrite each log as one commit, so that readers list few folders. Old folders stay for readers that still use them."""
        last = self.last()
        if not last["commit"]:
            return
        commit = last["commit"] + 1
        for name, schema in TABLES.items():
            order = "slot" if "slot" in schema.names else "ord"
            self.write(self.table(name).sortWithinPartitions(order), name, commit)
        self.publish({**last, "commit": commit, "compacted": True, "tables": list(TABLES)})

    def vacuum(self) -> None:
        """Delete folders that no current manifest names."""
        current = {m["commit"] for m in self.manifests()}
        for name in TABLES:
            folder = self._path(name)
            if self._fs().exists(folder):
                for s in self._fs().listStatus(folder):
                    if int(s.getPath().getName().removeprefix("commit=")) not in current:
                        self._fs().delete(s.getPath(), True)

    def cursors(self) -> DataFrame:
        return fold.cursor_current(self.table("cursor_log"))

    def letters(self) -> DataFrame:
        return dlq.state(self.table("dlq_log"))

    def register_views(self, prefix: str = "") -> None:
        """Make the current tables and the logs known to SQL."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(prefix + name)
        for name, df in (("events_current", self.events()), ("slots_current", self.slots()), ("cursors", self.cursors()), ("dead_letters", self.letters())):
            df.createOrReplaceTempView(prefix + name)

    # ---- maintenance: each is a commit of its own that changes no position

    def _repair(self, tables: dict[str, DataFrame], compacted: bool = False) -> None:
        last = self.last()
        commit = last["commit"] + 1
        for name, df in tables.items():
            self.write(df, name, commit)
        self.publish({**{k: v for k, v in last.items() if k != "compacted"}, "commit": commit, "tables": list(tables), **({"compacted": True} if compacted else {})})

    def delete_cursor(self, name: str) -> None:
        at = self.last()["next_arrival"] * 4
        self._repair({"cursor_log": self.spark.createDataFrame([(name, None, None, None, None, None, at)], TABLES["cursor_log"])})

    def purge_invalid(self, before_slot: int) -> int:
        """Drop rows that are invalid and below a slot from the event log; how many identities went. All logs are rewritten as one commit."""
        gone = self.events().where((F.col("slot") < before_slot) & ~F.col("is_valid")).select("slot", "source_seq")
        n = gone.count()
        if n:
            tables = {name: self.table(name) for name in TABLES}
            tables["event_log"] = tables["event_log"].join(gone, ["slot", "source_seq"], "left_anti").select(*TABLES["event_log"].names)
            self._repair(tables, compacted=True)
        return n

    def purge_letters(self, days: int, now: Column | None = None) -> int:
        """Drop dead letters that were resolved more than `days` days ago; how many went."""
        entries = self.letters()
        stay = dlq.purged(entries, days, now if now is not None else F.current_timestamp()).select("id")
        n = entries.count() - stay.count()
        if n:
            tables = {name: self.table(name) for name in TABLES}
            tables["dlq_log"] = tables["dlq_log"].join(stay, "id", "left_semi").select(*TABLES["dlq_log"].names)
            self._repair(tables, compacted=True)
        return n
