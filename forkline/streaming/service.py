"""The whole service: settings, a source that reconnects, the store, handlers, metrics, backfill and the read API."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import backfill as bf
from ..operators.handlers import Registry
from ..sources import rpc, script
from ..sources.config import Config, source_mode
from . import engine
from .metrics import Metrics
from .store import Store


class SourceFailed(Exception):
    """A source that can't go on, or not after so many attempts."""


def run_resumed(connect: Callable[[int], StreamingQuery], last_seen: Callable[[], int | None], attempts: int = 10, first_wait: float = 0.5, longest_wait: float = 30.0, resumable: bool = True, sleep: Callable[[float], None] = time.sleep) -> int:
    """Run a stream until its source is exhausted; how often it was connected again.

    connect(sequence) starts a query that goes on after that sequence. A failure waits, with waits that double, and resumes
    after the last committed sequence, so that a reconnection opens no gap. A commit in between starts the
    count of attempts and the waits anew; too many failures in a row, or a source that can't resume, raise SourceFailed.
    """
    failed, wait, again, seen = 0, first_wait, 0, last_seen() or 0
    while True:
        try:
            connect(seen).awaitTermination()
            return again
        except Exception as e:
            now = last_seen() or 0
            if now > seen:
                failed, wait, seen = 0, first_wait, now
            failed += 1
            if not resumable or failed > attempts:
                raise SourceFailed(f"gave up after {failed} failures: {e}") from e
            sleep(wait)
            wait, again = min(longest_wait, 2 * wait), again + 1


@dataclass
class BackfillStatus:
    """Where a backfill is, and what it has done."""

    state: str = "idle"
    slots_examined: int = 0
    slots_skipped_present: int = 0
    slots_skipped_empty: int = 0
    slots_fetched: int = 0
    events_emitted: int = 0
    current_slot: int | None = None
    target_slot: int | None = None

    def progress(self) -> float:
        """Share of the target reached, 0 without one."""
        return min(1.0, (self.current_slot or 0) / self.target_slot) if self.target_slot else 0.0


def run_backfill(store: Store, make_client: Callable[[], rpc.RpcClient], ranges: list[tuple[int, int, bool]], batch_slots: int = 100, delay: float = 0.0, skip_present: bool = True, status: BackfillStatus | None = None, sleep: Callable[[float], None] = time.sleep, **settings) -> BackfillStatus:
    """Fetch ranges (first, last, is_gap_fill), gap fills first, batch_slots slots at a time; executors fetch the blocks, and each batch is one commit.

    An inverted range or a failing service ends the run as `failed` and raises.
    """
    status = status or BackfillStatus()
    status.state, client, spark = "running", make_client(), store.spark
    try:
        for first, last, _ in sorted(ranges, key=lambda r: (bf.GAP_FILL if r[2] else bf.NORMAL, r[0])):
            if first > last:
                raise ValueError(f"the range {first} to {last} is inverted")
            status.target_slot = last
            for lo in range(first, last + 1, batch_slots):
                hi = min(last, lo + batch_slots - 1)
                slots = spark.createDataFrame([(s,) for s in client.slots_with_blocks(lo, hi)], "slot long")
                status.slots_examined += hi - lo + 1
                wanted = slots
                if skip_present:
                    present = store.events().where(F.col("slot").between(lo, hi) & F.col("is_valid")).select("slot").distinct()
                    wanted = slots.join(present, "slot", "left_anti")
                asked = [r[0] for r in wanted.collect()]  # at most batch_slots
                status.slots_skipped_present += slots.count() - len(asked)
                if asked:
                    commit = store.last()["commit"] + 1
                    blocks = store.write(rpc.fetch_blocks(spark, make_client, spark.createDataFrame([(s,) for s in asked], "slot long")), "_work_blocks", commit)
                    got = blocks.count()
                    raw = bf.to_raw(bf.explode_blocks(blocks), store.last()["next_arrival"])
                    n = raw.count()
                    if n:
                        engine.ingest(store, raw, **settings)
                    status.slots_fetched += got
                    status.slots_skipped_empty += len(asked) - got
                    status.events_emitted += n
                status.current_slot = hi
                if delay and hi < last:
                    sleep(delay)
    except Exception:
        status.state = "failed"
        raise
    status.state = "completed"
    return status


@dataclass
class Service:
    """What a deployment runs: made from settings, it ingests from its source, fills gaps, and answers reads from the store."""

    spark: SparkSession
    config: Config
    handlers: Registry | None = None
    metrics: Metrics = field(default_factory=Metrics)
    env: Mapping[str, str] | None = None

    def __post_init__(self) -> None:
        if not self.config.store_path:
            raise ValueError("store_path has to be set")
        self.store = Store(self.spark, self.config.store_path)

    @property
    def settings(self) -> dict:
        c = self.config
        return {"max_slots": c.chain_tracker_max_slots, "max_depth": c.max_rollback_depth, "metrics": self.metrics, "handlers": self.handlers, "max_retries": c.dlq_max_retries}

    def run(self, connect: Callable[[int], DataFrame] | None = None, checkpoint: str | None = None, sleep: Callable[[float], None] = time.sleep) -> int:
        """Ingest until the source is exhausted; how often it was connected again.

        In the scripted mode the chain of the environment's sizes is ingested in batches of batch_size events. Otherwise
        connect(sequence) gives a streaming DataFrame of raw events after a sequence, or archive_path is read as a folder of Parquet files.
        """
        if source_mode(self.env) == "scripted":
            events, size = script.from_env(self.env).events(self.spark), self.config.batch_size
            last = events.agg(F.max("arrival")).first()[0] or 0
            for batch, lo in enumerate(range(1, last + 1, size)):
                engine.ingest(self.store, events.where(F.col("arrival").between(lo, lo + size - 1)), batch, **self.settings)
            return 0
        folder = checkpoint or f"{self.config.store_path}/_checkpoint"

        def start(sequence: int) -> StreamingQuery:
            source = connect(sequence) if connect else engine.file_source(self.spark, self.config.archive_path, self.config.max_files_per_trigger)
            return engine.start(self.store, source, folder, **self.settings)

        c = self.config
        return run_resumed(start, lambda: self.store.last()["last_seen"], c.max_reconnect_attempts, c.first_wait_ms / 1000, c.longest_wait_ms / 1000, sleep=sleep)

    def backfill(self, make_client: Callable[[], rpc.RpcClient], ranges: list[tuple[int, int, bool]], **options) -> BackfillStatus:
        return run_backfill(self.store, make_client, ranges, self.config.backfill_batch_size, **options, **self.settings)

    def events(self) -> DataFrame:
        return self.store.events()
