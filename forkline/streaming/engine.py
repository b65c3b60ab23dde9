"""The streaming pipeline: micro-batches through the batch engine, with one atomic commit each."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import chain, dlq, engine
from ..operators.handlers import Registry, kind_counts
from ..operators.prefix import numbered
from ..schemas import ACTION_LOG, CURSOR_LOG, DLQ_LOG, EVENT_LOG, RAW, REORG_LOG, SLOT_LOG
from .metrics import Metrics
from .store import Store

CURSOR = "main"


def ingest(store: Store, raw: DataFrame, batch: int | None = None, extra_dlq: DataFrame | None = None, max_slots: int = chain.MAX_SLOTS, max_depth: int = chain.MAX_DEPTH, metrics: Metrics | None = None, handlers: Registry | None = None, max_retries: int = dlq.MAX_RETRIES) -> bool:
    """Commit one batch of raw events; False where this batch of the stream is committed already.

    Repairs (replays and backfills) are batches without a number. extra_dlq are log rows to commit together with the events.
    What a handler rejects becomes a dead letter of category validation, in the same commit. A failure leaves no manifest, so the next attempt starts from the same state.
    """
    before = store.last()
    if batch is not None and batch <= before["last_batch"]:
        return False
    commit = before["commit"] + 1
    start = before["next_arrival"]
    ordered = numbered(raw.select(*RAW.names), "arrival", "__n", start).withColumn("arrival", F.col("__n")).drop("__n")
    ordered = store.write(ordered, "_work_raw", commit)
    run = engine.index(ordered, check_json=True, last_seen=before["last_seen"], first_seq=before["next_seq"], max_slots=max_slots, max_depth=max_depth, state=before["tracker"], keep=lambda df, name: store.write(df, f"_work_{name}", commit), with_state=True, handlers=handlers)
    cast = lambda df, schema: df.select(*(F.col(f.name).cast(f.dataType) for f in schema))
    events = store.write(cast(run.event_log, EVENT_LOG), "event_log", commit)
    store.write(cast(run.slot_log, SLOT_LOG), "slot_log", commit)
    reorgs = store.write(cast(run.reorgs, REORG_LOG), "reorg_log", commit)
    store.write(cast(run.actions, ACTION_LOG), "action_log", commit)
    letters = dlq.rejects(run.bad, max_retries=max_retries)
    if run.refused is not None:
        letters = letters.unionByName(dlq.rejects(run.refused, "EventValidation", "validation", max_retries))
    if extra_dlq is not None:
        letters = letters.unionByName(extra_dlq)
    kept = store.write(cast(letters, DLQ_LOG), "dlq_log", commit)
    top = events.agg(F.max("slot"), F.max("seq")).first()
    live = run.accepted.where("origin = 'live'").agg(F.max("source_seq")).first()[0]
    count = ordered.agg(F.max("arrival")).first()[0]
    state = run.decisions.where(F.col("outcome") == chain.STATE).select("tracker").first()
    seen = max((x for x in (live, before["last_seen"]) if x is not None), default=None)
    cursor = {"slot": max(top[0] or 0, (before["cursor"] or {}).get("slot", 0)), "seq": max(top[1] or 0, before["next_seq"] - 1), "source_seq": seen}
    rows = store.spark.createDataFrame([(CURSOR, cursor["slot"], cursor["seq"], seen, None, None, start * chain.STEPS)], CURSOR_LOG)
    store.write(rows, "cursor_log", commit)
    manifest = {
        "commit": commit,
        "last_batch": before["last_batch"] if batch is None else batch,
        "last_seen": seen,
        "next_seq": cursor["seq"] + 1,
        "next_arrival": (count or start - 1) + 1,
        "tracker": state[0] if state else before["tracker"],
        "cursor": cursor,
        "tables": ["event_log", "slot_log", "reorg_log", "action_log", "dlq_log", "cursor_log"],
    }
    store.publish(manifest)
    if metrics is not None:
        by_depth = reorgs.groupBy("depth").count().collect()  # at most one row per depth, which is bounded
        kinds = {r["kind"]: r["events"] for r in kind_counts(events).collect()}  # at most one row per kind
        metrics.committed(manifest, {r["depth"]: r["count"] for r in by_depth}, kept.count(), kinds)
    for name in ("raw", "accepted", "good", "decisions", "numbered"):
        store._fs().delete(store._path(f"_work_{name}/commit={commit:020d}"), True)
    return True


def start(store: Store, source: DataFrame, checkpoint: str, available_now: bool = True, every: str = "1 second", **settings) -> StreamingQuery:
    """Run a streaming DataFrame of raw events into a store.

    Delivery again after a failure is absorbed by the batch number; the source's rate limits are the back pressure.
    """

    def one(df: DataFrame, batch: int) -> None:
        ingest(store, df, batch, **settings)

    writer = source.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


def file_source(spark: SparkSession, path: str, max_files: int = 16) -> DataFrame:
    """Raw events from Parquet files; the limit of files a batch bounds how far ingestion runs ahead (the block policy)."""
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", max_files).parquet(path)


def replay_letters(store: Store, chosen: DataFrame, at=None, each: int | None = None, delay: float = 0.0, fail_fast: bool = False, sleep: Callable[[float], None] = time.sleep, **settings) -> int:
    """Send chosen dead letters through the pipeline again and resolve them in the same commit; how many were sent.

    each: so many at a time, in order of failure, with a delay of so many seconds between; fail_fast ends after a part of which a letter failed again.
    """
    log = store.table("dlq_log")
    sent, parts = 0, 1
    if each:
        chosen = store.write(numbered(chosen.withColumn("__o", F.unix_micros("failed_at")), "__o", "__n", 0), "_work_replay", store.last()["commit"] + 1)
        parts = -(-chosen.count() // each)
    for k in range(parts):
        part = chosen.where((F.col("__n") >= k * each) & (F.col("__n") < (k + 1) * each)) if each else chosen
        raw, rows = dlq.replay(log, part, store.last()["next_arrival"], at if at is not None else F.current_timestamp())
        n, before = raw.count(), store.last()["commit"]
        if n:
            ingest(store, raw, extra_dlq=rows, **settings)
            sent += n
            again = store.table("dlq_log").where(~F.col("is_resolved") & (F.col("ord") >= store.last()["next_arrival"] * 4 - n * 4) & (F.col("retry_count") == 0))
            if fail_fast and store.last()["commit"] > before and again.limit(1).count():
                break
        if delay and k + 1 < parts:
            sleep(delay)
    return sent


def backfill(store: Store, archive: DataFrame, ranges: DataFrame) -> int:
    """Fetch what the archive has for ranges and the store lacks; how many events were sent. A second run finds nothing to do."""
    from ..operators import backfill as bf

    blocks = bf.candidates(archive, ranges, store.events().where("is_valid"))
    raw = bf.to_raw(bf.explode_blocks(blocks), store.last()["next_arrival"])
    n = raw.count()
    if n:
        ingest(store, raw)
    return n
