"""Micro-batches, restarts, replays, backfills and the commit point."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forkline.operators import backfill as bf
from forkline.operators import dlq, engine, reads
from forkline.schemas import BLOCK
from forkline.sources.script import ChainScript
from forkline.streaming import engine as st
from forkline.streaming.store import Store

S = ChainScript


def write_parts(events, path: str, size: int) -> None:
    n = events.agg(F.max("arrival")).first()[0]
    for lo in range(1, n + 1, size):
        events.where(f"arrival >= {lo} and arrival < {lo + size}").coalesce(1).write.mode("append").parquet(path)


def visible(events):
    return sorted(map(tuple, events.where("is_valid").select("slot", "source_seq", "seq", "kind", "data").collect()))


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    events = S().extend(1, 20, 3).fork(21, 15, 5, 3).events(spark)
    store = Store(spark, f"file://{tmp_path}/store")
    write_parts(events.where("arrival <= 40"), f"{tmp_path}/in", 25)
    for part in (None, "arrival > 40"):
        if part:
            write_parts(events.where(part).withColumn("arrival", F.col("arrival") - 40), f"{tmp_path}/in", 40)
        st.start(store, st.file_source(spark, f"{tmp_path}/in", 1), f"{tmp_path}/cp").awaitTermination()
    batch = engine.index(events)
    assert visible(store.events()) == visible(batch.events)
    counts = reads.event_counts(store.events()).first()
    assert (counts["valid"], counts["invalid"]) == (60, 15)
    assert store.last()["cursor"] == {"slot": 25, "seq": 75, "source_seq": 75}
    store.compact()
    store.vacuum()
    assert len(store.manifests()) == 1 and visible(store.events()) == visible(batch.events)


def test_a_batch_is_committed_once_and_a_finished_stream_is_absorbed(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    events = S().extend(700, 6, 2).fork(706, 702, 3, 2).events(spark)
    assert st.ingest(store, events, 0)
    before = visible(store.events())
    assert not st.ingest(store, events, 0)
    assert st.ingest(store, events, 1)  # the source starts over: every number is known
    assert visible(store.events()) == before and store.table("reorg_log").count() == 1


def test_a_crash_before_the_manifest_leaves_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/store")
    events = S().extend(1, 4, 2).events(spark)
    st.ingest(store, events.where("arrival <= 4"), 0)
    before = visible(store.events())
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(store, "publish", lambda manifest: (_ for _ in ()).throw(RuntimeError("killed")))
        st.ingest(store, events.where("arrival > 4"), 1)
    assert visible(store.events()) == before
    assert st.ingest(store, events.where("arrival > 4"), 1)
    assert len(visible(store.events())) == 8


def test_dead_letters_are_kept_replayed_and_made_anew(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    raw = S().extend(1, 4, 2).events(spark)
    st.ingest(store, raw.withColumn("payload", F.when(F.col("slot") == 3, F.lit("{ bad").cast("binary")).otherwise(F.col("payload"))), 0)
    assert len(visible(store.events())) == 6
    entries = dlq.state(store.table("dlq_log"))
    assert {(r["status"], r["error_category"]) for r in entries.collect()} == {("Pending", "malformed")}
    assert st.replay_letters(store, dlq.unresolved(entries)) == 2
    after = dlq.state(store.table("dlq_log")).groupBy("status").count().collect()
    assert {r[0]: r[1] for r in after} == {"Resolved": 2, "Pending": 2}


def test_backfill_fills_a_gap_once_without_forks(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    live = S().extend(1, 10, 1).events(spark).where("slot not in (6, 7, 8)")
    st.ingest(store, live, 0)
    tx = lambda s: [{"transaction": {"signatures": [f"s{s}"], "message": '{"k": 1}'}, "meta": {"err": None, "fee": None, "computeUnitsConsumed": 5}}]
    blocks = spark.createDataFrame([{"slot": s, "parentSlot": s - 1, "blockhash": "h", "blockTime": s, "transactions": tx(s)} for s in (6, 7, 8)], BLOCK)
    ranges = bf.ranges(spark, [(1, 10, False)])
    assert st.backfill(store, blocks, ranges) == 3
    assert sorted({r[0] for r in visible(store.events())}) == list(range(1, 11))
    assert store.table("reorg_log").count() == 0
    assert store.last()["cursor"]["source_seq"] == 10  # numbers of backfilled events don't move the live position
    assert st.backfill(store, blocks, ranges) == 0
