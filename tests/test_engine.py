"""Scripted chains through the batch engine, against the ancestry of the last slot and known counts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forkline.operators import engine, fold, reads
from forkline.sources.script import ChainScript

S = ChainScript
#: name: script, valid rows, invalid rows, reorgs as (fork slot, divergence, depth, rows invalidated).
SCRIPTS = {
    "straight": (S().extend(100, 20, 3), 60, 0, []),
    "depth1": (S().extend(100, 20, 3).fork(120, 118, 4, 3), 69, 3, [(120, 118, 1, 3)]),
    "depth5": (S().extend(100, 20, 3).fork(120, 114, 8, 3), 69, 15, [(120, 114, 5, 15)]),
    "depth32": (S().extend(100, 52, 3).fork(152, 119, 10, 3), 90, 96, [(152, 119, 32, 96)]),
    "mechanism": (S().extend(100, 52, 3).fork(152, 119, 6, 3), 78, 96, [(152, 119, 32, 96)]),
    "competing": (S().extend(100, 10, 2).fork(110, 104, 4, 2).fork(120, 106, 4, 2).fork(130, 102, 5, 2), 16, 30, [(110, 104, 5, 10), (120, 104, 4, 8), (130, 102, 8, 16)]),
    "gap": (S().extend(100, 5, 2).fork(200, 150, 3, 2), 16, 0, []),
    "reapply": (S().extend(100, 8, 2).fork(110, 103, 2, 2).fork(104, 103, 4, 2), 16, 12, [(110, 103, 4, 8), (104, 103, 2, 4)]),
    "unknown": (S().fork(100, 99, 1, 1).fork(103, 100, 1, 1).fork(104, 103, 1, 1).fork(105, 102, 1, 1), 2, 2, [(105, 102, 2, 2)]),
    "restored_copy": (S().extend(100, 8, 2).fork(110, 103, 2, 2).fork(104, 103, 4, 2).fork(120, 103, 2, 2).fork(130, 107, 1, 2), 18, 16, [(110, 103, 4, 8), (104, 103, 2, 4), (120, 103, 4, 8), (130, 103, 2, 4)]),
}
six = S().extend(1000, 15, 2)
for k in range(6):
    six.fork(1015 + 10 * k, 1001 + 2 * k, 4, 2)
SCRIPTS["six"] = (six, 32, 46, None)


@pytest.mark.parametrize("name", sorted(SCRIPTS))
def test_end_state(spark, name):
    made, valid, invalid, reorgs = SCRIPTS[name]
    x = engine.index(made.events(spark))
    counts = reads.event_counts(x.events).first()
    assert (counts["valid"], counts["invalid"]) == (valid, invalid)
    if reorgs is not None:
        assert [tuple(r) for r in x.audit.orderBy("ord").select("fork_slot", "divergence_point", "depth", "events_invalidated").collect()] == reorgs


@pytest.mark.parametrize("name", ["depth5", "competing", "reapply", "restored_copy", "six"])
def test_readers_see_a_replay_of_the_canonical_chain(spark, name):
    made = SCRIPTS[name][0]
    x = engine.index(made.events(spark))
    seen = {r[0] for r in x.events.where("is_valid").select("slot").distinct().collect()}
    assert seen == made.canonical()
    assert {r[0] for r in reads.canonical_slots(x.slots).select("slot").collect()} == made.canonical()


def test_legacy_restore_brings_back_older_copies(spark):
    x = engine.index(SCRIPTS["restored_copy"][0].events(spark), legacy=True)
    c = reads.event_counts(x.events).first()
    assert (c["valid"], c["invalid"]) == (26, 8)


def test_narrow_buckets_change_nothing(spark):
    made = SCRIPTS["competing"][0]
    a, b = (engine.index(made.events(spark), width=w).events.orderBy("slot", "source_seq").collect() for w in (3, 65_536))
    assert a == b


def test_redelivery_keeps_the_number_and_revives(spark):
    x = engine.index(SCRIPTS["depth1"][0].events(spark))
    again = x.event_log.where("slot = 119").withColumns({"seq": F.lit(999).cast("long"), "data": F.lit("{}"), "ord": F.col("ord") + 10_000})
    rows = fold.events_current(x.event_log.unionByName(again), x.actions).where("slot = 119").collect()
    assert len(rows) == 3 and all(r["is_valid"] and r["invalidated_at"] is None and r["seq"] < 999 and r["data"] == "{}" for r in rows)


def test_events_without_parent_are_written_without_a_slot(spark):
    raw = S().extend(1, 3, 1).events(spark).withColumn("parent_slot", F.lit(None).cast("long"))
    x = engine.index(raw)
    assert x.events.count() == 3 and x.slots.count() == 0 and x.decisions.count() == 0


def test_empty_input(spark):
    x = engine.index(S().extend(1, 1, 1).events(spark).where("false"))
    assert x.events.count() == 0 and x.audit.count() == 0 and reads.event_counts(x.events).first()["max_seq"] == 0


def test_a_slot_of_malformed_events_is_never_seen(spark):
    raw = S().extend(1, 4, 2).events(spark)
    raw = raw.withColumn("payload", F.when(F.col("slot") == 3, F.lit("{ this is not json").cast("binary")).otherwise(F.col("payload")))
    x = engine.index(raw, check_json=True)
    assert x.events.count() == 6 and x.bad.count() == 2
    assert [r["outcome"] for r in x.decisions.orderBy("arrival").collect()] == ["initialised", "extended", "gap_join"]


def test_slot_predicates_reach_the_scan(spark, tmp_path):
    x = engine.index(SCRIPTS["depth5"][0].events(spark))
    x.event_log.write.parquet(f"{tmp_path}/e")
    x.actions.write.parquet(f"{tmp_path}/a")
    events = fold.events_current(spark.read.parquet(f"{tmp_path}/e"), spark.read.parquet(f"{tmp_path}/a"))
    plan = reads.list_events(events, reads.EventQuery(slot=105))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(slot,105)" in plan and "TakeOrderedAndProject" in plan


def test_a_refused_slot_is_written_when_it_is_accepted_later(spark):
    """Slot 120 is refused while its rollback is too deep, and accepted when the chain has fallen back."""
    made = S().extend(100, 10, 1).fork(120, 103, 1, 2).fork(110, 106, 1, 1).fork(120, 103, 1, 2)
    x = engine.index(made.events(spark), max_depth=5)
    assert [r["outcome"] for r in x.decisions.orderBy("arrival").collect()][-3:] == ["depth_refusal", "reorg", "reorg"]
    rows = x.events.where("slot = 120").orderBy("source_seq").collect()
    assert [r["source_seq"] for r in rows] == [14, 15] and all(r["is_valid"] for r in rows)
    old = engine.index(made.events(spark), max_depth=5, legacy=True)
    assert old.events.where("slot = 120").count() == 3  # the refused run's second event counted as a duplicate and was written
