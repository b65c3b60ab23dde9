"""Handlers in the pipeline, reconnection, the composed service, backfill runs, letter stores and sized chains."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from forkline.functions.base58 import encoded
from forkline.operators import dlq, engine
from forkline.operators.handlers import Handler, Registry, logging_handler
from forkline.operators.letters import FolderLetters, MemoryLetters
from forkline.sources import rpc, script
from forkline.sources.config import Config
from forkline.streaming import engine as st
from forkline.streaming import service
from forkline.streaming.store import Store

S = script.ChainScript


def no_third(k=3) -> Registry:
    return Registry([Handler("third", ("Transaction",), F.col("slot") % k != 0), logging_handler()])


def test_refused_events_are_not_logged_but_their_slots_count(spark):
    events = S().extend(1, 9, 2).fork(10, 7, 2, 2).events(spark)
    x = engine.index(events, handlers=no_third())
    assert {r[0] for r in x.event_log.select("slot").collect()} == {1, 2, 4, 5, 7, 8, 10, 11}
    assert x.refused.count() == 6 and x.slots.count() == 11
    assert [tuple(r) for r in x.reorgs.select("divergence_point", "depth").collect()] == [(7, 2)]
    assert x.event_log.agg(F.max("seq")).first()[0] == 22  # refused events spend a number


def test_the_envelope_keeps_the_last_of_repeated_keys_in_any_session(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    engine.index(S().extend(1, 2, 1).events(spark))
    row = spark.createDataFrame([("a", 1, 0, 1, '{"a":1,"a":2}')], "kind string, slot long, parent_slot long, source_seq long, p string").select(engine.envelope(F.col("p"))).first()
    assert json.loads(row[0])["body"] == {"a": 2}


def test_handlers_feed_the_letters_of_a_stream_and_replay_can_stop(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    metrics = service.Metrics()
    st.ingest(store, S().extend(1, 6, 1).events(spark), 0, handlers=no_third(), metrics=metrics)
    entries = dlq.state(store.table("dlq_log"))
    assert {(r["slot"], r["error_category"]) for r in entries.collect()} == {(3, "validation"), (6, "validation")}
    assert metrics.counters["processor.events.Transaction"] == 4 and metrics.counters["dlq.entries"] == 2
    waits = []
    assert st.replay_letters(store, dlq.unresolved(entries), each=1, delay=0.5, fail_fast=True, sleep=waits.append, handlers=no_third()) == 1
    assert waits == []
    left = dlq.unresolved(dlq.state(store.table("dlq_log")))
    assert st.replay_letters(store, left, each=1, delay=0.5, sleep=waits.append) == 2 and waits == [0.5]
    assert {r[0] for r in store.events().where("is_valid").select("slot").collect()} == set(range(1, 7))


class Broken:
    def __init__(self, error=None):
        self.error = error

    def awaitTermination(self):
        if self.error:
            raise self.error


def test_a_stream_reconnects_where_it_was_and_gives_up():
    waits, seen, asked = [], [0], []

    def connect(sequence):
        asked.append(sequence)
        if len(asked) == 3:
            seen[0] = 7
        return Broken(OSError("gone") if len(asked) < 5 else None)

    assert service.run_resumed(connect, lambda: seen[0], attempts=2, first_wait=1, longest_wait=1.5, sleep=waits.append) == 4
    assert asked == [0, 0, 0, 7, 7] and waits == [1, 1.5, 1, 1.5]
    waits.clear()
    with pytest.raises(service.SourceFailed):
        service.run_resumed(lambda s: Broken(OSError("gone")), lambda: None, attempts=2, sleep=waits.append)
    assert len(waits) == 2
    with pytest.raises(service.SourceFailed):
        service.run_resumed(lambda s: Broken(OSError("gone")), lambda: None, resumable=False, sleep=waits.append)
    assert len(waits) == 2


def test_the_service_runs_a_scripted_chain_of_the_environments_sizes(spark, tmp_path):
    env = {"FORKLINE_SOURCE": "scripted", "SCRIPT_SLOTS": "10", "SCRIPT_EVENTS_PER_SLOT": "2", "SCRIPT_REORG_DEPTH": "3"}
    s = service.Service(spark, Config(store_path=f"file://{tmp_path}/store", batch_size=11).validated(), env=env)
    assert s.run() == 0
    chain = script.from_env(env)
    assert {r[0] for r in s.events().where("is_valid").select("slot").collect()} == chain.canonical() == {*range(1, 8), *range(11, 16)}
    assert s.metrics.counters["processor.reorgs"] == 1
    assert len(script.from_env({}).steps) == 47 and len(script.from_env({"SCRIPT_SLOTS": "x", "SCRIPT_REORG_DEPTH": "0"}).steps) == 40
    with pytest.raises(ValueError):
        service.Service(spark, Config())


def answers(url, body):
    q = json.loads(body)
    if q["method"] == "getBlocks":
        return 200, json.dumps({"result": [s for s in range(q["params"][0], q["params"][1] + 1) if s != 4]})
    slot = q["params"][0]
    if slot == 5:
        return 200, json.dumps({"error": {"code": -32007, "message": "skipped"}})
    tx = {"transaction": {"signatures": [f"s{slot}"], "message": {"k": slot}}, "meta": None if slot == 6 else {"err": None, "fee": 3, "computeUnitsConsumed": 1}}
    return 200, json.dumps({"result": {"parentSlot": slot - 1, "blockhash": "h", "blockTime": slot, "transactions": [tx]}})


def test_a_backfill_runs_in_batches_and_tells_its_status(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    st.ingest(store, S().extend(1, 2, 1).events(spark), 0)
    make = lambda: rpc.RpcClient("x", post=answers)
    waits = []
    done = service.run_backfill(store, make, [(1, 7, False)], batch_slots=3, delay=0.1, sleep=waits.append)
    assert (done.state, done.slots_examined, done.slots_skipped_present, done.slots_skipped_empty, done.slots_fetched, done.events_emitted) == ("completed", 7, 2, 1, 3, 3)
    assert done.progress() == 1.0 and waits == [0.1, 0.1]
    assert {r[0] for r in store.events().where("is_valid").select("slot").collect()} == {1, 2, 3, 6, 7}
    status = service.BackfillStatus()
    with pytest.raises(ValueError):
        service.run_backfill(store, make, [(9, 3, True)], status=status)
    assert status.state == "failed"
    with pytest.raises(rpc.RpcError):
        rpc.RpcClient("x", post=lambda u, b: (200, "{}")).current_slot()


@pytest.mark.parametrize("kind", ["memory", "folder"])
def test_letter_stores_agree(spark, tmp_path, kind):
    store = MemoryLetters(spark) if kind == "memory" else FolderLetters(spark, f"file://{tmp_path}/letters")
    assert store.entries().count() == 0 and store.purge(1, F.current_timestamp()) == 0
    store.insert(dlq.rejects(S().extend(1, 3, 1).events(spark)))
    ids = {r["slot"]: r["id"] for r in store.entries().collect()}
    at = F.timestamp_seconds(F.lit(1_000_000))
    store.resolve([ids[2], "unknown"], at)
    assert [r["slot"] for r in store.unresolved().collect()] == [3, 1] and store.unresolved(1).count() == 1
    assert store.get(ids[2]).first()["status"] == "Resolved" and store.by_category("malformed").count() == 2
    assert store.purge(1, F.timestamp_seconds(F.lit(1_000_000 + 86_400 * 3))) == 1
    assert store.entries().count() == 2 and store.get(ids[2]).count() == 0


def test_base58_known_answers(spark):
    known = {bytes(32): "1" * 32, bytes(31) + b"\x01": "1" * 31 + "2", bytes(31) + b"\x39": "1" * 31 + "z", bytes(31) + b"\x3a": "1" * 31 + "21", bytes([255] * 32): "JEKNVnkbo3jma5nREBBJCDoXFVeKkD56V3xKrvRmWxFG"}
    rows = spark.createDataFrame([(bytearray(k), v) for k, v in known.items()], "raw binary, text string")
    assert [r for r in rows.select("text", encoded(F.col("raw")).alias("made")).collect() if r["text"] != r["made"]] == []
