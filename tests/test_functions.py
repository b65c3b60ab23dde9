"""Pinned values of scalar functions, sources and configuration."""

from __future__ import annotations

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forkline.functions import base58, scalars
from forkline.functions.hashing import event_hash
from forkline.functions.strict_json import is_document
from forkline.operators import backfill as bf
from forkline.operators import fold, prefix, sequence
from forkline.sources import config, rpc, wire


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_event_hash_is_pinned(spark):
    got = one(spark, event_hash(F.lit(4242), F.lit(7), F.lit("Transaction"), F.lit("stable").cast("binary")))
    assert got == ("f506a53f9c0e815d65a15b28e11fc222",)


@given(st.binary(max_size=70))
def test_base58_round_trip(raw):
    assert base58.decode(base58.encode(raw)) == raw


def test_base58_lengths():
    assert base58.decode("1" * 32) == b"\0" * 32
    assert base58.decode("0OIl") is None


@pytest.mark.parametrize(("text", "ok"), [('{"a":1}', True), ('{"a":1} x', False), ('{"a":1}{"b":2}', False), ("", False), ('{"a":1,"a":2}', True), ("5", True), ("NaN", False), ("1e400", False), ("{ this is not json", False), ("\xff", False)])
def test_strict_json(text, ok):
    assert is_document(text.encode("latin-1")) is ok
    assert not is_document(None)


def test_scalars(spark):
    big = 2**63 - 1
    assert one(spark, scalars.backfill_sequence(F.lit(5), F.lit(3)), scalars.backfill_sequence(F.lit(2**43), F.lit(0)), scalars.sequence_next(F.lit(big)), scalars.sequence_prev(F.lit(0)), scalars.gap_to(F.lit(5), F.lit(3))) == (5 * 2**20 + 3, big, big, None, None)
    size = lambda e, d, n: scalars.account_data_size(F.lit(e), F.lit(d), F.lit(n))
    assert one(spark, size("raw", "x" * 100, 0), size("base64", "abcd", 0), size("truncated", "", 1000)) == (100, 3, 1000)
    assert one(spark, scalars.redact_url(F.lit("postgres://u:p@h/d")), scalars.redact_url(F.lit("postgres://h/d"))) == ("postgres://***@h/d", "postgres://h/d")
    assert [scalars.page_size(n) for n in (None, 50, 0, 10**6)] == [100, 50, 1, 1000]
    assert one(spark, bf.progress(F.lit(500), F.lit(1000)), bf.progress(F.lit(2000), F.lit(1000)), bf.progress(F.lit(5), F.lit(0))) == (0.5, 1.0, 0.0)


def arrivals(spark, numbers):
    return spark.createDataFrame(list(enumerate(numbers)), "arrival long, source_seq long").withColumn("origin", F.lit("live"))


@pytest.mark.parametrize("width", [2, 65_536])
def test_sequence_classes(spark, width):
    rows = sequence.classify(arrivals(spark, [1, 2, 2, 5, 3, 6, 6, 9]), width=width).orderBy("arrival").collect()
    assert [r["outcome"] for r in rows] == ["processed", "processed", "duplicate", "gap", "regression", "processed", "duplicate", "gap"]
    assert [(r["gap_start"], r["gap_end"]) for r in rows if r["outcome"] == "gap"] == [(3, 4), (7, 8)]


@given(st.lists(st.integers(0, 50), min_size=1, max_size=30))
def test_accepted_numbers_rise(numbers):
    last, kept = -1, []
    for n in numbers:
        if n > last:
            kept.append(n)
            last = n
    assert kept == sorted(set(kept))


def test_two_phase_scans_equal_global_windows(spark):
    df = spark.createDataFrame([(i, (i * 7) % 11) for i in range(50)], "o long, v long")
    rows = prefix.numbered(prefix.running_max_before(prefix.smallest_after(prefix.running_sum_before(df, "o", "v", "s", 4), "o", "v", "m", 5), "o", "v", "x", 6), "o", "n", 10, 7).orderBy("o").collect()
    v = [(i * 7) % 11 for i in range(50)]
    for i, r in enumerate(rows):
        assert (r["s"], r["n"]) == (sum(v[:i]), 10 + i)
        assert r["x"] == (max(v[:i]) if i else None) and r["m"] == (min(v[i + 1 :]) if i < 49 else None)


def test_scans_over_spans_of_sparse_buckets_equal_global_windows(spark, monkeypatch):
    monkeypatch.setattr(prefix, "SPAN", 3)
    o = sorted({(i * i * i * 5) % 2003 - 400 for i in range(60)})
    v = [(i * 7) % 11 for i in range(len(o))]
    df = spark.createDataFrame(list(zip(o, v, strict=True)), "o long, v long").repartition(5)
    rows = prefix.numbered(prefix.running_max_before(prefix.smallest_after(prefix.running_sum_before(df, "o", "v", "s", 9), "o", "v", "m", 2), "o", "v", "x", 40), "o", "n", 1, 7).orderBy("o").collect()
    assert [tuple(r) for r in rows] == [(o[i], v[i], sum(v[:i]), min(v[i + 1 :], default=None), max(v[:i], default=None), i + 1) for i in range(len(o))]


def test_watermark_ignores_backfilled_numbers(spark):
    log = spark.createDataFrame([("live", 10, 5, 7), ("live", 12, 9, 11), ("backfill", 11, 6, 2**40)], "origin string, slot long, seq long, source_seq long")
    assert tuple(fold.batch_watermark(log).first()) == (12, 9, 11)


def test_wire(spark):
    rows = spark.createDataFrame([(1, 2, 5, None, bytearray(b"x"), 1500), (2, 9, 5, 4, bytearray(b""), 0), (3, 0, -1, None, bytearray(b""), 0)], "sequence long, kind int, slot long, parent_slot long, payload binary, received_at_ms long")
    good, bad = wire.decode(rows)
    assert [(r["source_seq"], r["kind"]) for r in good.collect()] == [(1, "Transaction")] and bad.count() == 2
    assert wire.encode(good).select(*rows.columns).collect() == rows.where("sequence = 1").collect()


def test_rpc_retries_transport_and_not_answers():
    waits, answers = [], [(503, ""), (429, ""), (200, json.dumps({"result": 7}))]
    client = rpc.RpcClient("http://x", post=lambda u, b: answers.pop(0), sleep=waits.append)
    assert client.current_slot() == 7 and waits == [0.2, 0.4]
    pruned = rpc.RpcClient("http://x", post=lambda u, b: (200, json.dumps({"error": {"code": -32007, "message": "skipped"}})), sleep=waits.append)
    assert pruned.block(5) is None
    with pytest.raises(rpc.RpcError):
        pruned.current_slot()
    with pytest.raises(ValueError):
        pruned.slots_with_blocks(9, 3)


def test_config(tmp_path):
    file = tmp_path / "c.toml"
    file.write_text('[ingester]\noverflow_policy = "nonsense"\n[persister]\nbatch_size = 20\n')
    c = config.load(str(file), {"FORKLINE_BATCH_SIZE": "30"})
    assert (c.batch_size, c.overflow_policy, c.chain_tracker_max_slots) == (30, "block", 10_000)
    with pytest.raises(ValueError):
        config.load(None, {"FORKLINE_BATCH_SIZE": "many"})
    assert config.source_mode({}) == "subscribe" and config.source_mode({"FORKLINE_SOURCE": "demo"}) == "scripted"


def test_backfill_ranges_and_blocks(spark):
    queue = bf.queue(bf.ranges(spark, [(10, 5, False), (1, 3, False), (7, 7, True)])).collect()
    assert [(r["start_slot"], r["slots"]) for r in queue] == [(7, 1), (1, 3)]
    gaps = spark.createDataFrame([(1, 5000)], "gap_start long, gap_end long")
    assert tuple(bf.gaps_to_ranges(gaps, F.lit(1500)).first())[:2] == (500, 1500)


def test_subscription_source_resumes(spark, tmp_path):
    from forkline.sources.subscription import Subscription

    lines = [json.dumps({"sequence": i, "kind": i % 2, "slot": i, "parent_slot": i - 1, "payload": "{}", "received_at_ms": i}) for i in range(1, 8)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text("\n".join(lines))
    spark.dataSource.register(Subscription)
    stream = spark.readStream.format("forkline_subscription").option("path", str(tmp_path / "in")).option("after", "2").option("batch", "3").load()
    q = stream.writeStream.format("memory").queryName("got").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.processAllAvailable() if q.isActive else None
    q.awaitTermination(60)
    got = sorted(r[0] for r in spark.sql("select sequence from got").collect())
    assert got and got == list(range(3, 3 + len(got)))
