"""Routes of the read API, metrics, and maintenance of a store."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from forkline.operators import dlq
from forkline.plans.api import Api
from forkline.sources.script import ChainScript
from forkline.streaming import engine as st
from forkline.streaming.metrics import Metrics
from forkline.streaming.store import Store


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    store, metrics = Store(spark, f"file://{tmp_path_factory.mktemp('api')}/store"), Metrics()
    events = ChainScript().fork(1, 0, 10, 3, "a").fork(11, 7, 4, 3, "b").events(spark)
    bad = F.when((F.col("slot") == 2) & (F.col("source_seq") % 3 == 0), F.lit("{ bad").cast("binary")).otherwise(F.col("payload"))
    st.ingest(store, events.withColumn("payload", bad), 0, metrics=metrics)
    return store, metrics, Api(store, metrics)


def get(api, path, **params):
    status, body = api.handle(path, params)
    return status, json.loads(body)


def test_orphans_are_invisible_everywhere(served):
    api = served[2]
    assert get(api, "/v1/events", limit="1000")[1]["count"] == 32
    assert get(api, "/v1/events/slot/8") == (200, {"count": 0, "data": []})
    assert get(api, "/v1/events/signature/sig-a-9-1")[1]["count"] == 0
    assert [r["slot"] for r in get(api, "/v1/events/signature/sig-b-12-1")[1]["data"]] == [12]
    assert get(api, "/v1/events/account/acct-b")[1]["count"] == 12
    assert get(api, "/v1/events", from_slot="6", to_slot="11")[1]["count"] == 9
    assert get(api, "/v1/events", kind="Entry")[1]["count"] == 0


def test_lookups_and_status(served):
    api = served[2]
    assert get(api, "/v1/slots/8")[1] == {"slot": 8, "parent_slot": 7, "status": "Orphaned", "is_canonical": False}
    assert get(api, "/v1/slots/999")[0] == 404 and get(api, "/v1/nothing")[0] == 404
    assert get(api, "/v1/chain/head") == (200, {"head": 14})
    status = get(api, "/v1/status")[1]
    assert status["chain_head"] == 14 and (status["events"]["valid"], status["events"]["invalid"]) == (32, 9)
    assert get(api, "/health/live")[0] == get(api, "/health/ready")[0] == 200


def test_bad_parameters_and_masked_errors(served, monkeypatch):
    store, _, api = served
    assert get(api, "/v1/events", limit="ten")[0] == 400 and get(api, "/v1/events", kind="Nothing")[0] == 400
    with monkeypatch.context() as m:
        m.setattr(store, "slots", lambda: (_ for _ in ()).throw(RuntimeError("secret")))
        status, body = api.handle("/v1/chain/head")
    assert status == 500 and "secret" not in body


def test_metrics(served):
    text = served[2].handle("/metrics")[1]
    assert "processor_reorgs 1" in text and 'processor_rollback_depth_bucket{le="4"} 1' in text and "dlq_entries 1" in text
    assert Api(served[0]).handle("/metrics")[0] == 503


def test_cursors_and_purges(served, spark):
    store = served[0]
    assert [(r["name"], r["slot"]) for r in store.cursors().collect()] == [("main", 14)]
    store.delete_cursor("main")
    assert store.cursors().count() == 0
    before = store.last()
    assert store.purge_invalid(9) == 3 and store.purge_invalid(9) == 0
    counts = store.events().groupBy("is_valid").count().collect()
    assert {r[0]: r[1] for r in counts} == {True: 32, False: 6}
    assert st.replay_letters(store, dlq.unresolved(store.letters()), F.timestamp_seconds(F.lit(0))) == 1
    assert store.purge_letters(1) == 1 and store.letters().count() == 1
    assert store.last()["tracker"] is not None and store.last()["cursor"]["slot"] == before["cursor"]["slot"]
    store.register_views("t_")
    assert spark.sql("select count(*) from t_events_current where is_valid").first()[0] == 32
