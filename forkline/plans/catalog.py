"""The named queries over the chain that is derived from the driver's tables."""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import base58, scalars
from ..functions.hashing import event_hash
from ..operators import backfill as bf
from ..operators import chain, dlq, engine, fold, reads, sequence
from ..operators.prefix import smallest_after
from ..session import shared_folder
from ..sources import derived, rpc, script, wire
from . import oracle

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
#: Parameters that queries and their SQL twins share.
P = oracle.P


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()


def us(column: str):
    """A timestamp as microseconds since 1970, alike in any time zone."""
    return F.unix_micros(column).alias(f"{column}_us")


def joined(column: str):
    """An array of numbers as text."""
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",").alias(column)


def run(spark: SparkSession, sf_dir: str, **settings) -> engine.Indexed:
    return engine.index(derived.stream(spark, sf_dir), **settings)


def json_run(spark: SparkSession, sf_dir: str) -> engine.Indexed:
    return engine.index(derived.with_json_body(derived.stream(spark, sf_dir)), json_columns=True)


def readopted(spark: SparkSession, sf_dir: str) -> engine.Indexed:
    """The stream with a short-lived branch at each 25th slot of 50: it orphans two slots, and the next slot brings them back."""
    at = F.col("slot") % 50
    parent = F.when(at == 25, F.col("slot") - 3).when(at == 26, F.col("slot") - 2).otherwise(F.col("parent_slot"))
    return engine.index(derived.stream(spark, sf_dir).withColumn("parent_slot", parent))


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream with duplicates and late repeats among its arrivals."""
    rows = derived.stream(spark, sf_dir).drop("user_id").withColumn("arrival", F.col("source_seq") * 4)
    twice = rows.where(F.col("source_seq") % 37 == 5).withColumn("arrival", F.col("arrival") + 1)
    late = rows.where((F.col("source_seq") % 53 == 7) & (F.col("source_seq") > 3)).withColumns({"arrival": F.col("arrival") + 2, "source_seq": F.col("source_seq") - 3})
    return rows.unionByName(twice).unionByName(late)


@functools.cache
def _archive_rule():
    return F.col("slot") % 10 == 3


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of all slots, whose transactions are the Transaction events."""
    rows = derived.all_events(spark, sf_dir).where("kind = 'Transaction'")
    none = F.lit(None)
    tx = F.struct(
        F.struct(F.array(F.concat(F.lit("sig-"), F.col("source_seq") - 1)).alias("signatures"), F.col("payload").cast("string").alias("message")).alias("transaction"),
        F.struct(F.when(F.col("source_seq") % 7 == 0, "failed").alias("err"), F.when(F.col("source_seq") % 5 != 0, F.col("source_seq") * 10).alias("fee"), none.cast("long").alias("computeUnitsConsumed")).alias("meta"),
    )
    listed = F.transform(F.sort_array(F.collect_list(F.struct("source_seq", tx.alias("tx")))), lambda x: x["tx"]).alias("transactions")
    return rows.groupBy("slot").agg(listed).select("slot", (F.col("slot") - 1).alias("parentSlot"), F.concat(F.lit("hash-"), "slot").alias("blockhash"), F.lit(0).cast("long").alias("blockTime"), "transactions")


# ---- sources


@query
def wire_decode(spark, sf_dir):
    """Events that went over the wire, some with a kind that doesn't exist."""
    sent = wire.encode(derived.stream(spark, sf_dir)).withColumn("kind", F.when(F.col("sequence") % 29 == 0, F.lit(9)).otherwise(F.col("kind")))
    good, bad = wire.decode(sent)
    ok = good.select("source_seq", "kind", "slot", "parent_slot", us("received_at"), F.lit(True).alias("decoded"))
    return ok.unionByName(bad.select(F.col("sequence").alias("source_seq"), F.lit(None).cast("string").alias("kind"), "slot", "parent_slot", (F.col("received_at_ms") * 1000).alias("received_at_us"), F.lit(False).alias("decoded")))


@query
def src_subscribe(spark, sf_dir):
    return wire.subscribe(derived.stream(spark, sf_dir), P["after"], list(P["kinds"])).select("source_seq", "kind", "slot")


@query
def src_status(spark, sf_dir):
    return wire.status(derived.stream(spark, sf_dir))


def _script(spark, sf_dir):
    rows = derived.all_events(spark, sf_dir).groupBy("slot").agg(F.min("parent_slot").alias("parent_slot"), F.count(F.lit(1)).alias("events"))
    return rows.select((F.col("slot") - 1).alias("step"), "slot", "parent_slot", "events", F.lit("a").alias("branch"))


@query
def script_emit(spark, sf_dir):
    rows = script.emit(_script(spark, sf_dir))
    return rows.select("arrival", "source_seq", "slot", "parent_slot", F.get_json_object(F.col("payload").cast("string"), "$.label").alias("label"))


@query
def script_contiguity(spark, sf_dir):
    """Slots whose parent no slot is, of a script that lacks some."""
    return script.unknown_parents(_script(spark, sf_dir).where("slot % 20 != 11"))


@query
def rpc_block_explode(spark, sf_dir):
    return bf.explode_blocks(archive(spark, sf_dir)).select("slot", "parent_slot", "index", "signature", "success", "fee")


class _Archive:
    """A service of archived blocks by rule: slots divisible by 7 have none, the first request for one divisible by 11 fails, and a slot has up to 3 transactions."""

    def __init__(self) -> None:
        self.failed: set[int] = set()

    def __call__(self, url: str, body: bytes) -> tuple[int, str]:
        slot = json.loads(body)["params"][0]
        if slot % 11 == 0 and slot not in self.failed:
            self.failed.add(slot)
            return 503, "busy"
        if slot % 7 == 0:
            return 200, json.dumps({"error": {"code": rpc.NO_BLOCK[slot % len(rpc.NO_BLOCK)], "message": "skipped"}})
        made = []
        for k in range(slot % 4):
            meta = {"err": None if (slot + k) % 5 else {"InstructionError": [k, "Custom"]}, "fee": slot * 10 + k}
            made.append({"transaction": {"signatures": [f"sig-{slot}-{k}"], "message": {"accountKeys": []}}, "meta": None if k == 2 else meta})
        return 200, json.dumps({"result": {"parentSlot": slot - 1, "blockhash": f"hash-{slot}", "blockTime": slot, "transactions": made}})


@query
def rpc_fetch(spark, sf_dir):
    """Blocks of all slots, asked for by the executors from a service that is busy at times and lacks some."""
    slots = derived.all_events(spark, sf_dir).select("slot").distinct()
    blocks = rpc.fetch_blocks(spark, lambda: rpc.RpcClient("http://archive", post=_Archive(), sleep=lambda s: None), slots)
    return bf.explode_blocks(blocks).select("slot", "parent_slot", "index", "signature", "success", "fee")


# ---- writes


@query
def events_upsert(spark, sf_dir):
    """Every tenth event is delivered again later, with another payload."""
    x = run(spark, sf_dir)
    again = x.event_log.where("source_seq % 10 = 0").withColumns({"seq": F.col("seq") + 1_000_000_000, "data": F.concat(F.lit("again-"), "source_seq"), "ord": F.col("ord") + 4_000_000_000})
    return fold.events_current(x.event_log.unionByName(again), x.actions).select("slot", "source_seq", "seq", "data", "is_valid")


@query
def upsert_outcome(spark, sf_dir):
    log = run(spark, sf_dir).event_log.select("slot", "source_seq", "ord", "kind")
    again = log.where("source_seq % 10 = 0").withColumn("ord", F.col("ord") + 4_000_000_000)
    out = fold.upsert_outcome(log.unionByName(again))
    return out.groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


@query
def redelivery_revives(spark, sf_dir):
    """Rows of even orphaned slots are delivered again and are valid from then on."""
    x = run(spark, sf_dir)
    lost = x.actions.select("slot").distinct()
    again = x.event_log.where("slot % 2 = 0").join(lost, "slot", "left_semi").withColumn("ord", F.col("ord") + 4_000_000_000).select(*x.event_log.columns)
    return fold.events_current(x.event_log.unionByName(again), x.actions).select("slot", "source_seq", "is_valid", F.col("invalidated_at").isNull().alias("no_time"))


@query
def slots_current(spark, sf_dir):
    return run(spark, sf_dir).slots.select("slot", "parent_slot", "status", "is_canonical", us("received_at"))


def _cursors(spark, sf_dir):
    x = run(spark, sf_dir)
    block = F.expr("source_seq div 1000")
    per = x.event_log.groupBy(block.alias("block")).agg(F.max("slot").alias("slot"), F.max("seq").alias("seq"), F.max("source_seq").alias("source_seq"), F.max("ord").alias("ord"), F.max_by("at", "ord").alias("updated_at"))
    name = F.when(F.col("block") % 2 == 0, "even").otherwise("odd")
    return per.select(name.alias("name"), "slot", "seq", "source_seq", F.concat(F.lit("block-"), "block").alias("metadata"), "updated_at", "ord")


@query
def cursor_current(spark, sf_dir):
    return fold.cursor_current(_cursors(spark, sf_dir)).select("name", "slot", "seq", "source_seq", "metadata", us("updated_at"))


@query
def cursor_list(spark, sf_dir):
    return fold.cursor_current(_cursors(spark, sf_dir)).select("name", "slot", "source_seq").orderBy("name")


@query
def batch_watermark(spark, sf_dir):
    log = run(spark, sf_dir).event_log
    repaired = log.where("source_seq % 500 = 0").withColumns({"origin": F.lit("backfill"), "source_seq": scalars.backfill_sequence(F.col("slot"), F.lit(0))})
    return fold.batch_watermark(log.unionByName(repaired))


@query
def metrics_snapshot(spark, sf_dir):
    """What a metrics page shows, a row a metric."""
    x = run(spark, sf_dir)
    one = x.accepted.agg(F.count(F.lit(1)).alias("ingest_emitted"), F.sum(F.octet_length("payload")).alias("ingest_bytes")).crossJoin(x.reorgs.agg(F.count(F.lit(1)).alias("processor_reorgs"), F.sum("depth").cast("long").alias("processor_slots_rolled_back")))
    names = one.columns
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])).alias("m")).select("m.metric", "m.value")


# ---- reads


def _listed(query_: reads.EventQuery):
    return lambda spark, sf_dir: reads.list_events(run(spark, sf_dir).events, query_)


_QUERIES["events_list"] = _listed(reads.EventQuery())
_QUERIES["events_by_slot"] = _listed(reads.EventQuery(slot=P["slot"]))
_QUERIES["events_slot_range"] = _listed(reads.EventQuery(from_slot=P["from_slot"], to_slot=P["to_slot"], limit=1000))
_QUERIES["events_seq_range"] = _listed(reads.EventQuery(from_seq=P["from_seq"], to_seq=P["to_seq"], limit=1000))
_QUERIES["events_by_kind"] = _listed(reads.EventQuery(kind=P["kind"], limit=50, offset=20))


@query
def events_by_signature(spark, sf_dir):
    return reads.by_signature(json_run(spark, sf_dir).events, P["signature"])


@query
def events_by_account(spark, sf_dir):
    return reads.by_account(json_run(spark, sf_dir).events, P["account"])


@query
def events_valid(spark, sf_dir):
    """All rows with their validity and the time at which they lost it."""
    return run(spark, sf_dir).events.select("slot", "source_seq", "seq", "kind", "is_valid", us("invalidated_at"))


@query
def slot_lookup(spark, sf_dir):
    return reads.slot_lookup(run(spark, sf_dir).slots, P["lookup"])


@query
def canonical_slots(spark, sf_dir):
    return reads.canonical_slots(run(spark, sf_dir).slots)


@query
def chain_head(spark, sf_dir):
    return reads.chain_head(run(spark, sf_dir).slots)


@query
def event_counts(spark, sf_dir):
    return reads.event_counts(run(spark, sf_dir).events)


@query
def status(spark, sf_dir):
    x = run(spark, sf_dir)
    return reads.status(x.events, x.slots)


@query
def resume_state(spark, sf_dir):
    x = run(spark, sf_dir)
    positions, pairs = reads.resume_state(x.event_log, x.slots, _cursors(spark, sf_dir), "odd")
    return positions.crossJoin(pairs.agg(F.count(F.lit(1)).alias("canonical"), F.sum("parent_slot").alias("parents")))


@query
def reorg_history(spark, sf_dir):
    x = run(spark, sf_dir)
    return reads.reorg_history(x.audit, P["history"]).select("fork_slot", "parent_slot", "divergence_point", "depth", "events_invalidated", joined("slots_rolled_back"), "divergence_is_bound")


@query
def reorg_audit(spark, sf_dir):
    return readopted(spark, sf_dir).audit.select("fork_slot", "old_head", "parent_slot", "divergence_point", "depth", joined("slots_rolled_back"), joined("slots_restored"), "divergence_is_bound", "events_invalidated", "events_restored")


@query
def rollback_dry_run(spark, sf_dir):
    return reads.rollback_dry_run(run(spark, sf_dir).events, list(P["dry_run"]))


@query
def purge_invalid(spark, sf_dir):
    return reads.purge_invalid(run(spark, sf_dir).events, P["purge_below"]).groupBy("is_valid").agg(F.count(F.lit(1)).alias("rows"), F.min("slot").alias("min_slot"))


@query
def distinct_valid_slots(spark, sf_dir):
    return run(spark, sf_dir).events.where("is_valid").select("slot").distinct()


# ---- chain


@query
def chain_updates(spark, sf_dir):
    return run(spark, sf_dir).decisions.groupBy("outcome").agg(F.count(F.lit(1)).alias("runs"))


@query
def head_timeline(spark, sf_dir):
    return run(spark, sf_dir).decisions.select("slot", "head_before", "head_after")


@query
def ancestor_walk(spark, sf_dir):
    """Branches that came back: where the walk from their parent met the chain, and what it passed."""
    return readopted(spark, sf_dir).reorgs.where(F.size("slots_restored") > 0).select("fork_slot", "divergence_point", joined("slots_restored"))


@query
def orphan_ranges(spark, sf_dir):
    """Orphans without a tracker: slots below which a later slot's parent lies. Exact where no orphaned branch returns."""
    slots = derived.stream(spark, sf_dir).groupBy("slot").agg(F.min("parent_slot").alias("parent_slot"))
    return smallest_after(slots, "slot", "parent_slot", "below").where("below < slot").select("slot", "parent_slot")


@query
def rollback_apply(spark, sf_dir):
    x = run(spark, sf_dir)
    lost = x.actions.where("action = 'I'").select("slot").distinct()
    return x.events.join(lost, "slot", "left_semi").select("slot", "source_seq", "is_valid", us("invalidated_at"))


@query
def rollback_restore(spark, sf_dir):
    """Rows of slots that were orphaned and restored."""
    x = readopted(spark, sf_dir)
    back = x.actions.where("action = 'R'").select("slot").distinct()
    return x.events.join(back, "slot", "left_semi").select("slot", "source_seq", "is_valid", F.col("invalidated_at").isNull().alias("no_time"))


@query
def gap_joins(spark, sf_dir):
    """A stream that lacks slots rejoins without a rollback."""
    x = engine.index(derived.stream(spark, sf_dir).where("slot % 50 != 11"))
    return x.decisions.where(F.col("outcome") == "gap_join").select("slot", "parent_slot", "divergence", "is_bound")


@query
def late_slots(spark, sf_dir):
    """Old slots come again at the end, below a window of 100 slots: ignored, and their events are written all the same."""
    rows = derived.stream(spark, sf_dir).drop("user_id")
    old = rows.where("slot between 5 and 15").withColumns({"arrival": F.col("arrival") + 1_000_000_000, "origin": F.lit("replay"), "source_seq": F.col("source_seq") + 1_000_000_000})
    x = engine.index(rows.unionByName(old), max_slots=100)
    ignored = x.decisions.where("outcome = 'ignored'").select("slot").distinct()
    return x.events.where("source_seq > 1000000000").join(ignored, "slot", "left_semi").select("slot", (F.col("source_seq") - 1_000_000_000).alias("source_seq"), "is_valid")


@query
def rooted_refusals(spark, sf_dir):
    """Rooted slots don't revert: forks that would orphan one are refused."""
    rows = derived.stream(spark, sf_dir).withColumn("status", F.when(F.col("slot") % 50 == 47, "Rooted").otherwise("Processing"))
    return engine.index(rows).decisions.where("outcome = 'rooted_refusal'").select("slot", "parent_slot", joined("orphaned")).distinct()


@query
def depth_refusals(spark, sf_dir):
    """Rollbacks of more than three slots are refused, and nothing of the fork's slot is written."""
    x = run(spark, sf_dir, max_depth=3)
    refused = x.decisions.where("outcome = 'depth_refusal'").select("slot", "parent_slot", F.size("orphaned").alias("depth")).distinct()
    written = x.event_log.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    return refused.join(written, "slot", "left").select("slot", "parent_slot", "depth", F.coalesce("n", F.lit(0)).alias("written"))


@query
def canonical_replay(spark, sf_dir):
    """The yardstick: events of the last emission of canonical slots, found from the links alone."""
    rows = derived.stream(spark, sf_dir)
    slots = rows.groupBy("slot").agg(F.min("parent_slot").alias("parent_slot"))
    canonical = smallest_after(slots, "slot", "parent_slot", "below").where("below is null or below >= slot")
    return script.canonical_events(rows, canonical).select("slot", "source_seq", "kind")


@query
def chain_stats(spark, sf_dir):
    """The tracker's counters: divergences include gap joins."""
    d = engine.index(derived.stream(spark, sf_dir).where("slot % 50 != 11")).decisions
    moved = F.col("outcome").isin("reorg", "gap_join")
    return d.agg(F.count_if(moved).alias("divergences"), F.sum(F.when(moved, F.size("orphaned")).otherwise(0)).alias("slots_orphaned"), F.max(F.when(moved, F.size("orphaned"))).alias("max_depth"))


@query
def processor_stats(spark, sf_dir):
    """The processor's counters: reorgs and gap joins apart, dead letters and rows."""
    x = engine.index(derived.malformed_stream(spark, sf_dir).where("slot % 50 != 11"), check_json=True)
    d = x.decisions.agg(F.count_if(F.col("outcome") == "reorg").alias("reorgs"), F.count_if(F.col("outcome") == "gap_join").alias("gap_joins"), F.sum(F.when(F.col("outcome") == "reorg", F.size("orphaned")).otherwise(0)).alias("slots_rolled_back"))
    return x.event_log.agg(F.count(F.lit(1)).alias("processed")).crossJoin(x.bad.agg(F.count(F.lit(1)).alias("dead_letters"))).crossJoin(d)


@query
def persister_stats(spark, sf_dir):
    x = run(spark, sf_dir)
    return x.event_log.agg(F.count(F.lit(1)).alias("events_written")).crossJoin(x.slot_log.agg(F.count(F.lit(1)).alias("slots_written"))).crossJoin(x.audit.agg(F.count(F.lit(1)).alias("rollbacks"), F.sum("events_invalidated").alias("events_invalidated")))


@query
def rollback_depth_hist(spark, sf_dir):
    return run(spark, sf_dir).reorgs.groupBy("depth").agg(F.count(F.lit(1)).alias("reorgs"))


@query
def events_per_kind(spark, sf_dir):
    return run(spark, sf_dir).event_log.groupBy("kind").agg(F.count(F.lit(1)).alias("events"))


@query
def pipeline_end_state(spark, sf_dir):
    """The end state by kind and validity."""
    return run(spark, sf_dir).events.groupBy("kind", "is_valid").agg(F.count(F.lit(1)).alias("rows"), F.sum("seq").alias("seqs"), F.sum("slot").alias("slots"))


# ---- checks


@query
def check_duplicates(spark, sf_dir):
    log = run(spark, sf_dir).event_log.select("slot", "source_seq")
    return reads.duplicates(log.unionByName(log.where("source_seq % 250 = 0")))


def _whole_chain(spark, sf_dir):
    """The series of all forks, up to the last slot: all slots but those between a fork's parent and the fork."""
    last = derived.stream(spark, sf_dir).agg(F.coalesce(F.max("slot"), F.lit(0))).first()[0]
    block = F.expr(f"(slot - 1) div {derived.FORK_EVERY}")
    fork = (block + 1) * derived.FORK_EVERY
    lost = (fork <= last) & (F.col("slot") < fork) & (F.col("slot") >= fork - 1 - block % derived.DEPTHS)
    return spark.range(1, last + 1).withColumnRenamed("id", "slot").where(~lost)


@query
def check_missing_slots(spark, sf_dir):
    """Expected slots that aren't canonical: of the whole chain's series, and of all slots as if there were no fork."""
    slots, expected = reads.canonical_slots(run(spark, sf_dir).slots), _whole_chain(spark, sf_dir).withColumn("series", F.lit("chain"))
    every = spark.range(1, last_slot(spark, sf_dir) + 1).select(F.col("id").alias("slot"), F.lit("straight").alias("series"))
    return expected.unionByName(every).join(slots.select("slot"), "slot", "left_anti")


def extra_slots(slots, expected):
    """Canonical slots that aren't expected."""
    return reads.canonical_slots(slots).join(expected, "slot", "left_anti").select("slot")


@query
def check_extra_slots(spark, sf_dir):
    """Canonical slots, of the whole chain, that aren't expected."""
    return extra_slots(run(spark, sf_dir).slots, _whole_chain(spark, sf_dir))


# ---- sequences


@query
def sequence_classify(spark, sf_dir):
    return sequence.classify(noisy(spark, sf_dir)).select("arrival", "source_seq", "seen", "outcome", "gap_start", "gap_end")


@query
def sequence_gaps(spark, sf_dir):
    return sequence.gaps(sequence.classify(derived.stream(spark, sf_dir)))


@query
def gap_expand(spark, sf_dir):
    return sequence.expand(sequence.gaps(sequence.classify(derived.stream(spark, sf_dir))))


@query
def gaps_after_fill(spark, sf_dir):
    return sequence.gaps_after_fill(sequence.gaps(sequence.classify(derived.stream(spark, sf_dir))), *P["filled"])


@query
def sequence_stats(spark, sf_dir):
    return sequence.statistics(sequence.classify(noisy(spark, sf_dir)))


@query
def ingest_accept(spark, sf_dir):
    return sequence.accept(noisy(spark, sf_dir), last_seen=P["last_seen"]).select("arrival", "source_seq", "slot")


@query
def ingest_stats(spark, sf_dir):
    c = sequence.classify(noisy(spark, sf_dir))
    ok = F.col("outcome").isin("processed", "gap")
    return c.agg(
        F.count(F.lit(1)).alias("received"), F.count_if(ok).alias("emitted"), F.count_if(~ok).alias("duplicates"), F.sum(F.octet_length("payload")).alias("bytes"), F.count_if(F.col("outcome") == "gap").alias("gaps"), F.max("source_seq").alias("last_sequence")
    )


@query
def assign_seq(spark, sf_dir):
    return sequence.assign(derived.stream(spark, sf_dir), P["first_seq"]).select("source_seq", "seq")


@query
def shed_model(spark, sf_dir):
    """Ticks of 16 arrivals into a buffer with room for 10."""
    ticks = derived.stream(spark, sf_dir).withColumn("tick", F.expr("arrival div 16"))
    return sequence.shed(ticks, 10, "drop_newest").select("source_seq", "kept")


# ---- scalars


@query
def buffer_gauges(spark, sf_dir):
    """What came, was kept and was dropped in each tick of a bounded buffer that drops the newest."""
    rows = derived.stream(spark, sf_dir).withColumn("tick", F.expr("source_seq div 16"))
    kept = sequence.shed(rows, 10, "drop_newest", "source_seq")
    return kept.groupBy("tick").agg(F.count(F.lit(1)).alias("received"), F.count_if("kept").alias("depth"), F.count_if(~F.col("kept")).alias("dropped"))


@query
def events_hash(spark, sf_dir):
    rows = derived.stream(spark, sf_dir)
    return rows.select("slot", "source_seq", event_hash(F.col("slot"), F.col("source_seq"), F.col("kind"), F.col("payload")).alias("event_hash"))


@query
def parse_envelope(spark, sf_dir):
    """The stored envelope, read back."""
    v = F.try_parse_json(engine.envelope(F.col("payload").cast("string")))
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    return derived.stream(spark, sf_dir).select(get("$.source_seq", "long").alias("source_seq"), get("$.kind", "string").alias("kind"), get("$.slot", "long").alias("slot"), get("$.parent_slot", "long").alias("parent_slot"), get("$.body.k", "long").alias("k"))


@query
def base58_roundtrip(spark, sf_dir):
    """Keys and signatures of each event, encoded and decoded again; a signature is no key."""
    rows = derived.stream(spark, sf_dir).select("source_seq", F.unhex(F.sha2(F.col("source_seq").cast("string"), 256)).alias("key"), F.unhex(F.sha2(F.col("source_seq").cast("string"), 512)).alias("sig"))
    text = rows.select("source_seq", "key", "sig", base58.encoded(F.col("key")).alias("k"), base58.encoded(F.col("sig")).alias("s"))
    return text.select("source_seq", (base58.decoded(F.col("k"), 32) == F.col("key")).alias("key_ok"), (base58.decoded(F.col("s"), 64) == F.col("sig")).alias("signature_ok"), base58.decoded(F.col("s"), 32).isNull().alias("refused"))


@query
def account_data_size(spark, sf_dir):
    rows = derived.stream(spark, sf_dir)
    encoding = F.when(F.col("source_seq") % 3 == 0, "raw").when(F.col("source_seq") % 3 == 1, "base64").otherwise("truncated")
    return rows.select("source_seq", encoding.alias("encoding"), F.col("payload").cast("string").alias("data")).select("source_seq", scalars.account_data_size(F.col("encoding"), F.col("data"), F.lit(1000)).alias("size"))


@query
def error_classify(spark, sf_dir):
    names = "GrpcConnection StreamEnded InvalidMessage SequenceGap DuplicateSequence SequenceRegression ForkDetected RollbackFailed EventParse EventValidation ProcessingTimeout DatabaseConnection DatabaseQuery DuplicateKey Serialization DlqWriteFailed BackfillCursor BackfillRange Configuration ChannelClosed ChannelFull".split()
    rows = spark.createDataFrame([(n,) for n in names], "error string")
    e = F.col("error")
    return rows.select("error", scalars.error_category(e).alias("category"), *(c.alias(n) for n, c in scalars.error_traits(e).items()))


@query
def backfill_sequence(spark, sf_dir):
    return derived.stream(spark, sf_dir).select("source_seq", scalars.backfill_sequence(F.col("slot"), F.col("source_seq") % 4).alias("sequence"), scalars.backfill_sequence(F.col("slot") + F.lit(2**43), F.lit(0)).alias("saturated"))


@query
def sequence_scalar(spark, sf_dir):
    n, m = F.col("source_seq"), F.col("slot") * 4 + F.col("source_seq") % 7 - 3
    return derived.stream(spark, sf_dir).select("source_seq", scalars.sequence_next(n).alias("next"), scalars.sequence_prev(n - 1).alias("prev"), scalars.gap_to(n, m).alias("gap"))


@query
def kind_priority(spark, sf_dir):
    return derived.stream(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("events")).select("kind", "events", scalars.kind_priority(F.col("kind")).alias("priority"))


@query
def slot_status_flags(spark, sf_dir):
    s = F.col("status")
    return run(spark, sf_dir).slots.select("slot", "status", *(c.alias(n) for n, c in scalars.status_flags(s).items()))


@query
def redact_url(spark, sf_dir):
    url = F.concat(F.when(F.col("user_id") % 3 == 0, F.lit("postgres://u:p@host/")).when(F.col("user_id") % 3 == 1, F.lit("postgres://host/")).otherwise(F.lit("mailto@host/")), F.col("user_id"))
    return derived.stream(spark, sf_dir).select("user_id").distinct().select("user_id", scalars.redact_url(url).alias("shown"))


@query
def handler_validate(spark, sf_dir):
    """Handlers by kind: transactions must have an even k, and logging takes all kinds."""
    from ..operators.handlers import Handler, Registry

    k = F.try_variant_get(F.try_parse_json(F.col("payload").cast("string")), "$.k", "long")
    registry = Registry([Handler("even", ("Transaction",), k % 2 == 0), Handler("logging", (), F.lit(True))])
    good, bad = registry.split(derived.stream(spark, sf_dir))
    return good.select("source_seq", F.lit(None).cast("string").alias("rejected_by")).unionByName(bad.select("source_seq", "rejected_by"))


@query
def handler_pipeline(spark, sf_dir):
    """The whole pipeline with handlers: transactions must have an even k; what is refused becomes a dead letter."""
    from ..operators.handlers import Handler, Registry, logging_handler

    k = F.try_variant_get(F.try_parse_json(F.col("payload").cast("string")), "$.k", "long")
    x = run(spark, sf_dir, handlers=Registry([Handler("even", ("Transaction",), k % 2 == 0), logging_handler()]))
    letters = dlq.rejects(x.refused, "EventValidation", "validation")
    none = lambda kind: F.lit(None).cast(kind)
    good = x.events.select("source_seq", "slot", "kind", "seq", "is_valid", none("string").alias("error_category"))
    return good.unionByName(letters.select(F.col("sequence").alias("source_seq"), "slot", "kind", none("long").alias("seq"), none("boolean").alias("is_valid"), "error_category"))


# ---- dead letters


def _letters(spark, sf_dir):
    x = engine.index(derived.malformed_stream(spark, sf_dir), check_json=True)
    return x, dlq.rejects(x.bad)


def _tried(spark, sf_dir):
    """Entries after some were tried again: odd slots with success, slots divisible by four until nothing was left."""
    _, log = _letters(spark, sf_dir)
    later = F.col("failed_at") + F.expr("interval 1 hour")
    done = log.where("slot % 2 = 1").withColumns({"retry_count": F.lit(1), "is_resolved": F.lit(True), "last_retry_at": later, "resolved_at": later, "ord": F.col("ord") + 1})
    spent = log.where("slot % 4 = 0").withColumns({"retry_count": F.lit(3), "last_retry_at": later, "ord": F.col("ord") + 1})
    return log.unionByName(done).unionByName(spent)


@query
def dlq_rejects(spark, sf_dir):
    """Malformed events, and what else was written."""
    x, log = _letters(spark, sf_dir)
    bad = log.select(F.col("sequence").alias("source_seq"), "slot", "parent_slot", "kind", "error_category", "retry_count", F.col("raw_payload").cast("string").alias("payload"))
    good = x.event_log.select("source_seq", "slot", "parent_slot", "kind", F.lit(None).cast("string").alias("error_category"), F.lit(None).cast("int").alias("retry_count"), F.col("data").alias("payload"))
    return bad.unionByName(good)


@query
def dlq_state(spark, sf_dir):
    return dlq.state(_tried(spark, sf_dir)).select("sequence", "slot", "kind_known", "retry_count", "status", "can_retry", us("resolved_at"))


@query
def dlq_unresolved(spark, sf_dir):
    return dlq.unresolved(dlq.state(_tried(spark, sf_dir))).select("sequence", "slot", "retry_count")


@query
def dlq_by_category(spark, sf_dir):
    return dlq.by_category(dlq.state(_tried(spark, sf_dir)), "malformed").select("sequence", "slot")


@query
def dlq_by_slots(spark, sf_dir):
    return dlq.by_slots(dlq.state(_tried(spark, sf_dir)), list(P["dlq_slots"]), 1000).select("sequence", "slot")


@query
def dlq_by_category_counts(spark, sf_dir):
    return dlq.category_counts(dlq.state(_tried(spark, sf_dir)))


@query
def dlq_age(spark, sf_dir):
    """Seconds from each failure to a fixed time."""
    now = F.timestamp_seconds(F.lit(P["now_s"]))
    return dlq.state(_tried(spark, sf_dir)).select("sequence", (F.unix_micros(now) - F.unix_micros("failed_at")).alias("age_us"))


@query
def dlq_purge(spark, sf_dir):
    now = F.timestamp_seconds(F.lit(P["now_s"]))
    return dlq.purged(dlq.state(_tried(spark, sf_dir)), P["purge_days"], now).select("sequence", "is_resolved")


@query
def dlq_replay(spark, sf_dir):
    """Entries that may be tried again go through the pipeline: those that fail again are new entries without retries."""
    log = _tried(spark, sf_dir)
    raw, rows = dlq.replay(log, dlq.unresolved(dlq.state(log)), 1_000_000_000, F.timestamp_seconds(F.lit(P["now_s"])))
    _, bad = dlq.split(raw)
    again = dlq.rejects(bad).select("sequence", "retry_count", "is_resolved")
    return rows.select("sequence", "retry_count", "is_resolved").unionByName(again)


@query
def letters_store(spark, sf_dir):
    """A store of dead letters: some are resolved long ago and purged, others are resolved now, the rest waits."""
    from ..operators.letters import FolderLetters

    _, log = _letters(spark, sf_dir)
    store = FolderLetters(spark, f"{shared_folder(spark)}/letters-{uuid.uuid4().hex}")
    store.insert(log)
    now = F.timestamp_seconds(F.lit(P["now_s"]))
    for slots, days in ((P["dlq_slots"][:3], 1 + P["purge_days"]), (P["dlq_slots"][3:], 0)):
        chosen = store.entries().where(F.col("slot").isin(*slots)).select("id").collect()  # of a few slots
        store.resolve([r[0] for r in chosen], now - F.make_dt_interval(F.lit(days)))
        store.purge(P["purge_days"], now)
    return store.entries().select("sequence", "slot", "status", "can_retry", us("resolved_at"))


@query
def replay_summary(spark, sf_dir):
    return dlq.replay_summary(dlq.state(_tried(spark, sf_dir)).select("id", F.col("is_resolved").alias("ok")))


# ---- backfill


def _live(spark, sf_dir):
    return derived.stream(spark, sf_dir).where(~_archive_rule())


def last_slot(spark, sf_dir) -> int:
    return derived.all_events(spark, sf_dir).agg(F.coalesce(F.max("slot"), F.lit(0))).first()[0]


@query
def backfill_candidates(spark, sf_dir):
    """Archived slots in two overlapping ranges, which cover the table, that hold no event."""
    end = last_slot(spark, sf_dir)
    wanted = bf.ranges(spark, [(1, end - 20, False), (end - 50, end, True), (9, 3, True)])
    return bf.candidates(archive(spark, sf_dir), wanted, _live(spark, sf_dir)).select("slot", F.size("transactions").alias("transactions"))


@query
def backfill_events(spark, sf_dir):
    wanted = bf.ranges(spark, [(1, last_slot(spark, sf_dir), False)])
    raw = bf.to_raw(bf.explode_blocks(bf.candidates(archive(spark, sf_dir), wanted, _live(spark, sf_dir))), P["first_arrival"])
    body = F.try_parse_json(F.col("payload").cast("string"))
    return raw.select("arrival", "source_seq", "origin", "slot", "parent_slot", F.try_variant_get(body, "$.signature", "string").alias("signature"), F.try_variant_get(body, "$.fee", "long").alias("fee"), F.try_variant_get(body, "$.message.k", "long").alias("k"))


@query
def gap_to_slots(spark, sf_dir):
    """Slot ranges that the stream's gaps may stand for, near the head."""
    found = sequence.gaps(sequence.classify(derived.stream(spark, sf_dir)))
    return bf.gaps_to_ranges(found, F.expr("gap_end div 4 + 1")).select("start_slot", "end_slot", "priority", "is_gap_fill")


@query
def backfill_queue(spark, sf_dir):
    gaps_ = bf.gaps_to_ranges(sequence.gaps(sequence.classify(derived.stream(spark, sf_dir))), F.expr("gap_end div 4 + 1"))
    return bf.queue(gaps_.unionByName(bf.ranges(spark, [(1, 500, False), (700, 600, False), (600, 700, False)]))).select("start_slot", "end_slot", "priority", "is_gap_fill", "slots")


@query
def backfill_progress(spark, sf_dir):
    """Share of slot 2000 that each kind's last slot reaches."""
    return derived.stream(spark, sf_dir).groupBy("kind").agg(F.max("slot").alias("slot")).select("kind", bf.progress(F.col("slot"), F.lit(2000)).alias("progress"))


# ---- the store and the API


class _NoStore:
    """A store that fails, whose error must not be shown."""

    def events(self):
        raise OSError("secret-host:5432")


@query
def api_responses(spark, sf_dir):
    """What the API answers over a store that took the stream in two batches, the first of them twice."""
    from ..streaming.engine import ingest
    from ..streaming.store import Store
    from .api import Api

    store, rows = Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"), derived.stream(spark, sf_dir)
    early = F.col("arrival") <= P["first_batch"]
    committed = [ingest(store, rows.where(c), batch) for c, batch in ((early, 0), (early, 0), (~early, 1))]
    asked = [("health/live", {}), ("health/ready", {}), ("metrics", {}), ("v1/status", {}), ("v1/chain/head", {}), ("v1/events", {"limit": "1000", "kind": P["kind"]}), ("v1/events", {"kind": "Nope"}), (f"v1/events/slot/{P['slot']}", {}), ("v1/events/slot/x", {}), (f"v1/slots/{P['lookup']}", {}), ("v1/slots/999999999999", {}), ("v1/nowhere", {})]
    out = [("commits", sum(committed), store.last()["commit"], None)]
    for api, path, params in [*((Api(store), p, q) for p, q in asked), (Api(_NoStore()), "v1/events", {"limit": "1"})]:
        code, text = api.handle(path, params)
        body = json.loads(text) if text.startswith("{") else {}
        value = body.get("count", body.get("head", body.get("slot", body.get("events", {}).get("valid"))))
        out.append(("/".join([path, *(f"{k}={v}" for k, v in sorted(params.items()))]), code, value, body.get("error") if code == 500 else None))
    return spark.createDataFrame(out, "request string, code int, value long, shown string")
