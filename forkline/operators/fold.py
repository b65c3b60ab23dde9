"""Current tables as folds over append-only logs, in commit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STATE = "struct<valid:boolean,before:boolean,since:bigint>"


def _folded(actions: Column, legacy: bool) -> Column:
    """The validity of a row after its actions, as (valid, before, since): W makes it valid, I invalid, R brings back.

    R brings back only what was valid before the last I; with legacy=True, everything. since is the order of the I that counts.
    """
    none = F.lit(None).cast("bigint")

    def step(s: Column, x: Column) -> Column:
        written = F.struct(F.lit(True).alias("valid"), s["before"].alias("before"), none.alias("since"))
        lost = F.struct(F.lit(False).alias("valid"), s["valid"].alias("before"), F.coalesce(s["since"], F.when(s["valid"], x["ord"])).alias("since"))
        back = s["valid"] | (F.lit(True) if legacy else s["before"])
        restored = F.struct(back.alias("valid"), s["before"].alias("before"), F.when(~back, s["since"]).alias("since"))
        return F.when(x["action"] == "W", written).when(x["action"] == "I", lost).otherwise(restored).cast(_STATE)

    start = F.struct(F.lit(False).alias("valid"), F.lit(False).alias("before"), none.alias("since"))
    return F.aggregate(actions, start, step)


def events_current(event_log: DataFrame, action_log: DataFrame, legacy: bool = False) -> DataFrame:
    """One row per (slot, source_seq): seq, kind and received_at of the first write, data of the last, and validity.

    Writes are folded per identity; rollback actions are one small array per slot that ever left the chain, joined by slot.
    Predicates on slot and source_seq go below the fold.
    """
    first, last = (lambda c: F.min_by(c, "ord").alias(c)), (lambda c: F.max_by(c, "ord").alias(c))
    kept = [c for c in event_log.columns if c not in ("slot", "source_seq", "ord", "at", "parent_slot", "data", "event_hash", "signature", "pubkey", "account_keys")]
    changed = [c for c in ("parent_slot", "data", "event_hash", "signature", "pubkey", "account_keys") if c in event_log.columns]
    writes = event_log.groupBy("slot", "source_seq").agg(*map(first, kept), *map(last, changed), F.sort_array(F.collect_set(F.struct("ord", F.lit("W").alias("action")))).alias("__writes"))
    per_slot = action_log.groupBy("slot").agg(F.sort_array(F.collect_list(F.struct("ord", "action", "at"))).alias("__actions"))
    joined = writes.join(per_slot, "slot", "left")
    slim = F.transform("__actions", lambda x: F.struct(x["ord"].alias("ord"), x["action"].alias("action")))
    state = F.when(F.col("__actions").isNotNull(), _folded(F.array_sort(F.concat("__writes", slim)), legacy))
    out = joined.withColumn("__state", state)
    since = F.col("__state.since")
    at = F.element_at(F.transform(F.filter("__actions", lambda x: x["ord"] == since), lambda x: x["at"]), 1)
    valid = F.coalesce("__state.valid", F.lit(True))
    return out.select("slot", "source_seq", *kept, *changed, valid.alias("is_valid"), F.when(~valid & since.isNotNull(), at).alias("invalidated_at"))


def slots_current(slot_log: DataFrame, action_log: DataFrame) -> DataFrame:
    """One row per slot: the last write, without losing a hash or time to a null, and the last rollback action after it."""
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(c)
    last = lambda c: F.max_by(c, "ord").alias(c)
    rows = slot_log.groupBy("slot").agg(last("parent_slot"), last("status"), last("transaction_count"), known("block_hash"), known("block_time"), F.min_by("received_at", "ord").alias("received_at"), F.max("ord").alias("__ord"))
    acts = action_log.groupBy("slot").agg(F.max(F.struct("ord", "action")).alias("__act"))
    after = F.col("__act.ord") > F.col("__ord")
    status = F.when(after & (F.col("__act.action") == "I"), "Orphaned").otherwise(F.when(after & (F.col("status") == "Orphaned"), "Processing").otherwise(F.col("status")))
    return rows.join(acts, "slot", "left").withColumn("status", status).select("slot", "parent_slot", "status", (F.col("status") != "Orphaned").alias("is_canonical"), "block_hash", "block_time", "transaction_count", "received_at")


def upsert_outcome(event_log: DataFrame) -> DataFrame:
    """(slot, source_seq, ord, outcome): the first write of an identity inserts, others update."""
    first = event_log.groupBy("slot", "source_seq").agg(F.min("ord").alias("__first"))
    return event_log.select("slot", "source_seq", "ord").join(first, ["slot", "source_seq"]).select("slot", "source_seq", "ord", F.when(F.col("ord") == F.col("__first"), "inserted").otherwise("updated").alias("outcome"))


def cursor_current(cursor_log: DataFrame) -> DataFrame:
    """One row per name; positions never fall, metadata and time are the last. A row without a slot deletes what its name had before."""
    gone = cursor_log.where("slot is null").groupBy("name").agg(F.max("ord").alias("__gone"))
    live = cursor_log.where("slot is not null").join(gone, "name", "left").where("__gone is null or ord > __gone")
    return live.groupBy("name").agg(F.max("slot").alias("slot"), F.max("seq").alias("seq"), F.max("source_seq").alias("source_seq"), F.max_by("metadata", "ord").alias("metadata"), F.max_by("updated_at", "ord").alias("updated_at"))


def batch_watermark(event_log: DataFrame) -> DataFrame:
    """The largest slot, seq and live source_seq; numbers made by a backfill don't count, as a live stream would then be cut off."""
    live = F.when(F.col("origin") == "live", F.col("source_seq"))
    return event_log.agg(F.max("slot").alias("slot"), F.max("seq").alias("seq"), F.max(live).alias("source_seq"))


def rollback_counts(event_log: DataFrame, actions: DataFrame, reorgs: DataFrame, legacy: bool = False) -> DataFrame:
    """Per reorg: events_invalidated and events_restored, those rows whose validity it changed.

    Rows of slots that some reorg names are replayed up to each one; others take no part.
    """
    touched = actions.select("slot").distinct()
    writes = event_log.join(touched, "slot", "left_semi").groupBy("slot", "source_seq").agg(F.collect_set(F.struct("ord", F.lit("W").alias("action"))).alias("__w"))
    per_slot = actions.groupBy("slot").agg(F.collect_list(F.struct("ord", "action")).alias("__a"))
    rows = writes.join(per_slot, "slot").withColumn("__all", F.array_sort(F.concat("__w", "__a")))
    each = rows.withColumn("__x", F.explode("__a"))
    before = _folded(F.filter("__all", lambda y: y["ord"] < F.col("__x.ord")), legacy)["valid"]
    after = _folded(F.filter("__all", lambda y: y["ord"] <= F.col("__x.ord")), legacy)["valid"]
    per = each.select(F.col("__x.ord").alias("ord"), (before & ~after).cast("long").alias("i"), (~before & after).cast("long").alias("r")).groupBy("ord").agg(F.sum("i").alias("events_invalidated"), F.sum("r").alias("events_restored"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return reorgs.join(per, "ord", "left").select(*reorgs.columns, zero("events_invalidated"), zero("events_restored"))
