"""The read layer: canonical-only listings, lookups and counts over the current tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import page_size


@dataclass(frozen=True)
class EventQuery:
    """Filters of a listing; None means any. Ranges are inclusive."""

    slot: int | None = None
    from_slot: int | None = None
    to_slot: int | None = None
    from_seq: int | None = None
    to_seq: int | None = None
    kind: str | None = None
    limit: int | None = None
    offset: int = 0

    def apply(self, events: DataFrame) -> DataFrame:
        """Only the predicates that are given, so each can reach the scan."""
        tests = (("slot", "=", self.slot), ("slot", ">=", self.from_slot), ("slot", "<=", self.to_slot), ("seq", ">=", self.from_seq), ("seq", "<=", self.to_seq), ("kind", "=", self.kind))
        for column, op, value in tests:
            if value is not None:
                c = F.col(column)
                events = events.where(c == value if op == "=" else c >= value if op == ">=" else c <= value)
        return events


COLUMNS = ("slot", "seq", "source_seq", "kind", "parent_slot", "event_hash")


def page(events: DataFrame, limit: int | None = None, offset: int = 0, default: int = 100, most: int = 1000) -> DataFrame:
    """Valid rows in (slot, seq) order, one page of them."""
    rows = events.where("is_valid").select(*COLUMNS).orderBy("slot", "seq")
    return (rows.offset(offset) if offset else rows).limit(page_size(limit, default, most))


def list_events(events: DataFrame, query: EventQuery) -> DataFrame:
    return page(query.apply(events), query.limit, query.offset)


def by_signature(events: DataFrame, signature: str, most: int = 1000) -> DataFrame:
    return page(events.where(F.col("signature") == signature), most, most=most)


def by_account(events: DataFrame, account: str, limit: int | None = None) -> DataFrame:
    """Rows whose key is the account, or whose keys hold it."""
    return page(events.where(F.coalesce(F.col("pubkey") == account, F.lit(False)) | F.coalesce(F.array_contains("account_keys", account), F.lit(False))), limit)


def slot_lookup(slots: DataFrame, slot: int) -> DataFrame:
    return slots.where(F.col("slot") == slot).select("slot", "parent_slot", "status", "is_canonical")


def canonical_slots(slots: DataFrame) -> DataFrame:
    return slots.where("is_canonical").select("slot", "parent_slot").orderBy("slot")


def chain_head(slots: DataFrame) -> DataFrame:
    return slots.where("is_canonical").agg(F.max("slot").alias("head"))


def event_counts(events: DataFrame) -> DataFrame:
    """One row: valid and invalid rows, the largest seq and slot of valid ones (0 without any), and the smallest slot."""
    top = lambda c: F.coalesce(F.max(F.when(F.col("is_valid"), F.col(c))), F.lit(0)).cast("long")
    return events.agg(F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("invalid"), top("seq").alias("max_seq"), top("slot").alias("max_slot"), F.min("slot").alias("min_slot"))


def status(events: DataFrame, slots: DataFrame) -> DataFrame:
    return event_counts(events).crossJoin(chain_head(slots))  # one row each


def resume_state(event_log: DataFrame, slots: DataFrame, cursors: DataFrame, name: str = "main") -> tuple[DataFrame, DataFrame]:
    """(positions, canonical pairs): where a restart goes on, and what it feeds its tracker."""
    own = cursors.where(F.col("name") == name).agg(F.max("slot").alias("cursor_slot"), F.max("source_seq").alias("cursor_source_seq"))
    return own.crossJoin(event_log.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("max_seq"))), canonical_slots(slots)


def reorg_history(reorgs: DataFrame, limit: int = 100) -> DataFrame:
    return reorgs.orderBy(F.desc("detected_at"), F.desc("ord")).limit(limit).select("fork_slot", "parent_slot", "divergence_point", "depth", "events_invalidated", "slots_rolled_back", "divergence_is_bound")


def rollback_dry_run(events: DataFrame, slots: list[int]) -> DataFrame:
    """How many valid rows a rollback of the slots would touch."""
    if not slots:
        return events.sparkSession.createDataFrame([(0,)], "events bigint")
    return events.where(F.col("is_valid") & F.col("slot").isin(slots)).agg(F.count(F.lit(1)).alias("events"))


def purge_invalid(events: DataFrame, before_slot: int) -> DataFrame:
    """What stays when invalid rows strictly below a slot go."""
    return events.where(F.col("is_valid") | (F.col("slot") >= before_slot))


def duplicates(event_log: DataFrame) -> DataFrame:
    return event_log.groupBy("slot", "source_seq").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def as_json(rows: DataFrame) -> dict:
    """A list response of a page: {"count": n, "data": [...]}."""
    import json

    data = [json.loads(x.asDict()["value"]) for x in rows.select(F.to_json(F.struct("*")).alias("value")).collect()]
    return {"count": len(data), "data": data}
