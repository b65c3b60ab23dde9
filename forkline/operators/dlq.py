"""Dead letters: rejects, their state over retries, selection and replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strict_json import is_strict_json
from ..schemas import DLQ_LOG, KINDS

MAX_RETRIES = 3


def split(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad payloads are empty or not one JSON document."""
    marked = events.withColumn("__ok", F.coalesce(is_strict_json(F.col("payload")), F.lit(False)))
    return marked.where("__ok").drop("__ok"), marked.where("not __ok").drop("__ok")


def rejects(bad: DataFrame, error: str = "EventParse", category: str = "malformed", max_retries: int = MAX_RETRIES) -> DataFrame:
    """Entries for bad events, with their original payload; ids are made from slot, sequence and arrival."""
    none = lambda kind: F.lit(None).cast(kind)
    return bad.select(
        F.sha2(F.concat_ws(":", F.lit("dlq"), "slot", "source_seq", "arrival"), 256).substr(1, 32).alias("id"),
        F.col("payload").alias("raw_payload"),
        F.col("source_seq").alias("sequence"),
        "slot",
        "parent_slot",
        "kind",
        F.lit(error).alias("error_message"),
        F.lit(category).alias("error_category"),
        F.lit(0).alias("retry_count"),
        F.lit(max_retries).alias("max_retries"),
        F.lit(False).alias("is_resolved"),
        F.col("received_at").alias("failed_at"),
        none("timestamp").alias("last_retry_at"),
        none("timestamp").alias("resolved_at"),
        "received_at",
        (F.col("arrival") * 4).alias("ord"),
    )


def state(log: DataFrame) -> DataFrame:
    """The last row of each id, with kind_known, status and can_retry. Exhaustion follows from the counts, so it survives a reload."""
    rest = [c for c in log.columns if c not in ("id", "ord")]
    last = log.groupBy("id").agg(F.max_by(F.struct(*rest), "ord").alias("__x")).select("id", "__x.*")
    spent = F.col("retry_count") >= F.col("max_retries")
    status = F.when(F.col("is_resolved"), "Resolved").when(spent, "Exhausted").otherwise("Pending")
    return last.withColumns({"kind_known": F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)), "status": status, "can_retry": ~spent & ~F.col("is_resolved")})


def retried(log: DataFrame, ids: DataFrame, ord: Column, at: Column, resolved: bool = True) -> DataFrame:
    """State rows to append for ids that were tried once more."""
    current = state(log).join(ids.select("id"), "id", "left_semi")
    return current.withColumns(
        {"retry_count": F.col("retry_count") + 1, "is_resolved": F.lit(resolved), "last_retry_at": at, "resolved_at": at if resolved else F.col("resolved_at"), "ord": ord}
    ).select(*DLQ_LOG.names)


def unresolved(entries: DataFrame, limit: int | None = None) -> DataFrame:
    rows = entries.where("not is_resolved").orderBy(F.desc("failed_at"), "id")
    return rows if limit is None else rows.limit(limit)


def by_category(entries: DataFrame, category: str, limit: int | None = None) -> DataFrame:
    return unresolved(entries.where(F.col("error_category") == category), limit)


def by_slots(entries: DataFrame, slots: list[int], limit: int | None = None) -> DataFrame:
    """Unresolved entries of the slots; the limit applies to these, not before."""
    return unresolved(entries.where(F.col("slot").isin(slots)), limit)


def by_ids(entries: DataFrame, ids: list[str]) -> DataFrame:
    return unresolved(entries.where(F.col("id").isin(ids)))


def category_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("error_category").agg(F.count(F.lit(1)).alias("entries"), F.count_if(~F.col("is_resolved")).alias("unresolved"))


def to_raw(entries: DataFrame, first_arrival: int) -> DataFrame:
    """Raw events of origin replay, which skip sequencing but not fork detection, in order of failure."""
    from .prefix import numbered

    rows = entries.withColumn("__o", F.col("sequence"))
    return numbered(rows, "__o", "arrival", first_arrival).select("arrival", F.col("sequence").alias("source_seq"), F.lit("replay").alias("origin"), "kind", "slot", "parent_slot", F.col("raw_payload").alias("payload"), F.col("received_at"))


def replay(log: DataFrame, chosen: DataFrame, first_arrival: int, at: Column) -> tuple[DataFrame, DataFrame]:
    """(raw events, log rows): chosen entries that may be retried go back to the pipeline and are resolved; one that fails again is a new entry."""
    may = chosen.where("can_retry")
    return to_raw(may, first_arrival), retried(log, may, F.lit(first_arrival * 4).cast("long"), at)


def replay_summary(results: DataFrame) -> DataFrame:
    """One row over (id, ok): totals and the success rate, 1.0 where nothing was tried."""
    good = F.count_if(F.col("ok"))
    return results.agg(F.count(F.lit(1)).alias("attempted"), good.alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"), F.coalesce(good / F.nullif(F.count(F.lit(1)), F.lit(0)), F.lit(1.0)).alias("success_rate"))


def purged(entries: DataFrame, days: int, now: Column) -> DataFrame:
    """Entries that stay when those resolved more than `days` days ago go."""
    old = F.col("is_resolved") & (F.col("resolved_at") < now - F.make_dt_interval(F.lit(days)))
    return entries.where(~F.coalesce(old, F.lit(False)))
