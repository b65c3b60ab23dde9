"""Backfill: ranges to fetch, slots that are missing, and events made from archived blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import backfill_sequence

#: Priorities, lower first, and the widest span that a sequence gap is taken for.
NORMAL, GAP_FILL, GAP_SPAN = 10, 1, 1000
RANGE = "start_slot long, end_slot long, priority int, is_gap_fill boolean"


def ranges(spark: SparkSession, items: list[tuple[int, int, bool]]) -> DataFrame:
    """A queue of (start, end, is_gap_fill); empty ranges are never queued."""
    return spark.createDataFrame([(a, b, GAP_FILL if gap else NORMAL, gap) for a, b, gap in items if a <= b], RANGE)


def queue(found: DataFrame) -> DataFrame:
    """Ranges in the order in which they run, with their lengths."""
    return found.where("start_slot <= end_slot").withColumn("slots", F.col("end_slot") - F.col("start_slot") + 1).orderBy("priority", "start_slot")


def gaps_to_ranges(gaps: DataFrame, slot_hint: Column) -> DataFrame:
    """Slot ranges that sequence gaps may stand for: as many slots below the hint as numbers are missing, 1000 at most."""
    span = F.least(F.col("gap_end") - F.col("gap_start") + 1, F.lit(GAP_SPAN))
    return gaps.select(F.greatest(slot_hint - span, F.lit(0)).cast("long").alias("start_slot"), slot_hint.cast("long").alias("end_slot"), F.lit(GAP_FILL).alias("priority"), F.lit(True).alias("is_gap_fill"))


def candidates(archive: DataFrame, wanted: DataFrame, valid_events: DataFrame) -> DataFrame:
    """Blocks of the archive in wanted ranges whose slots hold no valid event.

    Ranges become slots, so that both joins are equi-joins; slots without a block are normal and give nothing.
    """
    slots = wanted.select(F.explode(F.sequence("start_slot", "end_slot")).alias("slot")).distinct()
    return archive.join(slots, "slot", "left_semi").join(valid_events.select("slot").distinct(), "slot", "left_anti")


def explode_blocks(blocks: DataFrame) -> DataFrame:
    """One row per transaction: place in the block, first signature, success, fee, compute units and message."""
    t = F.col("t.transaction")
    each = blocks.select("slot", F.col("parentSlot").alias("parent_slot"), "blockTime", F.posexplode("transactions").alias("index", "t"))
    return each.select(
        "slot",
        "parent_slot",
        "index",
        F.get(t["signatures"], F.lit(0)).alias("signature"),
        F.col("t.meta.err").isNull().alias("success"),
        F.coalesce("t.meta.fee", F.lit(0)).cast("long").alias("fee"),
        F.col("t.meta.computeUnitsConsumed").alias("compute_units"),
        t["message"].alias("message"),
        F.timestamp_seconds("blockTime").alias("block_time"),
    )


def to_raw(transactions: DataFrame, first_arrival: int) -> DataFrame:
    """Raw events of origin backfill: they skip sequencing and fork detection, and are numbered by slot and place."""
    from .prefix import numbered

    body = F.to_json(F.struct("signature", "index", "success", "fee", "compute_units", F.try_parse_json("message").alias("message")), {"ignoreNullFields": "false"})
    rows = transactions.withColumn("source_seq", backfill_sequence(F.col("slot"), F.col("index")))
    return numbered(rows, "source_seq", "arrival", first_arrival, width=1 << 28).select(
        "arrival", "source_seq", F.lit("backfill").alias("origin"), F.lit("Transaction").alias("kind"), "slot", "parent_slot", body.cast("binary").alias("payload"), F.coalesce("block_time", F.lit(0).cast("timestamp")).alias("received_at")
    )


def progress(current: Column, target: Column) -> Column:
    """Share of the target reached, from 0 to 1; 0 without a target."""
    return F.when(current.isNotNull() & (target > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), current / target))).otherwise(F.lit(0.0))
