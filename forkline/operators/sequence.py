"""Sequence analysis: classify arrivals against the running maximum, list gaps, accept, number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import WIDTH, numbered, running_max_before


def classify(events: DataFrame, last_seen: int | None = None, width: int = WIDTH) -> DataFrame:
    """Append seen (the largest number before), outcome, gap_start and gap_end.

    The first is processed, the last one's equal a duplicate, a smaller one a regression, the next processed, and a
    larger one a gap. Regressions never advance, so the last accepted number is the running maximum.
    """
    rows = running_max_before(events, "arrival", "source_seq", "seen", width)
    if last_seen is not None:
        rows = rows.withColumn("seen", F.greatest("seen", F.lit(last_seen)))
    n, seen = F.col("source_seq"), F.col("seen")
    outcome = F.when(seen.isNull() | (n == seen + 1), "processed").when(n == seen, "duplicate").when(n < seen, "regression").otherwise("gap")
    gap = outcome == "gap"
    return rows.withColumns({"outcome": outcome, "gap_start": F.when(gap, seen + 1), "gap_end": F.when(gap, n - 1)})


def accept(events: DataFrame, last_seen: int | None = None, width: int = WIDTH) -> DataFrame:
    """Rows that go on: live ones beyond the running maximum of live ones, and all others, which have no sequence."""
    live = classify(events.where("origin = 'live'"), last_seen, width).where("outcome in ('processed', 'gap')").select(*events.columns)
    return live.unionByName(events.where("origin != 'live'"))


def gaps(classified: DataFrame) -> DataFrame:
    return classified.where("outcome = 'gap'").select("gap_start", "gap_end", (F.col("gap_end") - F.col("gap_start") + 1).alias("missing"))


def gaps_after_fill(found: DataFrame, start: int, end: int) -> DataFrame:
    """Gaps that a filled range doesn't hold wholly."""
    return found.where(~((F.col("gap_start") >= start) & (F.col("gap_end") <= end)))


def expand(found: DataFrame) -> DataFrame:
    return found.select(F.explode(F.sequence("gap_start", "gap_end")).alias("source_seq"))


def assign(events: DataFrame, start: int = 1, width: int = WIDTH) -> DataFrame:
    """Append seq: contiguous numbers in order of arrival."""
    return numbered(events, "arrival", "seq", start, width)


def statistics(classified: DataFrame) -> DataFrame:
    """One row: counts by outcome, gaps and missing numbers, and the last number."""
    hits = lambda *o: F.count_if(F.col("outcome").isin(*o))
    return classified.agg(
        hits("processed", "gap").alias("processed"),
        hits("duplicate").alias("duplicates"),
        hits("regression").alias("regressions"),
        hits("gap").alias("gaps"),
        F.coalesce(F.sum(F.col("gap_end") - F.col("gap_start") + 1), F.lit(0)).alias("missing"),
        F.max("source_seq").alias("last_sequence"),
    )


def shed(events: DataFrame, capacity: int, policy: str, order: Column | str = "arrival", per_tick: int = 1) -> DataFrame:
    """Append kept: what a bounded buffer keeps of each tick's burst, for a consumer that drains per_tick of `capacity` a tick.

    tick is a column; block keeps all, both drop policies drop what comes when the tick's room is used, as a
    channel that can't be popped by its producer sheds the newest either way. The model is deterministic: room is capacity a tick.
    """
    from pyspark.sql import Window as W

    if policy == "block":
        return events.withColumn("kept", F.lit(True))
    return events.withColumn("kept", F.row_number().over(W.partitionBy("tick").orderBy(order)) <= capacity * per_tick)
