"""Fork detection over a DataFrame: run compression, the tracker, and the logs that its decisions give."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .prefix import bucketed
from .tracker import DUPLICATE, EXTENDED, GAP_JOIN, IGNORED, INITIALISED, MAX_DEPTH, MAX_SLOTS, REORG, ChainTracker

#: Order of what one arrival commits: rollback, then its slot, then its event.
STEPS = 4
ROLLBACK_STEP, SLOT_STEP, EVENT_STEP = 0, 1, 2
#: Outcomes that write a slot row.
PLACED = (INITIALISED, EXTENDED, REORG, GAP_JOIN)
STATE = "state"

DECISION = T.StructType(
    [
        T.StructField("arrival", T.LongType()),
        T.StructField("slot", T.LongType()),
        T.StructField("parent_slot", T.LongType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("head_before", T.LongType()),
        T.StructField("head_after", T.LongType()),
        T.StructField("divergence", T.LongType()),
        T.StructField("is_bound", T.BooleanType()),
        T.StructField("orphaned", T.ArrayType(T.LongType())),
        T.StructField("restored", T.ArrayType(T.LongType())),
        T.StructField("slots_tracked", T.LongType()),
        T.StructField("slots_pruned", T.LongType()),
        T.StructField("canonical_len", T.LongType()),
        T.StructField("tracker", T.StringType()),
    ]
)


def slot_runs(events: DataFrame) -> DataFrame:
    """One row per run of events that name the same slot and parent, without events that bypass fork detection.

    A column `status`, where there is one, is passed on; live sources have none, and all slots are Processing.

    Runs are found inside buckets of the arrival order; a run that crosses a bucket's end gives a second row, which
    track() passes over.
    """
    seen = events.where(F.col("parent_slot").isNotNull() & (F.col("origin") != "backfill"))
    status = F.col("status") if "status" in events.columns else F.lit("Processing")
    w = W.partitionBy("__bucket").orderBy("arrival")
    here = F.struct("slot", "parent_slot", "status")
    return bucketed(seen.select("arrival", "slot", "parent_slot", "received_at", status.alias("status")), "arrival").withColumn("__before", F.lag(here).over(w)).where(~F.col("__before").eqNullSafe(here)).select("arrival", "slot", "parent_slot", F.col("received_at").alias("at"), "status")


def track(runs: DataFrame, max_slots: int = MAX_SLOTS, max_depth: int = MAX_DEPTH, legacy_depth: bool = False, state: str | None = None, with_state: bool = False) -> DataFrame:
    """A decision per run, in order of arrival; with_state adds a last row whose outcome is STATE and whose tracker resumes the run.

    A chain is sequential, so its runs stream through one sorted partition; memory is the tracker's window, never the runs.
    Work before (parsing, hashing, compression) and after (folds) stays distributed.
    """
    arrow = to_arrow_schema(DECISION)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tracker = ChainTracker.load(state, max_slots=max_slots, max_depth=max_depth, legacy_depth=legacy_depth)
        before = None
        for batch in batches:
            rows, new = [], []
            for k, here in enumerate(zip(*(batch.column(i).to_pylist() for i in (1, 2, 4)), strict=True)):
                if here == before:  # a run that goes on in the next bucket
                    continue
                before = here
                new.append(k)
                d = tracker.observe(here[0], here[1], status=here[2])
                rows.append((d.outcome, d.head_before, d.head_after, d.divergence, d.is_bound, d.orphaned, d.restored, len(tracker.known), tracker.pruned, len(tracker.canonical), None))
            if rows:
                made = [pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), list(arrow)[4:], strict=True)]
                kept = batch.take(pa.array(new))
                yield pa.RecordBatch.from_arrays([*kept.columns[:4], *made], names=arrow.names)
        if with_state:
            end = {"outcome": STATE, "tracker": tracker.dump()}
            yield pa.RecordBatch.from_arrays([pa.array([end.get(f.name)], f.type) for f in arrow], names=arrow.names)

    return runs.select("arrival", "slot", "parent_slot", "at", "status").repartition(1).sortWithinPartitions("arrival").mapInArrow(run, DECISION)


def slot_log(decisions: DataFrame, backfilled: DataFrame | None = None) -> DataFrame:
    """Slot rows in commit order: for placed slots, and for backfilled ones, which skip detection."""
    placed = decisions.where(F.col("outcome").isin(*PLACED)).select("slot", "parent_slot", "at", "arrival")
    if backfilled is not None:
        w = W.partitionBy("slot", "parent_slot").orderBy("arrival")
        first = backfilled.where("origin = 'backfill' and parent_slot is not null").withColumn("__n", F.row_number().over(w)).where("__n = 1")
        placed = placed.unionByName(first.select("slot", "parent_slot", F.col("received_at").alias("at"), "arrival"))
    return placed.select(
        "slot", "parent_slot", F.lit("Processing").alias("status"), F.lit(None).cast("string").alias("block_hash"), F.lit(None).cast("timestamp").alias("block_time"), F.lit(0).alias("transaction_count"), F.col("at").alias("received_at"), (F.col("arrival") * STEPS + SLOT_STEP).alias("ord")
    )


def reorg_log(decisions: DataFrame) -> DataFrame:
    """Audit rows: decisions that orphaned or restored something. Ids are made from the content, so a repeated run gives the same ones."""
    return decisions.where(F.col("outcome") == REORG).select(
        F.sha2(F.concat_ws(":", "slot", "parent_slot", "arrival"), 256).substr(1, 32).alias("id"),
        F.col("slot").alias("fork_slot"),
        F.col("head_before").alias("old_head"),
        "parent_slot",
        F.col("divergence").alias("divergence_point"),
        F.size("orphaned").alias("depth"),
        F.col("orphaned").alias("slots_rolled_back"),
        F.col("restored").alias("slots_restored"),
        F.col("is_bound").alias("divergence_is_bound"),
        (F.col("arrival") * STEPS + ROLLBACK_STEP).alias("ord"),
        F.col("at").alias("detected_at"),
    )


def action_log(reorgs: DataFrame) -> DataFrame:
    """(slot, action, ord, at): I for each slot that a reorg rolled back, R for each it restored."""
    of = lambda c, a: reorgs.select(F.explode(c).alias("slot"), F.lit(a).alias("action"), "ord", F.col("detected_at").alias("at"))
    return of("slots_rolled_back", "I").unionByName(of("slots_restored", "R"))


def ignored_or_duplicate(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("outcome").isin(IGNORED, DUPLICATE))
