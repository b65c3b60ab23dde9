"""Scripted chains: runs of slots with events, in the order in which they are emitted."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefix import running_sum_before


@dataclass
class ChainScript:
    """Slots (slot, parent, events, branch) in emission order."""

    steps: list[tuple[int, int, int, str]] = field(default_factory=list)

    def extend(self, first: int, count: int, events: int, branch: str = "a") -> ChainScript:
        """`count` slots from `first`, each on the one before."""
        return self.fork(first, first - 1, count, events, branch)

    def fork(self, first: int, parent: int, count: int, events: int, branch: str = "b") -> ChainScript:
        """The same run, whose first slot names `parent`."""
        for k in range(count):
            self.steps.append((first + k, parent if not k else first + k - 1, events, branch))
        return self

    def canonical(self) -> set[int]:
        """Slots of the last emission's ancestry: a parent walk that knows nothing of the tracker."""
        parents = {}
        for slot, parent, _, _ in self.steps:
            parents[slot] = parent
        out, at = set(), self.steps[-1][0] if self.steps else None
        while at in parents and at not in out:
            out.add(at)
            at = parents[at]
        return out

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, *s) for i, s in enumerate(self.steps)] or [(None,) * 5], "step long, slot long, parent_slot long, events long, branch string").where("step is not null")

    def events(self, spark: SparkSession, first_seq: int = 1, first_arrival: int = 1) -> DataFrame:
        return emit(self.to_frame(spark), first_seq, first_arrival)


def sized(slots: int = 40, events: int = 4, reorg_depth: int = 5) -> ChainScript:
    """A straight run of slots from 1, then a branch that leaves it reorg_depth slots below the head and grows two slots beyond it; depth 0 has none."""
    script = ChainScript().extend(1, slots, events)
    return script.fork(slots + 1, max(0, slots - reorg_depth), reorg_depth + 2, events) if reorg_depth else script


def from_env(env: Mapping[str, str] | None = None) -> ChainScript:
    """sized() by SCRIPT_SLOTS, SCRIPT_EVENTS_PER_SLOT and SCRIPT_REORG_DEPTH; what is no whole number counts as unset."""
    env = os.environ if env is None else env

    def size(name: str, default: int) -> int:
        value = env.get(name, "").strip()
        return int(value) if re.fullmatch(r"\d+", value) else default

    return sized(size("SCRIPT_SLOTS", 40), size("SCRIPT_EVENTS_PER_SLOT", 4), size("SCRIPT_REORG_DEPTH", 5))


def emit(script: DataFrame, first_seq: int = 1, first_arrival: int = 1) -> DataFrame:
    """Raw events of a script: as many per slot as it says, numbered on from first_seq."""
    rows = running_sum_before(script, "step", "events", "__before").where("events > 0").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("events") - 1)))
    n = F.col("__before") + F.col("k")
    keys = F.struct(F.array(F.concat(F.lit("acct-"), F.col("branch")), F.lit("acct-shared")).alias("accountKeys"))
    payload = F.to_json(F.struct(F.concat(F.lit("slot"), "slot", F.lit("-ev"), "k").alias("label"), F.concat_ws("-", F.lit("sig"), "branch", "slot", "k").alias("signature"), keys.alias("message")))
    return rows.select(
        (n + first_arrival).alias("arrival"), (n + first_seq).alias("source_seq"), F.lit("live").alias("origin"), F.lit("Transaction").alias("kind"), "slot", "parent_slot", payload.cast("binary").alias("payload"), F.timestamp_millis((n + first_arrival) * 1000).alias("received_at")
    )


def unknown_parents(script: DataFrame) -> DataFrame:
    """Slots, other than the first, whose parent no slot of the script is; none means it is contiguous."""
    known = script.select(F.col("slot").alias("parent_slot")).distinct()
    return script.where("step > 0").join(known, "parent_slot", "left_anti").select("slot", "parent_slot")


def canonical_events(events: DataFrame, canonical: DataFrame) -> DataFrame:
    """Of each canonical slot, the events of its last emission: those that name the parent which the slot had last."""
    last = events.groupBy("slot").agg(F.max_by("parent_slot", "arrival").alias("__parent"))
    return events.join(last, "slot").where(F.col("parent_slot").eqNullSafe(F.col("__parent"))).drop("__parent").join(canonical.select("slot").distinct(), "slot", "left_semi")
