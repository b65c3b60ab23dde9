"""The whole batch pipeline: accept, parse, fork detection, numbering, logs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import event_hash
from ..session import checkpointed
from . import chain, dlq, fold, sequence
from .handlers import Registry
from .prefix import WIDTH
from .tracker import MAX_DEPTH, MAX_SLOTS


def envelope(body: Column) -> Column:
    """The stored form of an event: its place in the stream, and its payload as body."""
    return F.to_json(F.struct("kind", "slot", "parent_slot", "source_seq", F.try_parse_json(body).alias("body")))


def extracted(data: Column) -> dict[str, Column]:
    """Columns that reads filter on, taken out of the payload once."""
    v = F.try_parse_json(data)
    return {
        "signature": F.try_variant_get(v, "$.signature", "string"),
        "pubkey": F.try_variant_get(v, "$.pubkey", "string"),
        "account_keys": F.try_variant_get(v, "$.message.accountKeys", "array<string>"),
    }


@dataclass
class Indexed:
    """DataFrames of a run; lazy, so a query pays for what it reads."""

    accepted: DataFrame
    bad: DataFrame | None
    decisions: DataFrame
    event_log: DataFrame
    slot_log: DataFrame
    reorgs: DataFrame
    actions: DataFrame
    legacy: bool = False
    refused: DataFrame | None = None

    @property
    def events(self) -> DataFrame:
        return fold.events_current(self.event_log, self.actions, self.legacy)

    @property
    def slots(self) -> DataFrame:
        return fold.slots_current(self.slot_log, self.actions)

    @property
    def audit(self) -> DataFrame:
        return fold.rollback_counts(self.event_log, self.actions, self.reorgs, self.legacy)


def _without_refused(good: DataFrame, decisions: DataFrame, legacy: bool) -> DataFrame:
    """Events that are written: none of a refused run; in legacy mode, all but its first.

    A pair of slot and parent that was refused may be accepted when it comes again, so the last decision before an event counts.
    """
    refused = F.col("outcome").isin("rooted_refusal", "depth_refusal")
    if legacy:
        return good.join(decisions.where(refused).select("arrival"), "arrival", "left_anti")
    pair = ["slot", "parent_slot"]
    history = decisions.select(*pair, "arrival", refused.alias("refused")).groupBy(*pair).agg(F.sort_array(F.collect_list(F.struct("arrival", "refused"))).alias("__history"), F.max("refused").alias("__any")).where("__any").drop("__any")
    last = F.try_element_at(F.filter("__history", lambda x: x["arrival"] <= F.col("arrival")), F.lit(-1))
    return good.join(history, pair, "left").where(~F.coalesce(last["refused"], F.lit(False))).select(*good.columns)


def index(
    raw: DataFrame, *, check_json: bool = False, last_seen: int | None = None, first_seq: int = 1, max_slots: int = MAX_SLOTS, max_depth: int = MAX_DEPTH, legacy: bool = False, json_columns: bool = False, state: str | None = None, width: int = WIDTH, keep: Callable[[DataFrame, str], DataFrame] | None = None, with_state: bool = False, handlers: Registry | None = None
) -> Indexed:
    """Run raw events through the pipeline: parse, chain, number, handlers, logs.

    handlers see numbered events; what one rejects goes to `refused` and is not logged, though its number is spent and its slot was seen.
    check_json sends payloads that aren't one JSON document to `bad` before fork detection, so a slot of such events alone is never seen.
    keep(df, name) may store the accepted rows, the good ones and the decisions, which several logs are made from; without it, decisions
    are checkpointed, so that the tracker runs once. with_state adds the tracker's last state to the decisions. legacy repeats two known defects: a restore brings back every row of a slot, and a too deep rollback is refused after the tracker switched.
    """
    raw.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # of repeated keys the last counts, whatever made the session
    stored = keep or (lambda df, name: checkpointed(df) if name == "decisions" else df)
    accepted = stored(sequence.accept(raw, last_seen, width), "accepted")
    good, bad = dlq.split(accepted) if check_json else (accepted, None)
    if check_json:
        good = stored(good, "good")
    decisions = stored(chain.track(chain.slot_runs(good), max_slots, max_depth, legacy, state, with_state=with_state), "decisions")
    written = _without_refused(good, decisions, legacy)
    payload = F.col("payload").cast("string")
    numbered = sequence.assign(written, first_seq, width)
    refused = None
    if handlers is not None:
        numbered, refused = handlers.split(stored(numbered, "numbered"))
    log = numbered.select(
        "slot",
        "source_seq",
        "seq",
        "origin",
        "kind",
        "received_at",
        "parent_slot",
        payload.alias("data"),
        event_hash(F.col("slot"), F.col("source_seq"), F.col("kind"), F.col("payload")).alias("event_hash"),
        (F.col("arrival") * chain.STEPS + chain.EVENT_STEP).alias("ord"),
        F.col("received_at").alias("at"),
    )
    if json_columns:
        log = log.withColumns(extracted(F.col("data")))
    reorgs = chain.reorg_log(decisions)
    return Indexed(accepted, bad, decisions, log, chain.slot_log(decisions, good), reorgs, chain.action_log(reorgs), legacy, refused)
