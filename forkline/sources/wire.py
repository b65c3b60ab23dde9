"""The wire form of events, and what a subscription serves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import kind_ordinal
from ..schemas import KINDS


def decode(wire: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(raw events, invalid rows): a kind outside the list, or a negative number, is an invalid message."""
    names = F.array(*map(F.lit, KINDS))
    kind = F.get(names, F.col("kind").cast("int"))
    fine = F.coalesce(kind.isNotNull() & (F.col("sequence") >= 0) & (F.col("slot") >= 0) & F.coalesce(F.col("parent_slot") >= 0, F.lit(True)), F.lit(False))
    good = wire.where(fine).select(F.col("sequence").alias("arrival"), F.col("sequence").alias("source_seq"), F.lit("live").alias("origin"), kind.alias("kind"), "slot", "parent_slot", "payload", F.timestamp_millis("received_at_ms").alias("received_at"))
    return good, wire.where(~fine)


def encode(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("source_seq").alias("sequence"), kind_ordinal(F.col("kind")).cast("int").alias("kind"), "slot", "parent_slot", "payload", F.unix_millis("received_at").alias("received_at_ms"))


def subscribe(events: DataFrame, after: int = 0, kinds: list[str] | None = None) -> DataFrame:
    """Events numbered beyond `after`, of the kinds asked for; no kinds means all."""
    rows = events.where(F.col("source_seq") > after)
    return rows.where(F.col("kind").isin(kinds)) if kinds else rows


def status(events: DataFrame) -> DataFrame:
    return events.agg(F.max("source_seq").alias("last_sequence"), F.max("slot").alias("max_slot"))
