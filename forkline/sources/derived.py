"""A chain derived from the driver's events table: numbers, slots, forks, withheld and malformed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Events in a slot, slots from one fork to the next, fork depths in turn, and which rows are withheld or malformed.
EVENTS_PER_SLOT, FORK_EVERY, DEPTHS, WITHHELD, MALFORMED = 4, 50, 5, 101, 97
KIND_OF = {"click": "Transaction", "purchase": "AccountUpdate", "view": "Entry", "signup": "BlockMeta", "error": "SlotUpdate"}


def micros(column: str = "ts") -> Column:
    """Microseconds since 1970 of a time without zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({column} as timestamp_ntz))")


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row as a raw event, with the flags withheld and malformed, and user_id."""
    kind = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in KIND_OF.items()])
    i = F.expr(f"event_id div {EVENTS_PER_SLOT}")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "props", F.timestamp_micros(micros()).alias("received_at"), kind.alias("kind"), i.alias("i"))
    depth = 1 + F.expr(f"i div {FORK_EVERY}") % DEPTHS
    slot = F.col("i") + 1
    bad = F.col("event_id") % MALFORMED == 0
    return rows.select(
        (F.col("event_id") + 1).alias("arrival"),
        (F.col("event_id") + 1).alias("source_seq"),
        F.lit("live").alias("origin"),
        "kind",
        slot.alias("slot"),
        F.when(F.col("i") % FORK_EVERY == FORK_EVERY - 1, slot - 1 - depth).otherwise(slot - 1).alias("parent_slot"),
        F.col("props").cast("binary").alias("payload"),
        "received_at",
        "user_id",
        (F.col("event_id") % WITHHELD == WITHHELD - 1).alias("withheld"),
        bad.alias("malformed"),
    )


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the source yields: all but withheld rows."""
    return all_events(spark, sf_dir).where("not withheld").drop("withheld", "malformed")


def malformed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream with malformed payloads in place."""
    rows = all_events(spark, sf_dir).where("not withheld")
    return rows.withColumn("payload", F.when(F.col("malformed"), F.lit("{ bad").cast("binary")).otherwise(F.col("payload"))).drop("withheld", "malformed", "user_id")


def with_json_body(events: DataFrame) -> DataFrame:
    """Payloads that name a signature and account keys, as transactions have them."""
    body = F.to_json(F.struct(F.concat(F.lit("sig-"), F.col("arrival") - 1).alias("signature"), F.struct(F.array(F.concat(F.lit("acct-"), F.col("user_id")), F.lit("acct-shared")).alias("accountKeys")).alias("message")))
    return events.withColumn("payload", body.cast("binary"))
