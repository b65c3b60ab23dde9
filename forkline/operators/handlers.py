"""Event handlers: checks over columns that are routed by kind."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Handler:
    """accepts is a condition; an event of a handled kind for which it isn't true is rejected. No kinds means all."""

    name: str
    kinds: tuple[str, ...]
    accepts: Column


def logging_handler(name: str = "logging") -> Handler:
    """Takes events of all kinds and refuses none."""
    return Handler(name, (), F.lit(True))


def kind_counts(events: DataFrame) -> DataFrame:
    """What a metrics handler counts: events of each kind, a row per kind."""
    return events.groupBy("kind").agg(F.count(F.lit(1)).alias("events"))


@dataclass
class Registry:
    handlers: list[Handler] = field(default_factory=list)

    def register(self, handler: Handler) -> None:
        self.handlers.append(handler)

    def split(self, events: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(accepted, rejected): rejected rows name the first handler that refused them, and keep their original payload."""
        refused = [F.when((F.col("kind").isin(*h.kinds) if h.kinds else F.lit(True)) & ~F.coalesce(h.accepts, F.lit(False)), h.name) for h in self.handlers]
        marked = events.withColumn("rejected_by", F.coalesce(*refused, F.lit(None).cast("string")))
        return marked.where("rejected_by is null").drop("rejected_by"), marked.where("rejected_by is not null")
