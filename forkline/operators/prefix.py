"""Ordered scans in two phases: windows inside buckets of the order, and one row a bucket carried across them.

A window over a whole table would meet in one task. Here the order column is cut into buckets of fixed width, so a task
sorts a bucket. One row per bucket is left, and those are scanned in the same way inside spans of bucket numbers: however
sparse 64-bit orders are, with the usual width a span holds at most 2^24 buckets, and the only global window 2^24 spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Numbers of the order column in a bucket.
WIDTH = 65_536
#: Bucket numbers in a span.
SPAN = 1 << 24
_B, _S = "__bucket", "__span"


def bucketed(df: DataFrame, order: str, width: int = WIDTH) -> DataFrame:
    return df.withColumn(_B, F.expr(f"{order} div {width}"))


def _carried(df: DataFrame, value: Column, combine, merge, descending: bool = False) -> DataFrame:
    """(bucket, carry): what all buckets before hold, by combine over rows; merge(a, b) joins two carries, of which either may be null."""
    by = F.desc if descending else F.asc
    before = lambda window: window.rowsBetween(W.unboundedPreceding, -1)
    per = df.groupBy(_B).agg(value.alias("__own")).withColumn(_S, F.expr(f"{_B} div {SPAN}"))
    tops = per.groupBy(_S).agg(combine("__own").alias("__all")).select(_S, combine("__all").over(before(W.orderBy(by(_S)))).alias("__top"))
    inner = per.select(_B, _S, combine("__own").over(before(W.partitionBy(_S).orderBy(by(_B)))).alias("__in"))
    return inner.join(tops, _S).select(_B, merge("__in", "__top").alias("__carry"))


def _sum(a: str, b: str) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def running_max_before(df: DataFrame, order: str, value: str, name: str, width: int = WIDTH) -> DataFrame:
    """Append the largest value of all rows with a smaller order; null for the first."""
    b = bucketed(df, order, width)
    own = F.max(value).over(W.partitionBy(_B).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    return b.join(_carried(b, F.max(value), F.max, F.greatest), _B).withColumn(name, F.greatest("__carry", own)).drop(_B, "__carry")


def smallest_after(df: DataFrame, order: str, value: str, name: str, width: int = WIDTH) -> DataFrame:
    """Append the smallest value of all rows with a larger order; null for the last."""
    b = bucketed(df, order, width)
    own = F.min(value).over(W.partitionBy(_B).orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, -1))
    return b.join(_carried(b, F.min(value), F.min, F.least, descending=True), _B).withColumn(name, F.least("__carry", own)).drop(_B, "__carry")


def numbered(df: DataFrame, order: str, name: str, start: int = 1, width: int = WIDTH) -> DataFrame:
    """Append contiguous numbers from start, by rising order."""
    b = bucketed(df, order, width)
    own = F.row_number().over(W.partitionBy(_B).orderBy(order))
    return b.join(_carried(b, F.count(F.lit(1)), F.sum, _sum), _B).withColumn(name, (own + F.col("__carry") + F.lit(start - 1)).cast("long")).drop(_B, "__carry")


def running_sum_before(df: DataFrame, order: str, value: str, name: str, width: int = WIDTH) -> DataFrame:
    """Append the sum of all rows with a smaller order; 0 for the first."""
    b = bucketed(df, order, width)
    own = F.sum(value).over(W.partitionBy(_B).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    return b.join(_carried(b, F.sum(value), F.sum, _sum), _B).withColumn(name, F.coalesce(own, F.lit(0)) + F.col("__carry")).drop(_B, "__carry")
