"""Sharding by longest-processing-time scheduling: groups stay together, the largest go first to the least loaded shard."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

#: Bytes that each row costs besides its text.
ROW_BYTES = 8
#: Rows numbered in one task at most, about.
ROWS_PER_PIECE = 50_000
#: A group with more than this share of all rows is hot; there are fewer such groups than its inverse.
HOT = 4096


class Schedule:
    """The loads of some shards in a heap, which groups of falling size are dealt to."""

    def __init__(self, shards: int):
        self.heap = [(0, s) for s in range(shards)]

    def take(self, size: int, n: int) -> dict[int, int]:
        """Deal n groups of one size, each to the least loaded shard (ties to the lowest): {shard: groups}, by rising shard.

        Groups of one size are alike, so whole rounds are dealt at once: a shard's k-th group comes at load + k * size,
        which orders groups by level (load // size + k), then by remainder and shard. All levels that fit into n are
        filled at once, and the few groups left go through the heap one by one.
        """
        dealt: dict[int, int] = {}
        if n > 2 * len(self.heap):
            levels = [load // size for load, _ in self.heap]
            low, high = min(levels), min(levels) + n
            while low < high:
                mid = (low + high + 1) // 2
                if sum(mid - x for x in levels if x < mid) <= n:
                    low = mid
                else:
                    high = mid - 1
            given = [max(0, low - x) for x in levels]
            dealt = {s: g for (_, s), g in zip(self.heap, given, strict=True) if g}
            self.heap = [(load + g * size, s) for (load, s), g in zip(self.heap, given, strict=True)]
            heapq.heapify(self.heap)
            n -= sum(given)
        for _ in range(n):
            load, s = self.heap[0]
            heapq.heapreplace(self.heap, (load + size, s))
            dealt[s] = dealt.get(s, 0) + 1
        return dict(sorted(dealt.items()))


def schedule(classes: DataFrame, shards: int) -> DataFrame:
    """Schedule size classes (size, n): per size, the shards that take groups of it, and each one's first rank among them.

    A schedule is sequential, so the classes stream through one sorted task, which holds the heap alone. Different
    sizes that add up to a total are at most sqrt(2 * total) many: 14 million for 100 TB, in the worst case.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Schedule(shards)
        for batch in batches:
            first, own = [], []
            for size, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, starts = 0, []
                dealt = plan.take(size, n)
                for k in dealt.values():
                    starts.append(at)
                    at += k
                first.append(starts)
                own.append(list(dealt))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.list_(pa.int64())), pa.array(own, pa.list_(pa.int32()))], names=["size", "first", "own"])

    return classes.select("size", "n").repartition(1).sortWithinPartitions(F.desc("size")).mapInArrow(run, "size long, first array<long>, own array<int>")


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal rows to shards of nearly equal bytes; rows with equal texts share a shard.

    A group is a 64-bit hash of the text: equal texts always meet, and two texts that collide only
    stay together as well. Every group is scheduled, by falling size (ties by the hash, so that
    shards take ranges of a size's groups). Groups of one size are counted and dealt as a number,
    then ranked inside buckets of the hash, and each rank finds its shard; so no task holds all groups of a size.
    The fewer than 4096 groups with over 1/4096 of the rows are broadcast to their rows, all others are joined.

    Returns id, size (UTF-8 bytes + 8), text_crc32, shard, slot. Slots number a shard's rows without
    gaps, ordered by a hash piece of the id and then by the id. Null texts have no bytes and form one
    group with empty texts; null ids are numbered like others; repeated rows each get a slot; an empty
    table gives no rows. Other columns are not read.
    """
    spark, t = docs.sparkSession, F.coalesce(F.col(text_col), F.lit(""))
    scratch = Scratch(spark, "shard")
    rows = scratch.save(
        docs.select(F.col(id_col), (F.octet_length(t) + ROW_BYTES).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"), F.xxhash64(t).alias("group")),
        "rows",
    )
    n = rows.count()
    groups = scratch.save(rows.groupBy("group").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("copies")), "groups")
    deals = scratch.save(schedule(groups.groupBy("size").agg(F.count(F.lit(1)).alias("n")), shards), "deals")

    buckets = groups.count() // ROWS_PER_PIECE + 1
    dealt_in = groups.withColumn("bucket", F.pmod("group", F.lit(buckets)))
    spots = _starts(dealt_in, "size", "bucket").join(deals, "size")
    rank = F.row_number().over(W.partitionBy("size", "bucket").orderBy("group")) - 1
    place = F.size(F.filter("first", lambda x: x <= F.col("start") + F.col("rank")))
    placed = scratch.save(dealt_in.withColumn("rank", rank).join(spots, ["size", "bucket"]).select("group", "copies", F.element_at("own", place).alias("shard")), "placed")

    hot = F.broadcast(placed.where(F.col("copies") * HOT > n).select("group", "shard"))
    others = placed.where(F.col("copies") * HOT <= n).select("group", "shard")
    pieces = max(1, n // (shards * ROWS_PER_PIECE) + 1, min(16, n // 2000 + 1))
    piece = F.pmod(F.xxhash64(F.col(id_col)), F.lit(pieces)).cast("int").alias("piece")
    both = rows.join(hot, "group").unionByName(rows.join(hot, "group", "left_anti").join(others, "group"))
    dealt = scratch.save(both.select(F.col(id_col), "size", "text_crc32", "shard", piece), "dealt")
    scratch.drop("rows", "groups", "deals", "placed")

    order = W.partitionBy("shard", "piece").orderBy(F.col(id_col), "text_crc32", "size")
    return dealt.withColumn("at", F.row_number().over(order)).join(_starts(dealt, "shard", "piece"), ["shard", "piece"]).select(F.col(id_col), "size", "text_crc32", "shard", (F.col("start") + F.col("at") - 1).cast("long").alias("slot"))


def _starts(df: DataFrame, key: str, part: str) -> DataFrame:
    """(key, part, start): the rows that a key's earlier parts hold."""
    per = df.groupBy(key, part).count()
    return per.select(key, part, (F.sum("count").over(W.partitionBy(key).orderBy(part)) - F.col("count")).alias("start"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 under the law `bytes`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_documents(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
