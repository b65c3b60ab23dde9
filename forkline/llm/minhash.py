"""Near duplicates by MinHash: an LSH forest proposes pairs, full shingle sets confirm them, components group them."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Scratch, flat_map
from .words import Words, hashed, mixed

#: Words in a shingle, and the least similarity in hundredths.
SHINGLE_WORDS, PERCENT = 5, 75
#: Sorted orders, hashes in each, and the hashes that members of a region share. A pair of
#: similarity 0.75 shares no prefix of three hashes in any of 24 orders with a chance of 2e-6.
TREES, DEPTH, LEAST_DEPTH = 24, 5, 3
#: Bits of the 128-bit sketch in which a linked pair may differ: at similarity 0.75, 16 are expected, and more than 36 have a chance of 4e-7.
FAR_BITS = 36
#: Members of a region that are compared in pairs in the second round; those of larger regions go through the prefix filter.
REGION = 32
#: Rows of a region or a shingle that are compared at once.
CHUNK = 4096
#: Shingles whose counts every worker holds, at most (8 MB).
HELD = 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)

LONGS = T.ArrayType(T.LongType())
SIGNATURE = T.StructType(
    [
        *(T.StructField(x, T.LongType()) for x in ("doc_id", "n_shingles", "key0", "key1", "s0", "s1")),
        T.StructField("p", LONGS),
        T.StructField("q", LONGS),
    ]
)
PROPOSED = T.StructType([T.StructField(x, T.LongType()) for x in ("a", "b", "far", "kind")])
SET = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("component", T.LongType()), T.StructField("shingles", T.BinaryType())])
SHINGLE_COUNT = T.StructType([T.StructField("shingle", T.LongType()), T.StructField("n", T.LongType())])
PREFIX = T.StructType([T.StructField(x, T.LongType()) for x in ("shingle", "doc_id", "component", "n", "at")])
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def shingle_sets(words: Words, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each row, the sorted 64-bit hashes of its distinct shingles; fewer words than a shingle has are one together, none are empty."""
    h = words.hash

    def rolled(k: int, lo: int, hi: int) -> np.ndarray:
        out = np.full(max(0, hi - lo - k + 1), np.uint64(k), np.uint64)
        for i in range(k):
            out = (out ^ h[lo + i : lo + i + len(out)]) * _MIX
            out ^= out >> np.uint64(29)
        return mixed(out)

    whole = rolled(size, 0, len(h))
    for lo, hi in zip(words.row[:-1].tolist(), words.row[1:].tolist(), strict=True):
        n = hi - lo
        yield np.unique(whole[lo : hi - size + 1]) if n >= size else rolled(n, lo, hi) if n else np.empty(0, np.uint64)


@functools.cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20_240_601)
    n = TREES * DEPTH
    return (r.integers(0, 2**31, n, np.uint32) * np.uint32(2) + np.uint32(1))[:, None], r.integers(0, 2**32, n, np.uint32)[:, None]


def signature_of(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set, as 32 bits."""
    a, b = _functions()
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), 2**32 - 1, np.uint32)
    for lo in range(0, len(x), 512):
        value = a * x[lo : lo + 512]
        value += b
        np.minimum(low, value.min(axis=1), out=low)
    return low


def sketches_of(signatures: np.ndarray) -> np.ndarray:
    """Rows of two 64-bit numbers: one mixed bit of each value, 128 with eight values' second bits."""
    n = signatures.shape[1]
    m = mixed(signatures.astype(np.uint64) * _MIX + np.arange(n, dtype=np.uint64))
    bits = np.concatenate((m & np.uint64(1), (m[:, : 128 - n] >> np.uint64(1)) & np.uint64(1)), axis=1).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64)


def _signatures():
    def f(batch: pa.RecordBatch) -> dict:
        sets = list(shingle_sets(hashed(batch.column(1))))
        n = np.fromiter(map(len, sets), np.int64, len(sets))
        keys = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
        sig = np.stack([signature_of(s) for s in sets])
        sketch, sig = sketches_of(sig), sig.reshape(len(sets), TREES, DEPTH).astype(np.int64)
        p = (sig[:, :, 0] & 0xFFFFF) << 40 | (sig[:, :, 1] & 0xFFFFF) << 20 | (sig[:, :, 2] & 0xFFFFF)
        q = (sig[:, :, 3] & 0x7FFFFFFF) << 32 | sig[:, :, 4]
        lists = lambda x: pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * TREES, x.ravel())
        return {"doc_id": batch.column(0), "n_shingles": n, "key0": keys[:, 0], "key1": keys[:, 1], "s0": sketch[:, 0], "s1": sketch[:, 1], "p": lists(p), "q": lists(q)}

    return f


# ---- the first round: a few near partners of each member of a region -----------------------------


def differing(s: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which sketches i and j differ."""
    s = s.view(np.uint64)  # bits of a negative number would be counted without its sign
    return np.bitwise_count(s[i, 0] ^ s[j, 0]).astype(np.int64) + np.bitwise_count(s[i, 1] ^ s[j, 1])


def fitting(n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether two sizes allow the least similarity."""
    return 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])


def middles(s: np.ndarray, first: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each row, the row of its region whose sketch is nearest to the majority of each bit. first: where regions start; of: each row's region."""
    bits = np.unpackbits(np.ascontiguousarray(s).view(np.uint8), axis=1)
    n = np.diff(first, append=len(s))
    centre = 2 * np.add.reduceat(bits, first, axis=0, dtype=np.int32) > n[:, None]
    far = (bits != centre[of]).sum(axis=1)
    return np.minimum.reduceat(far * len(s) + np.arange(len(s)), first)[of] % len(s)


def proposed(tree: np.ndarray, p: np.ndarray, ids: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a, b, far, kind) of sorted entries: a member and the one after it in its order, both ways (kind 0), and a member and its region's middle (kind 1)."""
    new = np.ones(len(ids), bool)
    new[1:] = (np.diff(tree) != 0) | (np.diff(p) != 0)
    first = np.flatnonzero(new)
    size = np.diff(first, append=len(ids))
    keep = np.repeat(size > 1, size)
    if not keep.any():
        return tuple(np.empty((4, 0), np.int64))
    ids, n, s, new = ids[keep], n[keep], s[keep], new[keep]
    first, of = np.flatnonzero(new), np.cumsum(new) - 1
    j = np.flatnonzero(~new)
    i, middle = j - 1, middles(s, first, of)
    every = np.arange(len(ids))
    a, b = np.concatenate((i, j, every)), np.concatenate((j, i, middle))
    kind = np.repeat([0, 0, 1], [len(j), len(j), len(every)])
    far = differing(s, a, b)
    good = (ids[a] != ids[b]) & fitting(n, a, b) & (far <= FAR_BITS)
    return ids[a[good]], ids[b[good]], far[good], kind[good]


def _long_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[np.ndarray]]:
    """Columns of about so many rows at a time."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += batch.num_rows
        if n >= rows:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held, n = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _proposals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(PROPOSED)
    for tree, p, ids, n, s0, s1 in _long_batches(batches, 50_000):
        found = proposed(tree, p, ids, n, np.stack((s0, s1), axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], schema=schema)


# ---- the second round: what regions hold of several components ------------------------------------


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """The other columns of several whole groups at a time, after numbers of their groups, from rows sorted by their first columns, the keys."""
    rest: list[np.ndarray] | None = None
    for columns in _long_batches(batches, 20_000):
        if rest is not None:
            columns = [np.concatenate(c) for c in zip(rest, columns, strict=True)]
        new = np.flatnonzero(functools.reduce(np.logical_or, (np.diff(c) != 0 for c in columns[:keys]))) + 1
        if not len(new):
            rest = columns
            continue
        rest = [c[new[-1] :] for c in columns]
        columns = [c[: new[-1]] for c in columns]
        of = np.zeros(new[-1], np.int64)
        of[new[:-1]] = 1
        yield [np.cumsum(of), *columns[keys:]]
    if rest is not None:
        new = functools.reduce(np.logical_or, (np.diff(c, prepend=c[:1]) != 0 for c in rest[:keys]))
        yield [np.cumsum(new), *rest[keys:]]


def _sent(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    found = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0], pa.int64()), pa.array(found[:, 1], pa.int64())], schema=to_arrow_schema(PAIR))


def _region_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of members of small regions that are in different components and that sizes and sketches don't rule out."""
    for of, ids, n, s0, s1, component in _groups(batches, 2):
        s, found = np.stack((s0, s1), axis=1), []
        for shift in range(1, min(REGION, len(ids))):
            i = np.flatnonzero((of[shift:] == of[:-shift]) & (component[shift:] != component[:-shift]))
            if not len(i) and not (of[shift:] == of[:-shift]).any():
                break
            j = i + shift
            good = fitting(n, i, j) & (differing(s, i, j) <= FAR_BITS) & (ids[i] != ids[j])
            found.append((ids[i[good]], ids[j[good]]))
        if found:
            yield _sent(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _sets():
    def f(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "component": batch.column(2), "shingles": [x.tobytes() for x in shingle_sets(hashed(batch.column(1)))]}

    return f


def _set_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets of a task have each shingle; partial counts leave it now and then."""
    held, n = [], 0

    def out() -> pa.RecordBatch:
        found, count = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(count)], schema=to_arrow_schema(SHINGLE_COUNT))

    for batch in batches:
        for raw in batch.column(0):
            held.append(np.frombuffer(raw.as_buffer(), np.int64))
            n += len(held[-1])
            if n > 1_000_000:
                yield out()
                held, n = [], 0
    if held:
        yield out()


def frequent_shingles(sets: DataFrame, scratch: Scratch) -> tuple[np.ndarray, np.ndarray, bool]:
    """Shingles of more than one set and their counts, the HELD most frequent at most, and whether these are all.

    A histogram of counts finds the least count that is held.
    """
    counts = sets.select("shingles").mapInArrow(_set_counts, SHINGLE_COUNT).groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1")
    counts = scratch.save(counts, "often")
    level = F.floor(8 * F.log2("n")).cast("int")
    room, least, whole = HELD, 1 << 30, True
    for x, size in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        room -= size
        if room < 0:
            whole = False
            break
        least = x
    table = counts.where(level >= least).toArrow().sort_by("shingle")
    return table["shingle"].to_numpy(), table["n"].to_numpy(), whole


def prefix_of(shingles: np.ndarray, known: np.ndarray, often: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """The first 25 % and one of a set, rarest first, and their places from 1; without those of no other set, where that is known."""
    n = len(shingles)
    if not n:
        return shingles, shingles
    at = np.searchsorted(known, shingles)
    hit = known[np.minimum(at, len(known) - 1)] == shingles if len(known) else np.zeros(n, bool)
    count = np.ones(n, np.int64)
    count[hit] = often[at[hit]]
    order = np.lexsort((shingles, count))[: (100 - PERCENT) * n // 100 + 1]
    place = np.arange(1, len(order) + 1)
    keep = hit[order] if whole else np.ones(len(order), bool)
    return shingles[order][keep], place[keep]


def _prefixes(shared):
    def make():
        known, often, whole = shared.value

        def f(batch: pa.RecordBatch) -> dict:
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(2)]
            found = [prefix_of(x, known, often, whole) for x in sets]
            sizes = [len(x) for x, _ in found]
            each = lambda c: np.repeat(c, sizes)
            of = lambda k: batch.column(k).to_numpy(zero_copy_only=False)
            return {"shingle": np.concatenate([x for x, _ in found]), "doc_id": each(of(0)), "component": each(of(1)), "n": each([len(x) for x in sets]), "at": np.concatenate([x for _, x in found])}

        return f

    return make


def _prefix_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs in different components that share a shingle and can still be linked if it is the first that they share.

    The sets are ordered alike; at is a shingle's place from 1, so what two sets share from there on is bounded. Rows of
    the shingle's main component are in one block of it each, all others in every block; pairs of these are made in block 0.
    """
    for of, block, ids, component, n, at, other in _groups(batches, 2):
        found, count = [], 0
        for lo, hi in zip(starts := np.flatnonzero(np.diff(of, prepend=-1)), [*starts[1:], len(of)], strict=True):
            out = lo + np.flatnonzero(other[lo:hi] == 1)
            every = np.arange(lo, hi) if block[lo] == 0 else lo + np.flatnonzero(other[lo:hi] == 0)
            for k in range(0, len(out), 256):
                i = out[k : k + 256, None]
                for m in range(0, len(every), CHUNK):
                    j = every[None, m : m + CHUNK]
                    both = 1 + np.minimum(n[i] - at[i], n[j] - at[j])
                    keep = ((100 + PERCENT) * both >= PERCENT * (n[i] + n[j])) & (component[i] != component[j]) & (ids[i] != ids[j])
                    x, y = np.nonzero(keep)
                    if len(x):
                        found.append((ids[i[x, 0]], ids[j[0, y]]))
                        count += len(x)
            if count > 100_000:
                yield _sent(*(np.concatenate(c) for c in zip(*found, strict=True)))
                found, count = [], 0
        if found:
            yield _sent(*(np.concatenate(c) for c in zip(*found, strict=True)))


def open_pairs(source: DataFrame, entries: DataFrame, so_far: DataFrame, scratch: Scratch, parts: int) -> DataFrame:
    """Candidates (a, b) among all members of a region that are still in different components, in regions of any size.

    Regions of one component, which most are by now, are left aside by a pre-aggregated minimum and maximum. Of the others, those
    of up to REGION members give all their pairs that sizes and sketches don't rule out. Members of larger ones go through an
    exact prefix filter: each set is sorted by how many of them have a shingle; linked sets share one of their first 25 % and
    one, so only those are grouped, and no linked pair is lost, in whatever order all sets agree on; counts of the HELD most
    frequent shingles are sent out, and the others come before them. A shingle that very many have is dealt in blocks.
    """
    placed = entries.drop("q").join(so_far, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = scratch.save(placed, "placed")
    regions = placed.groupBy("tree", "p").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo != hi").select("tree", "p", "members")
    regions = scratch.save(regions, "regions")
    small = placed.join(regions.where(F.col("members") <= REGION).drop("members").hint("merge"), ["tree", "p"], "left_semi")
    small = small.select("tree", "p", "id", "n", "s0", "s1", "component").repartition(parts, "tree", "p").sortWithinPartitions("tree", "p")
    direct = small.mapInArrow(_region_pairs, PAIR)
    large = placed.join(regions.where(F.col("members") > REGION).drop("members").hint("merge"), ["tree", "p"], "left_semi")
    ids = scratch.save(large.select(F.col("id").alias("doc_id"), "component").distinct(), "open")
    texts = source.join(ids.hint("merge"), "doc_id").select("doc_id", "text", "component")
    sets = scratch.save(flat_map(texts, SET, _sets).distinct(), "sets")
    held = sets.sparkSession.sparkContext.broadcast(frequent_shingles(sets, scratch))
    first = scratch.save(flat_map(sets, PREFIX, _prefixes(held)), "first")
    each = first.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("c"))
    shared = each.groupBy("shingle").agg(F.max(F.struct("c", "component"))["component"].alias("main"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    shared = scratch.save(shared.select("shingle", "main", F.ceil(F.col("c") / CHUNK).alias("blocks")), "shared")
    other = F.col("component") != F.col("main")
    blocks = F.when(other, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("doc_id"), "blocks")))
    dealt = first.join(shared.hint("merge"), "shingle").select("shingle", F.explode(blocks).alias("block"), "doc_id", "component", "n", "at", other.cast("long").alias("other"))
    dealt = dealt.repartition(parts, "shingle", "block").sortWithinPartitions("shingle", "block").select("shingle", "block", F.col("block").alias("in_block"), "doc_id", "component", "n", "at", "other")
    return direct.union(dealt.mapInArrow(_prefix_pairs, PAIR)).distinct()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 * intersection >= 75 * union, for sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return len(a) > 0 and len(b) > 0 and 100 * both >= PERCENT * (len(a) + len(b) - both)


def _confirm():
    sets: dict[str, np.ndarray] = {}  # by text, as rows that repeat an id can have several

    def f(batch: pa.RecordBatch) -> dict:
        a, b, ta, tb = (c.to_pylist() for c in batch.columns)
        if len(sets) > 2000:
            sets.clear()
        new = list(dict.fromkeys(t for t in (*ta, *tb) if t not in sets))
        sets.update(zip(new, shingle_sets(hashed(pa.array(new, pa.large_string()))), strict=True))
        keep = [i for i in range(len(a)) if linked(sets[ta[i]], sets[tb[i]])]
        return {"a": [a[i] for i in keep], "b": [b[i] for i in keep]}

    return f


def components(links: DataFrame, scratch: Scratch, name: str = "") -> DataFrame:
    """(id, component): the smallest id that links reach, for ids that occur in links (a, b).

    Each round takes the smallest label among a node and its neighbours, then follows labels to their own labels;
    both are joins of narrow rows with pre-aggregated minima. Every round is written to the shared
    folder. Labels at least halve their distance to the smallest, so rounds grow with the logarithm of the longest path.
    """
    edges = scratch.save(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"edges{name}")
    labels = scratch.save(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")), f"labels{name}0")
    step = 0
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        better = scratch.save(labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label")), f"better{name}{step}")
        owner = better.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = scratch.save(better.join(owner, "label", "left").select("id", "old", F.coalesce(F.least("label", "next"), "label").alias("label")), f"labels{name}{step + 1}")
        changed = jumped.where("old != label").limit(1).count()
        scratch.drop(f"better{name}{step}", f"labels{name}{step}")
        labels, step = jumped.select("id", "label"), step + 1
        if not changed:
            return labels.select("id", F.col("label").alias("component"))


def confirm(source: DataFrame, pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) whose full sets are linked; the texts that they need are written under the name."""
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    # The same plan at every size: candidates grow with the input, so they are never broadcast.
    texts = scratch.save(source.join(wanted.hint("merge"), "doc_id", "left_semi"), name)
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return flat_map(both.select("a", "b", "text_a", "text_b"), PAIR, _confirm)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable over links), kept (id = component_id).

    Rows with equal sets form a class, so copies are never paired; one representative of each class enters
    the forest. Its entries are sorted by ranges of (order, signature, id), so one huge region is dealt over many
    tasks. The first round confirms at most two partners of each member, the nearest of its neighbours in any order and the
    nearest middle of a region, so its pairs grow with the members, however large a region is. The second round takes all members
    of a region that confirmed links haven't joined yet, so the result depends neither on the first round's choice nor on
    partitions. Every link is confirmed on full texts, which are read for candidates only. A null, empty or blank text has an empty set and is
    linked with nothing; rows that repeat an id are one node; a null id is its own component, null, and
    kept; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = scratch.save(flat_map(source, SIGNATURE, _signatures), "signatures")
    narrow = rows.select("doc_id", "n_shingles", "key0", "key1")
    usable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    classes = scratch.save(narrow.where(usable).groupBy("key0", "key1").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    reps = rows.where(usable).join(classes.select(F.col("rep").alias("doc_id"), "key0", "key1"), ["doc_id", "key0", "key1"], "left_semi")
    entries = reps.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "s0", "s1", F.posexplode(F.arrays_zip("p", "q")).alias("tree", "__pq")).select(F.col("tree").cast("long"), "__pq.p", "__pq.q", "id", "n", "s0", "s1")
    entries = scratch.save(entries, "entries")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = ["tree", "p", "q", "id"]
    near = entries.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("q").mapInArrow(_proposals, PROPOSED)
    near = near.groupBy("a", "kind").agg(F.min(F.struct("far", "b"))["b"].alias("b"))
    pairs = scratch.save(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    confirmed = confirm(source, pairs, scratch, "texts")
    # Rows that repeat an id with other texts belong to several classes; those are linked through their id.
    owned = narrow.where(usable).join(classes, ["key0", "key1"]).select("doc_id", "rep")
    several = owned.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("most")).where("a != most").drop("most")
    same_id = owned.join(several, "doc_id").where("a != rep").select("a", F.col("rep").alias("b")).distinct()
    links = scratch.save(confirmed.union(same_id), "links")
    scratch.drop("texts")
    so_far = components(links, scratch, "first")
    rest = scratch.save(open_pairs(source, entries, so_far, scratch, parts).join(pairs, ["a", "b"], "left_anti"), "rest")
    scratch.drop("pairs", "entries", "placed", "regions", "open", "sets", "often", "first", "shared")
    all_links = scratch.save(links.union(confirm(source, rest, scratch, "rest_texts")), "all_links")
    scratch.drop("rest", "rest_texts", "links")
    of_rep = components(all_links, scratch, "last")
    of_class = classes.join(of_rep.withColumnRenamed("id", "rep"), "rep", "left").select("key0", "key1", F.coalesce("component", "rep").alias("component"))
    out = narrow.join(of_class.where("key0 is not null"), ["key0", "key1"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).withColumnRenamed("doc_id", id_col)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
