"""Benchmark decontamination: latent semantic retrieval of passages, then longest common subsequences and answer checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_ROWS, Scratch, add_columns, few, flat_map, unused

#: Words of a passage, and words from one passage to the next.
PASSAGE, STRIDE = 48, 24
#: Latent dimensions, extra random directions, and power iterations of the decomposition.
RANK, EXTRA, ITERATIONS = 128, 16, 2
#: Pairs of terms whose sums a task holds at once; where there are more, each part of them is a pass over the ids.
HELD_PAIRS = 8_000_000
#: Items searched for in one pass over the documents, about.
BLOCK = 1000
#: Least cosine of a candidate; least share of an item's words in the common subsequence; share of its rarest words that must occur.
LEAST_COSINE, LEAST_COMMON, LEAST_ANSWER, ANSWER_WORDS = 0.4, 0.6, 0.6, 6
#: A passage whose latent vector is shorter than this share of an item's has too little in common with it.
LEAST_NORM = 0.3
#: Everything in ASCII but letters and digits parts words.
PARTS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_in(text: str | None) -> list[bytes]:
    """Words in lower case, parted by white space and ASCII punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(PARTS).split() if text else []


def term_ids(text: str | None, terms: dict[bytes, int]) -> np.ndarray:
    """The index of each word among the benchmark's terms, -1 for others."""
    words = words_in(text)
    return np.fromiter(map(terms.get, words, repeat(-1)), np.int32, len(words))


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel over a; negative numbers equal nothing."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        if x >= 0:
            places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        if m := places.get(x, 0):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


@dataclass
class Index:
    """The benchmark in latent space. `vectors` are idf-weighted rows of the term space's basis."""

    terms: dict[bytes, int]
    idf: np.ndarray
    vectors: np.ndarray
    item_ids: list[int]
    items: list[list[int]]
    latent: np.ndarray
    norms: np.ndarray
    answers: list[frozenset[int]]


def _leading(apply: Callable[[np.ndarray], np.ndarray], n_terms: int, rank: int, extra: int, iterations: int, seed: int) -> np.ndarray:
    """Orthonormal basis (terms x rank) of the leading directions of a symmetric matrix that apply() multiplies by."""
    width = min(rank + extra, n_terms)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))[0].astype(np.float32)
    for _ in range(iterations):
        total = apply(basis)
        basis = np.linalg.qr(total)[0].astype(np.float32)
    # Rotate to singular directions: the last pass's Gram matrix in the basis is small.
    small = basis.T @ total if iterations else np.eye(width)
    u = np.linalg.svd(small)[0]
    return np.ascontiguousarray((basis @ u)[:, :rank])


PART = T.StructType([T.StructField("part", T.BinaryType())])


def _summed(parts: DataFrame, like: np.ndarray) -> np.ndarray:
    """The sum of every partition's array."""
    return sum((np.frombuffer(r[0], np.float32).reshape(like.shape) for r in parts.toLocalIterator()), np.zeros_like(like))


def randomized_svd(rows: DataFrame, n_terms: int, rank: int = RANK, extra: int = EXTRA, iterations: int = ITERATIONS, seed: int = 11) -> np.ndarray:
    """Orthonormal basis (terms x rank) of the leading right singular vectors of a distributed sparse matrix.

    rows has arrays `at` and `value`, a passage each. Each iteration sends the basis out, and every partition sends back one
    sum of outer products, of terms x (rank + extra) numbers.
    """

    def apply(basis: np.ndarray) -> np.ndarray:
        def gram(batches):
            total = np.zeros_like(basis)
            for batch in batches:
                for at, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if at:
                        v = np.array(value, np.float32)
                        total[at] += v[:, None] * (v @ basis[at])
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

        return _summed(rows.select("at", "value").mapInArrow(gram, PART), basis)

    return _leading(apply, n_terms, rank, extra, iterations, seed)


def gram_svd(pairs: DataFrame, own: list[tuple[list[int], list[float]]], weight: float, n_terms: int, rank: int = RANK, extra: int = EXTRA, iterations: int = ITERATIONS, seed: int = 11) -> np.ndarray:
    """The basis of randomized_svd() from the sums of pair_sums(), with the own rows (at, value) weighed besides."""

    def apply(basis: np.ndarray) -> np.ndarray:
        def multiply(batches):
            total = np.zeros_like(basis)
            for batch in batches:
                for lo in range(0, batch.num_rows, 64):
                    at = batch.column(0).slice(lo, 64).to_numpy()
                    upper = np.zeros((len(at), n_terms), np.float32)
                    for k, raw in enumerate(batch.column(1).slice(lo, 64)):
                        upper[k, at[k] :] = np.frombuffer(raw.as_buffer(), np.float32)
                    total[at] += upper @ basis
                    upper[np.arange(len(at)), at] = 0
                    total += upper.T @ basis[at]
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

        total = _summed(pairs.select("term", "sums").mapInArrow(multiply, PART), basis)
        for at, value in own:
            v = np.array(value, np.float32)
            total[at] += np.float32(weight) * v[:, None] * (v @ basis[at])
        return total

    return _leading(apply, n_terms, rank, extra, iterations, seed)


SPARSE = T.StructType([T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.FloatType()))])


def _tf_idf(ids: np.ndarray, idf: np.ndarray) -> tuple[list[int], list[float]]:
    at, n = np.unique(ids[ids >= 0], return_counts=True)
    v = n * idf[at]
    norm = np.sqrt((v * v).sum())
    return at.tolist(), (v / norm if norm else v).tolist()


IDS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.BinaryType())])
SUMS = T.StructType([T.StructField("term", T.IntegerType()), T.StructField("sums", T.BinaryType())])
#: Kinds of counts besides those of terms.
PASSAGES, ROWS = -1, -2


def _number(n_terms: int) -> np.dtype:
    """What a stored term id takes."""
    return np.dtype(np.int16 if n_terms < 1 << 15 else np.int32)


def _arrays(column: pa.Array, kind: np.dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def _to_ids(terms: dict[bytes, int]):
    def make():
        kind = _number(len(terms))
        return lambda batch: {"doc_id": batch.column(0), "ids": [term_ids(t, terms).astype(kind).tobytes() for t in batch.column(1).to_pylist()]}

    return make


def _frequencies(n_terms: int):
    """Texts that have each term, their passages and their number."""

    def run(batches):
        n, passages, rows = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            for ids in _arrays(batch.column(0), _number(n_terms)):
                n[np.unique(ids[ids >= 0])] += 1
                passages += max(1, -(-len(ids) // STRIDE) - 1)
                rows += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, (PASSAGES, ROWS)), pa.int32()), pa.array(np.append(n[at], (passages, rows)), pa.int64())], names=["term", "n"])

    return run


def passage_rows(texts: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passage, term and tf-idf value of every term of every passage of the texts, by passage and term; a passage's values have the length 1."""
    blocks = [-(-len(t) // STRIDE) for t in texts]
    first = np.cumsum([0, *(max(1, b - 1) for b in blocks)])
    passage, term = [], []
    for t, b, lo in zip(texts, blocks, first, strict=False):
        at = np.flatnonzero(t >= 0)
        block, ids = at // STRIDE, t[at].astype(np.int64)
        # A block of STRIDE words is the first half of a passage and the second half of the one before.
        for shift in (0, 1):
            own = (block >= shift) & (block - shift < max(1, b - 1))
            passage.append(lo + block[own] - shift)
            term.append(ids[own])
    key, n = np.unique(np.concatenate(passage) * len(idf) + np.concatenate(term), return_counts=True)
    passage, term = key // len(idf), key % len(idf)
    value = n * idf[term].astype(np.float64)
    return passage, term, value / np.sqrt(np.bincount(passage, value * value))[passage]


def _pair_sums(idf: np.ndarray, lo: int, hi: int):
    """Sums over all passages of the products of two terms' values, the smaller one of terms lo to hi."""

    def run(batches):
        n = len(idf)
        size = n - np.arange(lo, hi)
        start = np.concatenate(([0], np.cumsum(size)))
        base, sums = start[:-1] - np.arange(lo, hi), np.zeros(start[-1])
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE_ROWS):
                texts = _arrays(batch.column(0).slice(k, SLICE_ROWS), _number(n))
                passage, term, value = passage_rows(texts, idf)
                if not len(term):
                    continue
                last = np.searchsorted(passage, passage, "right")
                at = np.flatnonzero((term >= lo) & (term < hi))
                left = last[at] - at
                own, mine = base[term[at] - lo], value[at]
                d = 0
                while len(at):  # each term with the one d places on in its passage
                    np.add.at(sums, own + term.take(at + d), mine * value.take(at + d))
                    d += 1
                    stay = left > d
                    at, left, own, mine = at[stay], left[stay], own[stay], mine[stay]
        if sums.any():
            for k in range(0, hi - lo, 256):
                some = range(k, min(k + 256, hi - lo))
                rows = [sums[start[i] : start[i + 1]].astype(np.float32).tobytes() for i in some]
                yield pa.RecordBatch.from_arrays([pa.array([lo + i for i in some], pa.int32()), pa.array(rows, pa.binary())], names=["term", "sums"])

    return run


def _added(batches):
    """One row for each term from rows that are sorted by term."""
    term, total = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([term], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["term", "sums"])

    for batch in batches:
        for t, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            v = np.frombuffer(raw.as_buffer(), np.float32)
            if t == term:
                total += v
                continue
            if term is not None:
                yield out()
            term, total = t, v.astype(np.float64)
    if term is not None:
        yield out()


def pair_sums(ids: DataFrame, idf: np.ndarray, scratch: Scratch) -> DataFrame:
    """(term, sums): the upper triangle of the products of terms' values, summed over every passage of every text.

    A task sends one sum for each pair of terms, so tasks are as few as the cores.
    """
    spark, n, lo, parts = ids.sparkSession, len(idf), 0, None
    while lo < n:
        hi, held = lo, 0
        while hi < n and (hi == lo or held + n - hi <= HELD_PAIRS):
            held, hi = held + n - hi, hi + 1
        made = ids.select("ids").coalesce(spark.sparkContext.defaultParallelism).mapInArrow(_pair_sums(idf, lo, hi), SUMS)
        part = scratch.save(made.repartition(8, "term").sortWithinPartitions("term").mapInArrow(_added, SUMS).coalesce(8), f"pairs{lo}")
        parts, lo = part if parts is None else parts.unionByName(part), hi
    return parts.coalesce(8)


def fit(docs: DataFrame, items: list[tuple[int, str]], id_col: str, text_col: str) -> tuple[Index, DataFrame] | None:
    """Index a block of items, and the ids of their terms in every document. Document frequencies and the latent space come from all documents."""
    spark = docs.sparkSession
    words = [(i, words_in(t)) for i, t in items]
    words = [(i, w) for i, w in words if w]
    if not words:
        return None
    terms = {w: k for k, w in enumerate(sorted({x for _, ws in words for x in ws}))}
    scratch = Scratch(spark, "latent")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    in_terms = scratch.save(few(flat_map(texts, IDS, _to_ids(terms))), "ids")
    # At most one row per benchmark term comes back.
    counts = in_terms.select("ids").mapInArrow(_frequencies(len(terms)), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    n = {r[0]: r[1] for r in counts.collect()}
    total, passages = n.pop(ROWS, 0), n.pop(PASSAGES, 0)
    df = np.zeros(len(terms))
    df[list(n)] = list(n.values())
    idf = np.log((total + 1) / (df + 1)).astype(np.float32) + 0.1
    ids = [[terms[x] for x in ws] for _, ws in words]
    # Benchmark passages weigh as much as the documents', so that their rare terms are not lost in them.
    own = [_tf_idf(np.array(i), idf) for i in ids]
    pairs = pair_sums(in_terms, idf, scratch)
    basis = gram_svd(pairs, own, max(1.0, passages / len(ids)), len(terms))
    scratch.drop(*{x.rsplit("/", 2)[-2] for x in pairs.inputFiles()})
    vectors = np.ascontiguousarray(basis * idf[:, None], np.float32)
    latent = np.stack([vectors[i].sum(axis=0) for i in ids])
    norms = np.linalg.norm(latent, axis=1)
    answers = [frozenset(sorted(set(i), key=lambda k: (-idf[k], k))[:ANSWER_WORDS]) for i in ids]
    return Index(terms, idf, vectors, [i for i, _ in words], ids, latent / np.maximum(norms, 1e-9)[:, None], norms, answers), in_terms


MATCH = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("cosine", T.DoubleType()),
        T.StructField("common", T.DoubleType()),
        T.StructField("answer", T.DoubleType()),
        T.StructField("word", T.LongType()),
    ]
)


def latent_windows(ids: np.ndarray, index: Index) -> np.ndarray:
    """A latent vector for each passage of PASSAGE words, STRIDE apart; a short text is one passage."""
    blocks = max(1, -(-len(ids) // STRIDE))
    at = np.flatnonzero(ids >= 0)
    sums = np.zeros((blocks, index.vectors.shape[1]), np.float32)
    for lo in range(0, len(at), 1 << 15):
        part = at[lo : lo + (1 << 15)]
        of = part // STRIDE
        first = np.flatnonzero(np.diff(of, prepend=-1))
        sums[of[first]] += np.add.reduceat(index.vectors[ids[part]], first, axis=0)
    return sums if blocks == 1 else sums[:-1] + sums[1:]


def judge(index: Index, k: int, ids: np.ndarray, window: int) -> tuple[float, float]:
    """Shares of item k's words in the longest common subsequence with the words around a passage, and of its rarest words there."""
    item = index.items[k]
    lo, hi = window * STRIDE - len(item), window * STRIDE + PASSAGE + len(item)
    around = ids[max(0, lo) : hi].tolist()
    answer = index.answers[k]
    here = len(answer.intersection(around)) / len(answer)
    if here < LEAST_ANSWER:
        return 0.0, here
    return common_subsequence(item, around) / len(item), here


def leaks_of(index: Index, texts: list[np.ndarray]) -> list[dict[int, tuple[float, float, float, int]]]:
    """For each text, items it holds: place in the index -> (common, answer, cosine, passage) of the best passage."""
    windows = [latent_windows(t, index) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(w) for w in windows])
    place = np.concatenate([np.arange(len(w)) for w in windows])
    every = np.concatenate(windows)
    norm = np.linalg.norm(every, axis=1)
    near: dict[tuple[int, int], list[tuple[float, int]]] = {}
    for lo in range(0, len(every), 8192):
        cosine = (every[lo : lo + 8192] @ index.latent.T) / np.maximum(norm[lo : lo + 8192], 1e-9)[:, None]
        cosine[norm[lo : lo + 8192, None] < LEAST_NORM * index.norms] = 0
        for r, k in zip(*np.nonzero(cosine >= LEAST_COSINE), strict=True):
            near.setdefault((int(owner[lo + r]), int(k)), []).append((float(cosine[r, k]), int(place[lo + r])))
    out: list[dict[int, tuple[float, float, float, int]]] = [{} for _ in texts]
    for (d, k), hits in near.items():
        best = max((*judge(index, k, texts[d], w), c, w) for c, w in hits)
        if best[0] >= LEAST_COMMON:
            out[d][k] = best
    return out


def _search(index: Index):
    def make():
        def f(batch: pa.RecordBatch) -> dict | None:
            out: dict[str, list] = {x: [] for x in MATCH.names}
            leaks = leaks_of(index, _arrays(batch.column(1), _number(len(index.terms))))
            for doc, own in zip(batch.column(0).to_pylist(), leaks, strict=True):
                for k, (common, answer, cosine, window) in own.items():
                    for name, value in zip(MATCH.names, (doc, index.item_ids[k], cosine, common, answer, window * STRIDE), strict=True):
                        out[name].append(value)
            return out if out["doc_id"] else None

        return f

    return make


def _blocks(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> Iterator[tuple[Index, DataFrame]]:
    """An index of each block of about BLOCK items, dealt by a hash, with the ids of its terms in the documents; the driver holds one block at a time."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")).distinct()
    blocks = -(-items.count() // BLOCK)
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()
        made = fit(docs, sorted(map(tuple, rows), key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")), id_col, text_col)
        if made is not None:
            yield made


def mark_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Append leaked_items, the sorted ids of the items that a row's text holds. All columns and rows stay; there is no shuffle.

    Each block of items is a pass over the rows, written before the next, so a worker holds one block's index.
    """
    scratch, found = Scratch(docs.sparkSession, "marked"), T.StructField("leaked_items", T.ArrayType(T.LongType()))
    both = unused(docs, "both", found.name)[0]
    out = None
    for k, (index, _) in enumerate(_blocks(docs, benchmark, id_col, text_col, item_col, item_text)):

        def make(index=index):
            def f(values: list) -> list[list]:
                leaks = leaks_of(index, [term_ids(v["text"], index.terms) for v in values])
                own = [[*v["found"], *(index.item_ids[i] for i in x)] for v, x in zip(values, leaks, strict=True)]
                return [[sorted(x, key=lambda i: (i is None, i or 0)) for x in own]]

            return f

        so_far = F.array().cast(found.dataType) if out is None else F.col(found.name)
        rows = docs if out is None else scratch.save(out, f"block{k}")
        rows = rows.withColumn(both, F.struct(F.col(text_col).cast("string").alias("text"), so_far.alias("found")))
        out = add_columns(rows, both, [found], make).drop(both)
    if out is None:
        return docs.drop(found.name).withColumn(found.name, F.array().cast(found.dataType))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, common, answer, word): documents that hold a benchmark item, verbatim or paraphrased.

    Benchmark items are the queries, all documents' passages the rows searched: whole texts, without a
    shuffle, in blocks of items, whose matches are written. Null, empty or wordless texts match nothing, neither as items nor as documents;
    an item without an id is searched for as null; rows that repeat an id are searched each, and each pair is returned once, by its best passage.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    found = docs.sparkSession.createDataFrame([], MATCH)
    for k, (index, in_terms) in enumerate(_blocks(docs, benchmark, id_col, text_col, item_col, item_text)):
        found = found.unionByName(scratch.save(few(flat_map(in_terms, MATCH, _search(index))), f"block{k}"))
    best = F.max(F.struct("common", "cosine", "answer", "word")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.cosine", "best.common", "best.answer", "best.word")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it holds."""
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
