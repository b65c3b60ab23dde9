"""Substring dedup: runs of consecutive sentences are hashed and joined globally; what later copies repeat is removed."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, add_columns, flat_map, unused
from .words import Words, hashed, mixed, powers

#: Sentences in a run at least, and its words at least; a run is the shortest from its first sentence that has both.
RUN_SENTENCES, RUN_WORDS = 3, 15
#: A sentence of more words is cut after each word whose hash ends in zeros for one word in CUT_EVERY, so that
#: copies are cut alike wherever they stand.
LONG_SENTENCE, CUT_EVERY = 16, 5
#: What is still long then, as one word over and over, is cut after so many words.
PIECE = 12
ENDS = np.isin(np.arange(256), list(b".!?"))
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentences_of(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row, hashes of all words, and the word at which each sentence starts, with the number of words last.

    A sentence ends with a word that ends in . ! or ?, with a line, or at a cut.
    """
    lines = np.searchsorted(np.flatnonzero(words.data == 10), words.start)
    opens = np.ones(len(lines), bool)
    opens[1:] = (np.diff(lines) != 0) | ENDS[words.data[words.end[:-1] - 1]]
    for lo, hi in zip(words.row[:-1].tolist(), words.row[1:].tolist(), strict=True):
        n, h = hi - lo, words.hash[lo:hi]
        start = np.ones(n + 1, bool)
        start[1:n] = opens[lo + 1 : hi]
        at = np.flatnonzero(start) if n else np.zeros(1, np.int64)
        if n and (np.diff(at) > LONG_SENTENCE).any():
            long = np.repeat(np.diff(at) > LONG_SENTENCE, np.diff(at))
            start[1:] |= long & ((h >> np.uint64(20)) % np.uint64(CUT_EVERY) == 0)
            at = np.flatnonzero(start)
            for i in np.flatnonzero(np.diff(at) > LONG_SENTENCE):
                start[at[i] : at[i + 1] : PIECE] = True
            at = np.flatnonzero(start)
        yield h, at


def runs_of(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, 32 further bits, first sentence, sentence after the last) of each run; the last sentences of a text start none."""
    n = len(at) - 1
    first = np.arange(n)
    after = np.maximum(first + RUN_SENTENCES, np.searchsorted(at, at[:-1] + RUN_WORDS))
    ok = after <= n
    first, after = first[ok], after[ok]
    if not len(first):
        return np.empty(0, np.int64), np.empty(0, np.int32), first, after
    # Polynomial hashes: differences of prefix sums, brought to one place by powers of the step's inverse.
    lo, hi, values = at[first], at[after], []
    for step, words in zip(_STEPS, (h, mixed(h)), strict=True):
        power, inverse = powers(len(h), step)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * power[: len(h)], dtype=np.uint64)))
        values.append(mixed((sums[hi] - sums[lo]) * inverse[lo] ^ ((hi - lo).astype(np.uint64) << np.uint64(48))))
    return values[0].view(np.int64), (values[1] >> np.uint64(32)).astype(np.uint32).view(np.int32), first, after


RUN = T.StructType([T.StructField("run", T.LongType()), T.StructField("more", T.IntegerType()), T.StructField("doc", T.LongType())])


def _runs():
    def f(batch: pa.RecordBatch) -> dict:
        parts, more, sizes = [], [], []
        for h, at in sentences_of(hashed(batch.column(1))):
            run, rest, _, _ = runs_of(h, at)
            run, place = np.unique(run, return_index=True)
            parts.append(run)
            more.append(rest[place])
            sizes.append(len(run))
        return {"run": np.concatenate(parts), "more": np.concatenate(more), "doc": np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)}

    return f


def removed_sentences(h: np.ndarray, at: np.ndarray, elsewhere: np.ndarray) -> np.ndarray:
    """Flags of the sentences that a non-first run covers: one that a smaller id has first, or that this text repeats."""
    run, _, first, after = runs_of(h, at)
    covered = np.zeros(len(at), np.int64)
    if len(run):
        again = np.ones(len(run), bool)
        again[np.unique(run, return_index=True)[1]] = False
        again |= np.isin(run, elsewhere)
        np.add.at(covered, first[again], 1)
        np.add.at(covered, after[again], -1)
    return np.cumsum(covered)[:-1] > 0


FIELDS = [
    T.StructField("n_sentences", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("clean_text", T.StringType()),
]


def _cleaned():
    def one(text: str | None, elsewhere: np.ndarray, h: np.ndarray, at: np.ndarray) -> tuple:
        gone = removed_sentences(h, at, elsewhere)
        if not gone.any():
            return len(gone), 0, [], text
        words = [m.span() for m in _WORD.finditer(text)]
        # A sentence owns what stands before the next one, white space included.
        cut = [0, *(words[w][0] for w in at[1:-1].tolist()), len(text)]
        spans: list[list[int]] = []
        for s in np.flatnonzero(gone).tolist():
            if spans and spans[-1][1] == cut[s]:
                spans[-1][1] = cut[s + 1]
            else:
                spans.append([cut[s], cut[s + 1]])
        kept, place = [], 0
        for lo, hi in spans:
            kept.append(text[place:lo])
            place = hi
        return len(gone), int(gone.sum()), [{"start": a, "end": b} for a, b in spans], "".join([*kept, text[place:]])

    def f(values: list) -> list[list]:
        texts = [v["text"] for v in values]
        made = zip(texts, values, sentences_of(hashed(pa.array(texts, pa.large_string()))), strict=True)
        rows = [one(text, np.array(v["runs"] or [], np.int64), h, at) for text, v, (h, at) in made]
        return [list(x) for x in zip(*rows, strict=True)]

    return f


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Append n_sentences, n_removed, removed (spans in code points), clean_text and first_docs.

    Of a run of sentences that occurs more than once, the first (by id, then by place) stays; sentences that
    any other covers are removed. A run is known by 96 bits of hash. Texts of fewer than RUN_SENTENCES sentences or RUN_WORDS
    words have no run, so even whole copies of them stay. first_docs are the ids whose text this one repeats. A null, empty or blank
    text has no sentences and stays as it is; rows without an id are cleaned of their own repeats alone;
    rows that repeat an id count as one text, and repeats among them stay; an empty table gives no rows. A column of the input
    that has the name of an added one is replaced. Minima are pre-aggregated, so
    a run that a third of the texts hold is one row a task; the join back is one that adaptive execution splits.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "substring")
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    runs = scratch.save(flat_map(source.where(F.col("doc").isNotNull()), RUN, _runs), "runs")
    key = ["run", "more"]
    firsts = scratch.save(runs.groupBy(*key).agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first != last").select(*key, "first"), "firsts")
    later = runs.hint("merge").join(firsts, key).where("doc != first")
    added = [f.name for f in FIELDS] + ["first_docs"]
    doc, own_id, found, both = unused(docs, "doc", "id", "found", "both")
    per_doc = later.groupBy(F.col("doc").alias(doc)).agg(F.struct(F.collect_set("run").alias("runs"), F.sort_array(F.collect_set("first")).alias("first_docs")).alias(found))
    marked = docs.withColumn(own_id, F.col(id_col).cast("long")).join(per_doc.hint("merge"), F.col(own_id) == F.col(doc), "left")
    marked = marked.withColumn(both, F.struct(F.col(text_col).cast("string").alias("text"), F.col(found)["runs"].alias("runs")))
    out = add_columns(marked, both, FIELDS, _cleaned)
    return out.select(*(c for c in docs.columns if c not in added), *added[:-1], F.coalesce(F.col(found)["first_docs"], F.array().cast("array<long>")).alias("first_docs"))


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences that it repeats."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_sentences", "n_removed", "removed", "first_docs", F.col("clean_text").alias("text"))
