"""Toxicity by weak supervision: many voters, a generative label model over their votes, a linear classifier on its posteriors."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .boosting import sigmoid
from .common import SLICE_ROWS, Scratch, add_columns, few, flat_map, remainder

#: Labelled rows that are fitted together, about; the classifiers of such shards are averaged, so that every row counts.
SHARD_ROWS = 6000
#: Labels that are sent out at once to find their texts, about.
LABELS = 2_000_000
#: Vote vectors that the label model takes at once, and keys that a task counts before it sends them on.
CHUNK, HELD_KEYS = 50_000, 300_000
#: Remainder and modulus of crc32(doc_id) that mark the rows never learned from.
HELD_OUT_MOD = 5
#: Lexicon of the first voter: plain insults (fixed values).
INSULTS = frozenset("idiot idiots idiota idiote moron morons stupid dumb scum trash worthless disgusting loser losers clown pathetic imbecile imbécile dummkopf abschaum estúpido basura".split())
PREFIXES = (4, 5, 6, 7, 8)
#: Features kept, and words of a text that one feature is measured against.
KEPT, RATE_WORDS = 3000, 100
EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def keys_of(word: str) -> tuple[str, ...]:
    """Features of a word: itself and its prefixes, lower-case and without punctuation at the edges."""
    w = EDGES.sub("", word.lower())
    return (w, *(w[:k] + "*" for k in PREFIXES if len(w) >= k)) if len(w) > 1 else ()


class Vocabulary(dict):
    """Indices of a raw word's kept features; emptied when it holds half a million words."""

    def __init__(self, index: dict[str, int]):
        super().__init__()
        self.index = index

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 500_000:
            self.clear()
        self[word] = found = tuple(i for k in keys_of(word) if (i := self.index.get(k)) is not None)
        return found


def counted(text: str | None, vocabulary: Vocabulary) -> tuple[Counter, int]:
    """Counts of the kept features, and the number of words."""
    words = (text or "").split()
    out: Counter = Counter()
    for word, n in Counter(words).items():
        for i in vocabulary[word]:
            out[i] += n
    return out, len(words)


def values_of(counts: dict[int, int], n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values: a damped count times a damped rate, so that a chance hit in a long text says little."""
    i = np.fromiter(counts.keys(), np.int64, len(counts))
    c = np.fromiter(counts.values(), np.float64, len(counts))
    return i, np.log1p(np.minimum(c, 20)) * np.sqrt(np.minimum(1, 10 * c / (n_words + RATE_WORDS)))


# ---- the label model ----------------------------------------------------------------------------


@dataclass
class LabelModel:
    """P(votes, label): each voter votes +1, -1 or abstains (0) by the label, with pairs of correlated voters damped.

    Accuracies come from expectation maximisation started at the gold voter where it votes. The correlation of two
    voters given the label is estimated from posterior-weighted residuals; a voter's evidence is divided by
    the sum of its squared correlations, so that copies of one voter count about once.
    """

    prior: float = 0.5
    log_odds: np.ndarray | None = None  # voters x 3: evidence of a vote of -1, 0, +1
    weight: np.ndarray | None = None
    correlation: np.ndarray | None = None

    def fit(self, votes: np.ndarray, gold: np.ndarray, rounds: int = 25, times: np.ndarray | None = None) -> LabelModel:
        """votes: rows x voters; gold: labels 0 or 1, or -1 where unknown; times: how often each row occurs. A known label is a voter that is nearly always right."""
        n, m = votes.shape
        known, times = gold >= 0, np.ones(n) if times is None else times
        posterior = np.where(known, np.where(gold == 1, 0.95, 0.05), 0.5)
        self.weight = np.ones(m)
        gold_odds = np.where(known, np.where(gold == 1, 3.0, -3.0), 0.0)
        chunks = [slice(lo, lo + CHUNK) for lo in range(0, n, CHUNK)]
        for r in range(rounds):
            both = np.stack([posterior * times, (1 - posterior) * times])
            table = np.stack([sum((both[:, at] @ (votes[at] == v) for at in chunks), np.zeros((2, m))) for v in (-1, 0, 1)], axis=2)
            p1, p0 = (table + 1) / (both.sum(axis=1)[:, None, None] + 3)
            self.log_odds = np.log(p1 / p0)
            self.prior = float(np.clip(both[0].sum() / times.sum(), 0.01, 0.99))
            if r % 5 == 0:
                cov = np.zeros((m, m))
                for w in both:
                    mean = sum(w[at] @ votes[at] for at in chunks) / w.sum()
                    for at in chunks:
                        centred = (votes[at] - mean) * np.sqrt(w[at])[:, None]
                        cov += centred.T @ centred
                cov /= times.sum()
                sd = np.sqrt(np.diag(cov)) + 1e-9
                self.correlation = cov / np.outer(sd, sd)
                self.weight = 1 / np.maximum(1, (self.correlation**2).sum(axis=0))
            posterior = np.concatenate([sigmoid(self.evidence(votes[at]) + gold_odds[at]) for at in chunks])
        return self

    def evidence(self, votes: np.ndarray) -> np.ndarray:
        """Log odds of label 1 by votes alone."""
        m = votes.shape[1]
        return np.log(self.prior / (1 - self.prior)) + (self.log_odds[np.arange(m), votes + 1] * self.weight).sum(axis=1)


@dataclass
class Voter:
    """Votes toxic from `least` hits of its features on (or hits of its pattern), clean where there are none if it speaks then."""

    name: str
    features: frozenset[int] | None
    pattern: str | None
    least: int
    clean_without: bool

    def vote(self, counts: Counter, text: str) -> int:
        hits = sum(counts[i] for i in self.features if i in counts) if self.features is not None else sum(1 for _ in re.finditer(self.pattern, text))
        return self.judge(hits)

    def judge(self, hits: int) -> int:
        return 1 if hits >= self.least else -1 if self.clean_without and not hits else 0


def voters_of(index: dict[str, int], ranked: list[str]) -> list[Voter]:
    """Lexicon voters from the seed list and from slices of the ranked features, and pattern voters."""
    pick = lambda keys: frozenset(index[k] for k in keys if k in index)
    out = [Voter(f"insults{n}", pick(INSULTS), None, n, n == 1) for n in (1, 2, 4)]
    for lo, hi in ((0, 5), (5, 15), (15, 40), (40, 100), (100, 250), (250, 600)):
        part = pick(ranked[lo:hi])
        out += [Voter(f"ranked{lo}-{hi}x{n}", part, None, n, n == 2) for n in (2, 4, 8)]
    out += [Voter(f"prefix{k}", pick([x for x in ranked[:400] if x.endswith("*") and len(x) == k + 1]), None, 3, True) for k in PREFIXES]
    out.append(Voter("words", pick([x for x in ranked[:400] if not x.endswith("*")]), None, 2, True))
    out += [Voter("shout", None, r"[A-Z]{4,}!+", 5, False), Voter("address", None, r"(?i)\byou(?:'re| are)? an? \w+", 2, False)]
    return out


# ---- the classifier -----------------------------------------------------------------------------


@dataclass
class Model:
    """Kept features, their weights and the intercept."""

    index: dict[str, int]
    weights: np.ndarray
    intercept: float
    label_model: LabelModel | None = None

    def scorer(self):
        vocabulary = Vocabulary(self.index)

        def score(text: str | None) -> float:
            i, v = values_of(*counted(text, vocabulary))
            return float(sigmoid(np.float64(self.intercept + (v * self.weights[i]).sum())))

        return score


KEYED = T.StructType([T.StructField("key", T.StringType()), *(T.StructField(f"n{y}", T.LongType()) for y in (0, 1))])
VOTED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("at", T.ArrayType(T.IntegerType())),
        T.StructField("n", T.ArrayType(T.IntegerType())),
        T.StructField("votes", T.BinaryType()),
    ]
)
#: Marks a feature that a text has at least REPEATED times.
OFTEN, REPEATED = "\0", 3


class Keys(dict):
    """Features of a raw word; emptied when it holds 200,000 words."""

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) > 200_000:
            self.clear()
        self[word] = found = keys_of(word)
        return found


def _keys(batches):
    """(key, n0, n1): texts of each label that have a key, or have it often; partial sums."""
    both, of, schema = (Counter(), Counter()), Keys(), to_arrow_schema(KEYED)

    def out():
        keys = list(both[0] | both[1])
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in both)], schema=schema)

    for batch in batches:
        for lo in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(lo, SLICE_ROWS)
            for label, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                c: dict[str, int] = defaultdict(int)
                for w, n in Counter((text or "").split()).items():
                    for k in of[w]:
                        c[k] += n
                both[label].update(c.keys())
                both[label].update([k + OFTEN for k, n in c.items() if n >= REPEATED])
            if len(both[0]) + len(both[1]) > HELD_KEYS:
                yield out()
                for c in both:
                    c.clear()
    if both[0] or both[1]:
        yield out()


def rank_features(sample: DataFrame, n0: int, n1: int) -> list[str]:
    """Features by how strongly they go with label 1 beyond chance, best first, KEPT at most; counted by the executors.

    A feature counts by the texts that have it, or that have it often, whichever tells more.
    """
    counts = sample.select("label", "text").mapInArrow(_keys, KEYED).groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n1 >= 4")
    p1, p0 = (F.col("n1") + 0.5) / (n1 + 1), (F.col("n0") + 0.5) / (n0 + 1)
    spread = lambda p, n: p * (1 - F.least(p, F.lit(0.999))) / n
    z = (p1 - p0) / F.sqrt(spread(p1, n1) + spread(p0, n0))
    scored = counts.where(p1 > p0).select(F.regexp_replace("key", OFTEN, "").alias("key"), (z * F.log(p1 / p0)).alias("score"))
    best = scored.groupBy("key").agg(F.max("score").alias("score")).orderBy(F.desc("score"), "key").limit(KEPT)
    return [r[0] for r in best.collect()]


def _votes(index: dict[str, int], ranked: list[str]):
    def make():
        vocabulary, voters = Vocabulary(index), voters_of(index, ranked)
        of: dict[int, list[int]] = defaultdict(list)
        for k, v in enumerate(voters):
            for i in v.features or ():
                of[i].append(k)

        def f(batch) -> dict:
            out: dict[str, list] = {x: [] for x in VOTED.names}
            for key, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts, n = counted(text, vocabulary)
                hits = [0] * len(voters)
                for i, c in counts.items():
                    for k in of.get(i, ()):
                        hits[k] += c
                votes = [v.judge(h) if v.pattern is None else v.vote(counts, text or "") for v, h in zip(voters, hits, strict=True)]
                row = (key, label, n, list(counts.keys()), list(counts.values()), np.array(votes, np.int8).tobytes())
                for name, value in zip(VOTED.names, row, strict=True):
                    out[name].append(value)
            return out

        return f

    return make


def _vectors(column: pa.Array, m: int) -> np.ndarray:
    """Votes, rows x voters."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(-1, m)


def _fit_shards(label_model: LabelModel, width: int, weight: tuple[float, float]):
    """(n, model): the classifier of each shard, its weights and then its intercept, from rows (shard, label, n_words, at, n, votes) sorted by shard."""

    def run(batches):
        held, shard = [], None

        def fitted():
            x = np.zeros((len(held), width), np.float32)
            for k, (_, n_words, at, n, _) in enumerate(held):
                i, v = values_of(dict(zip(at, n, strict=True)), n_words)
                x[k, i] = v
            votes = np.frombuffer(b"".join(r[-1] for r in held), np.int8).reshape(len(held), -1)
            w, b = train_linear(x, sigmoid(label_model.evidence(votes)).astype(np.float32), weight=np.take(weight, [r[0] for r in held]))  # what the voters say; a row's own label isn't added
            return pa.RecordBatch.from_arrays([pa.array([len(held)], pa.int64()), pa.array([np.append(w.astype(np.float64), b).tobytes()], pa.binary())], names=["n", "model"])

        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                for own, *row in zip(*(c.to_pylist() for c in batch.slice(lo, SLICE_ROWS).columns), strict=True):
                    if own != shard and held:
                        yield fitted()
                        held.clear()
                    shard = own
                    held.append(row)
        if held:
            yield fitted()

    return run


def fit(rows: DataFrame, scratch: Scratch) -> Model:
    """Fit on labelled rows (id, label, text), all of them: rank features, let the voters vote, fit the label model, and fit the classifier to its posteriors.

    Labels rank the features and start the label model; the classifier's targets are the posteriors of the votes alone. The label model
    takes each distinct vector of votes with its number of rows; classifiers are fitted by shards of about SHARD_ROWS rows, dealt
    by a hash of the id, and averaged by their rows.
    """
    n = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):  # nothing to tell apart: the seed lexicon alone
        index = {k: i for i, k in enumerate(sorted(INSULTS))}
        return Model(index, np.full(len(index), 3.0), -2.0)
    ranked = rank_features(rows, n[0], n[1])
    index = {k: i for i, k in enumerate(dict.fromkeys([*ranked, *sorted(INSULTS)]))}
    voted = scratch.save(flat_map(rows.select("id", "label", "text"), VOTED, _votes(index, ranked)), "voted")
    # Rows of the rarer label weigh more, so that both labels weigh the same.
    weight = tuple(max(n.values()) / n[y] for y in (0, 1))
    vectors = voted.groupBy("votes", "label").count().toArrow().sort_by([("label", "ascending"), ("votes", "ascending")]).combine_chunks()
    label_model = LabelModel().fit(_vectors(vectors["votes"], len(voters_of(index, ranked))), vectors["label"].to_numpy(), times=vectors["count"].to_numpy() * np.take(weight, vectors["label"].to_numpy()))
    shards = -(-(n[0] + n[1]) // SHARD_ROWS)
    dealt = voted.select(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), "id", "label", "n_words", "at", "n", "votes").repartition(shards, "shard").sortWithinPartitions("shard", "id")
    total, both = 0, np.zeros(len(index) + 1)
    for size, model in dealt.drop("id").mapInArrow(_fit_shards(label_model, len(index), weight), "n long, model binary").collect():
        total, both = total + size, both + size * np.frombuffer(model, np.float64)
    both /= total
    return Model(index, both[:-1], float(both[-1]), label_model)


def train_linear(x: np.ndarray, target: np.ndarray, steps: int = 400, l2: float = 2e-4, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Adagrad over all rows; weight: what each counts for."""
    share = np.ones(len(x), np.float32) if weight is None else (weight / weight.mean()).astype(np.float32)
    mean = float(np.clip((target * share).mean(), 1e-6, 1 - 1e-6))
    w, b = np.zeros(x.shape[1], np.float32), float(np.log(mean / (1 - mean)))
    squares, square_b = np.full(x.shape[1], 1e-6, np.float32), 1e-6
    for _ in range(steps):
        e = (sigmoid(x @ w + np.float32(b)) - target) * share
        g, gb = (e @ x) / len(e) + l2 * w, float(e.mean())
        squares += g * g
        square_b += gb * gb
        w -= 0.3 * g / np.sqrt(squares)
        b -= 0.3 * gb / np.sqrt(square_b)
    return w, b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on all labelled rows that aren't held out.

    About LABELS ids and labels at a time are broadcast, so the texts of other rows are not moved. Null labels and ids aren't used; an
    id that is labelled twice has its larger label, and one text of its rows.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    usable = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1) & (remainder(id_col, HELD_OUT_MOD) != 0))
    each = scratch.save(few(usable.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("label"))), "labels")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks, rows = max(1, -(-each.count() // LABELS)), None
    for k in range(blocks):
        some = each.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k)
        found = texts.join(F.broadcast(some), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
        part = scratch.save(few(found), f"rows{k}")
        rows = part if rows is None else rows.unionByName(part)
    model = fit(rows, scratch)
    scratch.drop("")
    return model


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """Append a score from 0 to 1. Null and empty texts get the score of a text without features. Other columns stay; there is no shuffle."""

    def make():
        score = model.scorer()
        return lambda values: [[score(v) for v in values]]

    return add_columns(docs, text_col, [T.StructField(name, T.DoubleType())], make)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document; the model reads texts alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_documents(docs, model)
    return scored.select("doc_id", (remainder("doc_id", HELD_OUT_MOD) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
