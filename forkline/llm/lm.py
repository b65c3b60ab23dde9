"""Language-model scoring: a log-bilinear model, trained in numpy by noise-contrastive estimation, over exact corpus counts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .boosting import sigmoid
from .common import SLICE_ROWS, Scratch, few, few_parts, flat_map, remainder
from .words import Words, hashed

#: Rows whose crc32(id) leaves this remainder are held out of all training.
HELD_OUT_MOD = 10
#: Add-constant smoothing of the base.
ALPHA = 0.1
#: Words that are outputs of their own, and classes of the others by their first letters.
OUTPUTS, CLASSES, CLASS_BYTES = 900, 160, 4
#: Words whose counts every worker holds, at most; counts of all others are joined.
HELD_WORDS = 150_000
#: Shards that train in parallel from one start and are averaged: so many, or one for each so many tokens where that is more; and rounds of that.
SHARDS, SHARD_TOKENS, ROUNDS = 12, 20_000_000, 2
#: Models that are averaged in one task, or on the driver.
AVERAGED = 32
#: Dimensions, noise words to a data word, noise words that a batch shares, its examples, and Adagrad's rate.
DIM, NOISE, SHARED_NOISE, BATCH, RATE = 24, 10, 48, 512, 0.5
#: The end of a text, a token beside the hashes of words.
END = 1
#: Counts of slices that a task holds, and examples.
FLUSH, HELD_EXAMPLES = 2_000_000, 500_000

COUNT = T.StructType([T.StructField("word", T.LongType()), T.StructField("prefix", T.LongType()), T.StructField("n", T.LongType())])
_LOWER = np.arange(256, dtype=np.int64)
_LOWER[65:91] += 32


def prefixes_of(words: Words, which: np.ndarray) -> np.ndarray:
    """The first CLASS_BYTES bytes of some of the words as one number each, lower-case, with zeros after a word's end."""
    out, start, end = np.zeros(len(which), np.int64), words.start[which], words.end[which]
    for k in range(CLASS_BYTES):
        at = start + k
        here = at < end
        out[here] |= _LOWER[words.data[at[here]]] << 8 * (CLASS_BYTES - 1 - k)
    return out


def head_of(prefix, k: int):
    """The first k bytes of prefixes (numbers or a column), and whether there are as many."""
    low = 8 * (CLASS_BYTES - k)
    mask, last = (1 << 8 * CLASS_BYTES) - (1 << low), 255 << low
    if isinstance(prefix, np.ndarray):
        return prefix & mask, (prefix & last) != 0
    return prefix.bitwiseAND(F.lit(mask)), prefix.bitwiseAND(F.lit(last)) != 0


def _count_words(df: DataFrame) -> DataFrame:
    """(word, prefix, n) of all tokens, an end for each row; partial sums leave a task after FLUSH of them."""
    schema = to_arrow_schema(COUNT)

    def run(batches):
        held, n, ends = [], 0, 0

        def out():
            word, prefix, count = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(word)
            first = np.flatnonzero(np.diff(word[order], prepend=~word[order[:1]]))
            return pa.RecordBatch.from_arrays([pa.array(word[order[first]]), pa.array(prefix[order[first]]), pa.array(np.add.reduceat(count[order], first))], schema=schema)

        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.column(0).slice(lo, SLICE_ROWS)
                words = hashed(part)
                word, at, count = np.unique(words.hash.view(np.int64), return_index=True, return_counts=True)
                if len(word):
                    held.append((word, prefixes_of(words, at), count))
                n, ends = n + len(word), ends + len(part)
                if n > FLUSH:
                    yield out()
                    held, n = [], 0
        if n:
            yield out()
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (END, 0, ends)], schema=schema)

    return df.mapInArrow(run, COUNT)


@dataclass
class Tokens:
    """What the model knows of words: outputs have ids of their own, then come classes by first bytes; counts of frequent words.

    Arrays of words are sorted; heads has a sorted array of prefixes and their ids for each length.
    """

    output: np.ndarray
    output_id: np.ndarray
    heads: list[tuple[np.ndarray, np.ndarray]]
    n_ids: int
    frequent: np.ndarray
    frequent_count: np.ndarray
    end_id: int = 0

    def classes(self, prefix: np.ndarray) -> np.ndarray:
        """The class of each word, by its longest known prefix."""
        out = np.full(len(prefix), self.n_ids - 1, np.int64)
        for k, (known, ids) in enumerate(self.heads, 1):
            if len(known):
                head, full = head_of(prefix, k)
                at = np.minimum(np.searchsorted(known, head), len(known) - 1)
                hit = full & (known[at] == head)
                out[hit] = ids[at[hit]]
        return out

    @cached_property
    def outputs(self) -> Places:
        return Places(self.output)

    @cached_property
    def held(self) -> Places:
        return Places(self.frequent)

    def ids(self, words: Words) -> np.ndarray:
        """Model ids of words, without ends."""
        at = self.outputs.find(words.hash.view(np.int64))
        out, others = self.output_id.take(at, mode="wrap") if len(self.output_id) else at, np.flatnonzero(at < 0)
        out[others] = self.classes(prefixes_of(words, others))
        return out


class Places:
    """Places of hashes in a sorted array, by the first bits of a hash and a short walk from there; it compares whole hashes."""

    def __init__(self, known: np.ndarray):
        self.shift = 64 - max(8, len(known).bit_length() + 1)
        self.known = np.append(known, np.iinfo(np.int64).max)
        self.size = len(known)
        half = 1 << (63 - self.shift)
        self.first = np.searchsorted(known >> self.shift, np.arange(-half, half)).astype(np.int32)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, -1 where it isn't there."""
        at = self.first.take((values >> self.shift) + len(self.first) // 2).astype(np.int64)
        behind = np.flatnonzero(self.known.take(at) < values)
        while len(behind):
            at[behind] += 1
            behind = behind[self.known[at[behind]] < values[behind]]
        return np.where((self.known.take(at) == values) & (at < self.size), at, -1)


def with_ends(words: Words, ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows' tokens, an end after each row's, and where rows start, with their number last."""
    rows = len(words.row) - 1
    out = np.full(len(ids) + rows, end, np.int64)
    out[np.arange(len(ids)) + np.repeat(np.arange(rows), np.diff(words.row))] = ids
    return out, words.row + np.arange(rows + 1)


def contexts(ids: np.ndarray, start: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The token before each one and the one before that, `none` before a row's first. start: where rows start."""
    a, b = np.full(len(ids), none, np.int64), np.full(len(ids), none, np.int64)
    a[1:], b[2:] = ids[:-1], ids[:-2]
    a[start] = b[start] = none
    b[start[start + 1 < len(ids)] + 1] = none
    return a, b


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words, HELD_WORDS at most, and their counts, most frequent first: all above a count that a histogram finds, so nothing is sorted on the driver's behalf."""
    level = F.floor(8 * F.log2("n")).cast("int")
    sizes = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)  # 8 levels for each doubling
    room, least = HELD_WORDS, 1 << 30
    for x, n in sizes:
        room -= n
        if room < 0:
            break
        least = x
    table = counts.where(level >= least).select("word", "n").toArrow()
    word, n = table["word"].to_numpy(), table["n"].to_numpy()
    order = np.lexsort((word, -n))
    return word[order], n[order]


# ---- the model ----------------------------------------------------------------------------------


@dataclass
class LogBilinear:
    """P(w | a, b) is proportional to exp(q_w . (C1 r_a + C2 r_b) + b_w); a is the token before, b the one before that."""

    r: np.ndarray
    q: np.ndarray
    c: np.ndarray  # 2 x DIM x DIM
    bias: np.ndarray

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 5) -> LogBilinear:
        g, n = np.random.default_rng(seed), len(counts)
        p = (counts + 1) / (counts + 1).sum()
        return cls(0.1 * g.standard_normal((n + 1, DIM)), 0.1 * g.standard_normal((n, DIM)), np.stack([np.eye(DIM), 0.5 * np.eye(DIM)]), np.log(p))

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.q, self.c, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()]).astype(np.float32)

    @classmethod
    def from_flat(cls, v: np.ndarray, n: int) -> LogBilinear:
        parts, at = [], 0
        for shape in ((n + 1, DIM), (n, DIM), (2, DIM, DIM), (n,)):
            size = int(np.prod(shape))
            parts.append(v[at : at + size].reshape(shape).astype(np.float64))
            at += size
        return cls(*parts)

    def squares(self) -> list[np.ndarray]:
        """Adagrad's sums at the start."""
        return [np.full_like(x, 1e-2) for x in self.parts()]

    def train(self, examples: np.ndarray, noise: np.ndarray, seed: int, squares: list[np.ndarray] | None = None) -> None:
        """One pass of noise-contrastive estimation over rows (a, b, w), by Adagrad: the data word against NOISE words of the noise distribution.

        A batch shares SHARED_NOISE noise words, each weighed as NOISE / SHARED_NOISE for every example, so that its products are
        products of matrices. squares: Adagrad's sums, to go on from an earlier pass; they are changed in place.
        """
        g = np.random.default_rng(seed)
        order = g.permutation(len(examples))
        log_noise = np.log(NOISE * noise).astype(np.float32)
        cumulative = np.cumsum(noise)
        squares = self.squares() if squares is None else squares
        # Single precision throughout, in one vector: rows of r and of q, both context matrices side by side, bias.
        vector = lambda y: np.concatenate([x.ravel() for x in (y[0], y[1], np.hstack(y[2]), y[3])]).astype(np.float32)
        all_x, all_s = vector(self.parts()), vector(squares)
        slope, spare, rate = np.zeros_like(all_x), np.empty_like(all_x), np.full_like(all_x, RATE)
        n_r, n_rows, n_out = len(self.r), len(self.r) + len(self.q), len(self.bias)

        def apart(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """The rows, the context matrices and the bias in a vector."""
            return v[: n_rows * DIM].reshape(n_rows, DIM), v[n_rows * DIM : -n_out].reshape(DIM, 2 * DIM), v[-n_out:]

        (x, c, bias), (x_slope, c_slope, bias_slope), (_, c_rate, bias_rate) = apart(all_x), apart(slope), apart(rate)
        c_rate *= np.float32(0.2)
        bias_rate *= np.float32(0.5)
        # Two numbers are added at once, as a complex one.
        places, ones, most = np.arange(x.size // 2).reshape(n_rows, DIM // 2), np.ones(BATCH, np.float32), np.float32(40)
        values, pairs = np.empty((3 * BATCH + SHARED_NOISE, DIM), np.float32), x_slope.reshape(-1).view(np.complex64)
        examples = np.asarray(examples, np.int64).take(order, axis=0)
        drawn = np.minimum(np.searchsorted(cumulative, g.random((-(-len(examples) // BATCH), SHARED_NOISE))), n_out - 1)
        for other, lo in zip(drawn, range(0, len(examples), BATCH), strict=True):
            batch = examples[lo : lo + BATCH]
            n, scale = len(batch), np.float32(1 / np.sqrt(len(batch)))
            # Rows of both context tokens of each example, then of the data words, then of the noise words.
            both = np.concatenate((batch[:, 2], other))
            at = np.concatenate((batch[:, :2].reshape(-1), both + n_r))
            rows, level = x.take(at, axis=0), (bias - log_noise).take(both)
            before, q, qn = rows[: 2 * n].reshape(n, 2 * DIM), rows[2 * n : 3 * n], rows[3 * n :]
            h = before @ c.T
            # Slopes of the loss by the data words' scores and by the noise words', over the root of the batch's size.
            e = (sigmoid(np.einsum("nd,nd->n", h, q) + level[:n]) - np.float32(1)) * scale
            en = h @ -qn.T
            en -= level[n:]
            np.exp(np.minimum(en, most, out=en), out=en)
            en += np.float32(1)
            np.divide(np.float32(NOISE / SHARED_NOISE) * scale, en, out=en)
            dh = en @ qn
            dh += e[:, None] * q
            own = values[: len(at)]
            np.matmul(dh, c, out=own[: 2 * n].reshape(n, 2 * DIM))
            np.multiply(e[:, None], h, out=own[2 * n : 3 * n])
            np.matmul(en.T, h, out=own[3 * n :])
            pairs.fill(0)
            np.add.at(pairs, places.take(at, axis=0).reshape(-1), own.reshape(-1).view(np.complex64))
            np.matmul(dh.T, before, out=c_slope)
            bias_slope[:] = np.bincount(both, np.concatenate((e, ones[:n] @ en)), n_out)
            all_s += np.multiply(slope, slope, out=spare)
            np.divide(slope, np.sqrt(all_s, out=spare), out=spare)
            spare *= rate
            all_x -= spare
        for v, parts in ((all_x, self.parts()), (all_s, squares)):
            rows, sides, last = apart(v)
            for into, part in zip(parts, (rows[:n_r], rows[n_r:], np.stack(np.hsplit(sides, 2)), last), strict=True):
                into[:] = part

    def normalisers(self) -> np.ndarray:
        """log of the sum over all words, for every context (a, b), in batches of matrix products."""
        ha, hb = (self.r @ self.c[0].T).astype(np.float32), (self.r @ self.c[1].T).astype(np.float32)
        q, bias = self.q.astype(np.float32).T, self.bias.astype(np.float32)
        out = np.empty((len(ha), len(hb)), np.float32)
        # exp(x + y) over words is a product of two factors, so one product of matrices gives a row of sums.
        left, right = ha @ q + bias, hb @ q
        ml, mr = left.max(axis=1), right.max(axis=1)
        el, er = np.exp(left - ml[:, None]), np.exp(right - mr[:, None])
        for lo in range(0, len(ha), 256):
            sums = el[lo : lo + 256] @ er.T
            out[lo : lo + 256] = np.log(np.maximum(sums, 1e-30)) + ml[lo : lo + 256, None] + mr
        return out

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What scoring reads: words' scores after each first and second context token, and the normalisers."""
        ha, hb = self.r @ self.c[0].T, self.r @ self.c[1].T
        return (ha @ self.q.T + self.bias).astype(np.float32), (hb @ self.q.T).astype(np.float32), self.normalisers()


#: The model ids of a training text with its end, as 16-bit numbers; each is an example, and the two before it are its context.
EXAMPLE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.BinaryType())])
#: A shard's examples, and the model and Adagrad's sums after them.
TRAINED = T.StructType([T.StructField("n", T.LongType()), T.StructField("model", T.BinaryType())])
SCORED = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("known", T.LongType()),
        T.StructField("base", T.DoubleType()),
        T.StructField("model", T.DoubleType()),
        T.StructField("word", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("norm", T.DoubleType()),
    ]
)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the whole text).

    Counts are exact sums over all training tokens; a word is known by a 64-bit hash. The model has 900 words and the end as outputs of their own, and
    160 classes of all other words by their first letters; such a word has its class's probability times its smoothed
    share of the class, so its context score is its class's. Every training token is an example. Shards, dealt by a hash of the id and
    sorted by it, train from one start and are averaged by their tokens, two times; Adagrad's sums go on. There are as many as the tokens ask
    for, and averages are taken in steps of AVERAGED models. Counts of the most frequent words, 150,000 at most, are sent to the workers; other words are joined with the table of counts, pre-aggregated by row. A null or empty text is an end alone; a null id is
    held out, as the checksum of the empty text is 0; rows that repeat an id are each scored; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    training = source.where(remainder("doc_id", HELD_OUT_MOD) != 0)
    counts = scratch.save(few(_count_words(training.select("text")).groupBy("word").agg(F.min("prefix").alias("prefix"), F.sum("n").alias("n")).where("n > 0")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    frequent, frequent_count = _frequent(counts)
    output = np.array(list(dict.fromkeys([END, *frequent[:OUTPUTS].tolist()])), np.int64)
    # Classes: the prefixes that hold most of what the outputs leave, longer ones splitting their shorter ones.
    left = counts.join(F.broadcast(spark.createDataFrame([(w,) for w in output.tolist()], "word long")), "word", "left_anti")
    mass: dict[tuple[int, int], int] = {}
    for k in range(1, CLASS_BYTES + 1):
        head, full = head_of(F.col("prefix"), k)
        for r in left.where(full).groupBy(head.alias("p")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "p").limit(CLASSES).collect():
            mass[k, r[0]] = r[1]
    chosen = sorted(mass, key=lambda p: (-mass[p], p))[: CLASSES - 1]
    n_ids = len(output) + len(chosen) + 1
    heads = []
    for k in range(1, CLASS_BYTES + 1):
        own = sorted((p, len(output) + i) for i, (size, p) in enumerate(chosen) if size == k)
        heads.append((np.array([p for p, _ in own], np.int64), np.array([i for _, i in own], np.int64)))
    by_word, by_output = np.argsort(frequent), np.argsort(output)
    tokens = Tokens(output[by_output], by_output, heads, n_ids, frequent[by_word], frequent_count[by_word].astype(np.float64))
    shared = spark.sparkContext.broadcast(tokens)
    id_counts, class_mass, class_words = np.zeros(n_ids), np.zeros(n_ids), np.zeros(n_ids)
    for k, n, v in left.select("prefix", "n").mapInArrow(_by_class(shared), "id long, n long, words long").groupBy("id").agg(F.sum("n"), F.sum("words")).collect():
        id_counts[k], class_mass[k], class_words[k] = n, n, v
    places = tokens.held.find(output)
    id_counts[: len(output)][places >= 0] = tokens.frequent_count[places[places >= 0]]

    def examples():
        known = shared.value

        def f(batch: pa.RecordBatch) -> dict:
            words = hashed(batch.column(1))
            ids, start = with_ends(words, known.ids(words), known.end_id)
            ids = ids.astype(np.int16)
            return {"doc_id": batch.column(0), "ids": [ids[lo:hi].tobytes() for lo, hi in zip(start[:-1], start[1:], strict=True)]}

        return f

    model = LogBilinear.start(id_counts)
    if total:
        noise = (id_counts + 1) / (id_counts + 1).sum()
        rows = scratch.save(flat_map(training, EXAMPLE, examples), "examples")
        shards, squares = max(SHARDS, -(-total // SHARD_TOKENS)), model.squares()
        for turn in range(ROUNDS):
            state = spark.sparkContext.broadcast((model.flat(), np.concatenate([x.ravel() for x in squares]).astype(np.float32)))
            dealt = rows.repartition(shards, "doc_id").sortWithinPartitions("doc_id", "ids").select("ids")
            # A task averages the shards it trains one after another; few tables and files are written, as each file costs a process on a local disk.
            trained, left_over, step = few(dealt.mapInArrow(_shard(state, noise, n_ids, turn), TRAINED), AVERAGED).mapInArrow(_averaged, TRAINED), min(shards, few_parts(spark, AVERAGED)), 0
            while left_over > AVERAGED:
                trained = scratch.save(trained, f"models{turn}-{step}")
                left_over, step = -(-left_over // AVERAGED), step + 1
                trained = trained.repartition(left_over).mapInArrow(_averaged, TRAINED)
            _, both = average((r[0], np.frombuffer(r[1], np.float32)) for r in trained.collect())
            if both is not None:
                model = LogBilinear.from_flat(both[: len(both) // 2], n_ids)
                squares = LogBilinear.from_flat(both[len(both) // 2 :], n_ids).parts()
        scratch.drop("examples")
    score = scratch.save(_score(source, spark, shared, model, class_mass, class_words, total, distinct), "scored")
    # Rare words: exact counts by a join; few rows share a word, as frequent ones never come here.
    rare = score.where("word is not null").select("row", "word", "n", "norm").join(counts.select("word", F.col("n").alias("c")), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    smooth = F.log10(F.col("c") + ALPHA)
    per_row = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known2"),
        F.sum(F.col("n") * (smooth - F.lit(float(np.log10(total + ALPHA * (distinct + 1)))))).alias("base2"),
        F.sum(F.col("n") * (smooth - F.col("norm"))).alias("model2"),
    )
    add = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    out = few(score.where("word is null").join(per_row, "row", "left"))
    return out.select(
        F.col("doc_id").alias(id_col),
        (remainder("doc_id", HELD_OUT_MOD) == 0).alias("held_out"),
        "n_tokens",
        add("known", "known2").cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        add("base", "base2").cast("double").alias("base_score"),
        add("model", "model2").cast("double").alias("score"),
    )


def _by_class(shared):
    """(id, n, words) of a task's words, one row for each class."""

    def run(batches):
        known = shared.value
        n, words = np.zeros(known.n_ids), np.zeros(known.n_ids)
        for batch in batches:
            at = known.classes(batch.column(0).to_numpy())
            n += np.bincount(at, batch.column(1).to_numpy(), known.n_ids)
            words += np.bincount(at, minlength=known.n_ids)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at].astype(np.int64)), pa.array(words[at].astype(np.int64))], names=["id", "n", "words"])

    return run


def average(models) -> tuple[int, np.ndarray | None]:
    """The mean of (n, numbers), weighted by n, and the sum of all n."""
    total, out = 0, None
    for n, v in models:
        if n:
            out = v.astype(np.float64) * n if out is None else out + v.astype(np.float64) * n
            total += n
    return total, None if out is None else (out / total).astype(np.float32)


def _averaged(batches):
    rows = ((n, np.frombuffer(raw, np.float32)) for batch in batches for n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    n, v = average(rows)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([v.tobytes()], pa.binary())], names=["n", "model"])


def _shard(state, noise: np.ndarray, n_ids: int, turn: int):
    def run(batches):
        flat, sums = state.value
        model, squares = LogBilinear.from_flat(flat, n_ids), LogBilinear.from_flat(sums, n_ids).parts()
        held, waiting, seen = [], 0, 0

        def pass_over():
            ids = np.concatenate(held)
            a, b = contexts(ids, np.cumsum([0, *map(len, held[:-1])]), n_ids)
            model.train(np.stack((a, b, ids), axis=1), noise, 1009 * turn + seen, squares)
            held.clear()

        for batch in batches:
            for raw in batch.column(0):
                held.append(np.frombuffer(raw.as_buffer(), np.int16))
                seen += len(held[-1])
                waiting += len(held[-1])
                if waiting > HELD_EXAMPLES:
                    pass_over()
                    waiting = 0
        if held:
            pass_over()
        if seen:
            both = np.concatenate([model.flat(), *(x.ravel().astype(np.float32) for x in squares)])
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([both.tobytes()], pa.binary())], names=["n", "model"])

    return run


def _score(source: DataFrame, spark: SparkSession, shared, model: LogBilinear, class_mass, class_words, total: int, distinct: int) -> DataFrame:
    """One row per document with what frequent words give, and one per document and other word."""
    tables = spark.sparkContext.broadcast((*model.tables(), class_mass, class_words))
    schema = to_arrow_schema(SCORED)

    def run(batches):
        from pyspark import TaskContext

        known = shared.value
        first, second, norm, mass, words = tables.value
        done = TaskContext.get().partitionId() << 40
        base_norm = np.log10(total + ALPHA * (distinct + 1))
        class_norm = np.log10(mass + ALPHA * (words + 1))
        log_count = np.log10(np.append(known.frequent_count, 0) + ALPHA)  # the last is for words that aren't held
        at_end = int(known.held.find(np.array([END]))[0])
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                text = hashed(part.column(1))
                rows, ids = part.num_rows, known.ids(text)
                tokens, start = with_ends(text, ids, known.end_id)
                a, b = contexts(tokens, start[:-1], known.n_ids)
                log_p = np.add.reduceat((first[a, tokens] + second[b, tokens] - norm[a, b]).astype(np.float64), start[:-1]) / np.log(10)
                of, at = np.repeat(np.arange(rows), np.diff(text.row)), known.held.find(text.hash.view(np.int64))
                held = at >= 0
                in_class = held & (ids >= len(known.output))
                base = np.bincount(of[held], log_count[at[held]] - base_norm, rows) + log_count[at_end] - base_norm
                share = np.bincount(of[in_class], log_count[at[in_class]] - class_norm[ids[in_class]], rows)
                n_held = np.bincount(of[held], minlength=rows) + (at_end >= 0)
                row = done + np.arange(rows)
                done += rows
                # Other words: one entry for each row and word.
                word, own, norms = text.hash.view(np.int64)[~held], of[~held], class_norm[ids[~held]]
                order = np.lexsort((word, own))
                word, own, norms = word[order], own[order], norms[order]
                new = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(word, prepend=0) != 0)) if len(word) else np.empty(0, np.int64)
                n = np.diff(new, append=len(word))
                none = lambda k, kind: pa.nulls(k, kind)
                yield pa.RecordBatch.from_arrays([pa.array(row), part.column(0), pa.array(np.diff(start)), pa.array(n_held), pa.array(base), pa.array(log_p + share), none(rows, pa.int64()), none(rows, pa.int64()), none(rows, pa.float64())], schema=schema)
                if len(new):
                    k = len(new)
                    yield pa.RecordBatch.from_arrays([pa.array(row[own[new]]), none(k, pa.int64()), none(k, pa.int64()), none(k, pa.int64()), none(k, pa.float64()), none(k, pa.float64()), pa.array(word[new]), pa.array(n), pa.array(norms[new])], schema=schema)

    return source.mapInArrow(run, SCORED)


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every document."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
