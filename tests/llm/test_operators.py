"""Every operator over awkward rows, an empty table, and against a brute-force version."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from forkline.llm import bpe, decontaminate, gif, lm, minhash, pii, sharding, substring, toxicity, warc

from forkline.llm.words import hashed

from .corpus import SCHEMA, documents, prose, words

ROWS = documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(rows, name="doc_id"):
    return collections.Counter(r[name] for r in rows)


ALL_IDS = collections.Counter(r[0] for r in ROWS)


# ---- substring dedup


def hash_of(word: bytes) -> int:
    return int(hashed(pa.array([word.decode()])).hash[0])


def units(text: str) -> list[list[bytes]]:
    out = []
    for line in (text or "").encode().lower().split(b"\n"):
        sentence, found = [], []
        for w in line.split():
            sentence.append(w)
            if w.endswith((b".", b"!", b"?")):
                found.append(sentence)
                sentence = []
        found += [sentence] if sentence else []
        for s in found:
            pieces = [[]]
            for w in s:
                pieces[-1].append(w)
                if len(s) > substring.LONG_SENTENCE and (hash_of(w) >> 20) % substring.CUT_EVERY == 0:
                    pieces.append([])
            for piece in filter(None, pieces):
                step = substring.PIECE if len(piece) > substring.LONG_SENTENCE else len(piece)
                out += [piece[k : k + step] for k in range(0, len(piece), step)]
    return out


def test_substring_dedup_equals_brute_force(spark):
    r = random.Random(4)
    shared = [prose(r, 60) for _ in range(3)]
    rows = [(i, " ".join([prose(r, r.randint(0, 40)), r.choice(shared), prose(r, r.randint(0, 40))]) + ("\n" + shared[0] if i % 7 == 0 else "")) for i in range(40)]
    rows += [(50 + i, f"{prose(r, 20)} " + "over " * (60 + 9 * i) + prose(r, 20)) for i in range(3)]
    got = {x["doc_id"]: x for x in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen = set()
    for i, text in rows:
        u = units(text)
        gone = [False] * len(u)
        for a in range(len(u)):
            b, n = a, 0
            while b < len(u) and (b - a < substring.RUN_SENTENCES or n < substring.RUN_WORDS):
                n += len(u[b])
                b += 1
            if b - a < substring.RUN_SENTENCES or n < substring.RUN_WORDS:
                continue
            key = tuple(w for s in u[a:b] for w in s)
            if key in seen:
                gone[a:b] = [True] * (b - a)
            seen.add(key)
        assert (got[i]["n_sentences"], got[i]["n_removed"]) == (len(u), sum(gone))
        assert got[i]["clean_text"].encode().lower().split() == [w for s, g in zip(u, gone, strict=True) if not g for w in s]
    assert sum(x["n_removed"] for x in got.values()) > 100
    assert all(x["first_docs"] == [] for i, x in got.items() if not x["n_removed"])


def test_substring_dedup_takes_awkward_rows(docs, empty):
    rows = substring.remove_repeats(docs).collect()
    assert ids(rows) == ALL_IDS
    by = {r["doc_id"]: r for r in rows}
    assert by[1000]["clean_text"] is None and by[1001]["clean_text"] == "" and by[1002]["n_sentences"] == 0
    assert by[1007]["n_removed"] > 0.9 * by[1007]["n_sentences"] and by[1006]["n_removed"] == 0
    assert substring.remove_repeats(empty).count() == 0


# ---- language model


def test_base_scores_equal_brute_force_and_the_model_is_normalised(docs, empty):
    rows = lm.score_texts(docs).collect()
    assert ids(rows) == ALL_IDS
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t, _ in ROWS]
    c = collections.Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    expected = sorted((i is not None, i or 0, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for i, ws in tokens)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == expected
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert lm.score_texts(empty).count() == 0


def test_every_training_token_is_an_example(docs, monkeypatch):
    seen, save = [], lm.Scratch.save

    def spy(self, df, name):
        out = save(self, df, name)
        if name == "examples":
            seen.append(sum(len(r["ids"]) // 2 if "ids" in r else 1 for r in out.collect()))
        return out

    monkeypatch.setattr(lm.Scratch, "save", spy)
    assert seen == [] and [lm.score_texts(docs).first()["train_tokens"]] == seen


def test_normalisers_sum_to_one_and_training_beats_the_unigram():
    g = np.random.default_rng(0)
    n = 30
    chain = [int(g.integers(n))]
    for _ in range(20_000):
        chain.append(int((chain[-1] * 7 + 3) % n) if g.random() < 0.8 else int(g.integers(n)))
    ids_ = np.array(chain)
    examples = np.stack([ids_[1:-1], ids_[:-2], ids_[2:]], axis=1)
    counts = np.bincount(ids_, minlength=n).astype(float)
    model = lm.LogBilinear.start(counts)
    noise = (counts + 1) / (counts + 1).sum()
    for turn in range(4):
        model.train(examples, noise, turn)
    first, second, norm = model.tables()
    p = np.exp(first[:, None, :] + second[None, :, :] - norm[:, :, None])
    assert np.allclose(p.sum(axis=2), 1, atol=1e-4)
    a, b, w = examples.T
    assert np.log(p[a, b, w]).mean() > np.log(noise[w]).mean() + 0.5


def test_places_of_hashes_equal_a_binary_search():
    g = np.random.default_rng(2)
    known = np.unique(np.concatenate([g.integers(-(2**63), 2**63, 3000), np.arange(40), [2**63 - 1, -(2**63)]]))
    values = np.concatenate([known, known + 1, g.integers(-(2**63), 2**63, 500), [1, -1]])
    for part in (known, known[:1], known[:-1], known[:0]):
        where = {int(x): k for k, x in enumerate(part)}
        assert lm.Places(part).find(values).tolist() == [where.get(int(x), -1) for x in values]


def test_many_shards_leave_few_files_and_are_all_trained(docs, monkeypatch):
    parts, trained, save, average = [], [], lm.Scratch.save, lm.average

    def spy(self, df, name):
        out = save(self, df, name)
        parts.append(len(out.inputFiles()))
        return out

    def weighed(models):
        n, v = average(models)
        trained.append(n)
        return n, v

    monkeypatch.setattr(lm.Scratch, "save", spy)
    monkeypatch.setattr(lm, "average", weighed)
    monkeypatch.setattr(lm, "SHARDS", 150)
    first = lm.score_texts(docs).first()
    assert trained == [first["train_tokens"]] * lm.ROUNDS  # on the driver: the tokens of all shards
    assert max(parts) <= max(lm.AVERAGED, 4 * docs.sparkSession.sparkContext.defaultParallelism)


# ---- WARC


def test_warc_round_trip_and_revisits(spark, tmp_path):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\nx\r\n\r\nWARC/1.1\r\n\r\n"
    html = {5: "a", 3: "a", 9: "a", 1: "", 2: None, 4: tricky, 8: tricky, 7: "Ü" * 70_000, 6: "unique\r\n\r\n"}
    rows = [(i, f"http://x/{i}\r\nX: y", h, "extra") for i, h in html.items()] + [(6, "http://x/6", "unique\r\n\r\n", "extra"), (None, None, "a", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    warc.write_archives(pages, f"file://{tmp_path}/a")
    records = warc.read_archives(spark, f"file://{tmp_path}/a").cache()
    got = warc.resolve_revisits(records).collect()
    assert len(got) == len(rows)
    first: dict[str, int] = {}
    for i, _, h, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(h or "", i)
    for r in got:
        text = html[r["page_id"]] if r["page_id"] is not None else "a"
        raw = (text or "").encode()
        assert r["payload_bytes"] == len(raw) and r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        own = first[text or ""] == r["page_id"]
        assert r["record_type"] == ("response" if own else "revisit") and r["refers_to"] == (None if own else first[text or ""])
    bodies = {r["page_id"]: r["payload"] for r in records.where("record_type = 'response'").collect()}
    assert bodies[4] == tricky.encode() and bodies[7] == ("Ü" * 70_000).encode()
    warc.write_archives(pages.limit(0), f"file://{tmp_path}/b")
    assert warc.read_archives(spark, f"file://{tmp_path}/b").count() == 0


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    warc.write_archives(pages, f"file://{tmp_path}/c", min_bytes=5)
    assert {r["page_id"]: r["record_type"] for r in warc.read_archives(spark, f"file://{tmp_path}/c").collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


# ---- sharding


def test_shards_hold_groups_and_are_balanced(docs, empty):
    rows = sharding.shard_documents(docs, 5).collect()
    assert ids(rows) == ALL_IDS
    for s in range(5):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    texts = collections.defaultdict(set)
    by = {r["doc_id"]: r for r in rows}
    for i, t, _ in ROWS:
        if i is not None:
            texts[t or ""].add(by[i]["shard"])
            assert by[i]["size"] == len((t or "").encode()) + 8 and by[i]["text_crc32"] == zlib.crc32((t or "").encode())
    assert all(len(s) == 1 for s in texts.values())
    assert sharding.shard_documents(empty, 5).count() == 0


def test_bytes_are_near_equal_where_groups_allow(spark):
    r = random.Random(2)
    df = spark.createDataFrame([(i, prose(r, r.randint(1, 60))) for i in range(2000)], "doc_id long, text string")
    loads = [x[0] for x in sharding.shard_documents(df, 8).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(loads) == 8 and max(loads) - min(loads) < 0.01 * sum(loads) / 8 + 400


def lpt(sizes, shards):
    """Loads of the schedule that takes each size by itself."""
    loads = [0] * shards
    for size in sorted(sizes, reverse=True):
        loads[min(range(shards), key=lambda j: (loads[j], j))] += size
    return loads


def test_schedule_takes_the_least_loaded_shard_for_each_group():
    r = random.Random(4)
    for _ in range(200):
        shards = r.randint(1, 7)
        classes = {r.randint(1, 90): r.choice((1, 2, 5, r.randint(1, 200))) for _ in range(r.randint(1, 12))}
        plan = sharding.Schedule(shards)
        for size in sorted(classes, reverse=True):
            dealt = plan.take(size, classes[size])
            assert sum(dealt.values()) == classes[size] and list(dealt) == sorted(dealt) and all(dealt.values())
        assert [load for load, _ in sorted(plan.heap, key=lambda x: x[1])] == lpt([s for s, n in classes.items() for _ in range(n)], shards)


@pytest.mark.parametrize("piece, hot", [(50_000, 4096), (40, 4096), (40, 3)])
def test_all_groups_are_scheduled_one_by_one(spark, monkeypatch, piece, hot):
    """Loads equal brute force with many texts of one size, a group of a third of the rows, nulls and repeated ids; partitions, buckets and joins don't matter."""
    monkeypatch.setattr(sharding, "ROWS_PER_PIECE", piece)
    monkeypatch.setattr(sharding, "HOT", hot)
    r = random.Random(5)
    texts = [f"{k:05d}" for k in range(400)] + ["of one text"] * 500 + [prose(r, r.randint(1, 60)) for _ in range(500)] + [None, "", ""]
    rows = [(k // 2, t) for k, t in enumerate(texts)]
    sizes = collections.Counter()
    for _, t in rows:
        sizes[t or ""] += len((t or "").encode()) + 8
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shard_documents(df.repartition(13), 8).collect()
    loads = collections.Counter()
    for x in out:
        loads[x["shard"]] += x["size"]
    assert len(out) == len(rows) and [loads[s] for s in range(8)] == lpt(sizes.values(), 8)
    assert all(sorted(x["slot"] for x in out if x["shard"] == s) == list(range(sum(x["shard"] == s for x in out))) for s in range(8))
    assert collections.Counter(out) == collections.Counter(sharding.shard_documents(df.repartition(2), 8).collect())


# ---- personal data

BASE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def base_by_regex(t: str):
    out = [("email", *m.span()) for m in BASE_EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in pii.IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in pii.CARD.finditer(t):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in pii.PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))


def test_base_spans_equal_the_patterns():
    r = random.Random(3)
    pieces = ["a.b@c.de", "@", "x@y", "x@y.", "..@a.b", "a@b.c@d.e", "%+-@z-.q", "1.2.3.4", "1.2.3.4.5", "300.1.1.1", "0001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "4242424242424242", "+1 (555) 010-9999", "+12", "+1..2--345678", "é", "９９", " ", "-", "0", "12", "\n", "+", "(", "."]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 12)))
        assert pii.base_spans(text) == base_by_regex(text), text


def test_taken_places_equal_a_comparison_of_all_pairs():
    r = random.Random(12)
    for _ in range(300):
        taken, held = pii.Taken(), []
        for s, e in sorted((s, s + r.randint(1, 9)) for s in (r.randrange(60) for _ in range(r.randrange(5)))):
            taken.add(s, e)
            held.append((s, e))
        for _ in range(30):
            s = r.randrange(70)
            e = s + r.randint(1, 9)
            free = not any(a < e and s < b for a, b in held)
            assert taken.free(s, e) == free
            if free:
                taken.add(s, e)
                held.append((s, e))


def test_added_spans_keep_the_base_and_are_learned(docs, empty):
    d = pii.train()
    for text in ("mail to jan.roe(at)host(dot)org today", "call 0049 555 123 4567 now", "tel: (555) 123-4567."):
        base, spans = d.spans(text)
        assert not base and len(spans) == 1, text
    for text in ("version 300.400.500.600 of it", "they were at home. And then", "order 2021-555-777", ""):
        assert d.spans(text) == ([], []), text
    base, spans = d.spans("a@b.com and 4111 1111 1111 1111 at x")
    assert set(base) <= set(spans)
    rows = pii.find_personal_data(docs).collect()
    assert ids(rows) == ALL_IDS and not any(r["spans"] for r in rows if r["text"] is None)
    assert pii.find_personal_data(empty).count() == 0


def test_thresholds_hold_on_new_lines():
    d, rows = pii.train(), pii._examples(1500, 123)
    x, y = np.array([pii.features(*e[:4]) for e in rows]), np.array([e[4] for e in rows])
    least = np.array([d.least[pii.KINDS[int(k)]] for k in x[:, 0]])
    chosen = d.probabilities(x) >= least
    assert y[chosen].mean() > 0.95 and y[chosen].sum() > 0.8 * y.sum()


def test_redaction(spark):
    df = spark.createDataFrame([(1, "write a@b.com or +1 555 010 9999!"), (2, None), (3, "")], "doc_id long, text string")
    got = {r[0]: r[1] for r in pii.redact(df).collect()}
    assert got == {1: "write [EMAIL] or [PHONE]!", 2: None, 3: ""}


# ---- toxicity


def test_toxicity_learns_from_labels_and_takes_awkward_rows(spark, docs, empty):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        w = words(r, r.randint(20, 80))
        toxic = r.random() < 0.3
        for _ in range(r.randint(3, 6) if toxic else 0):
            w[r.randrange(len(w))] = r.choice(["scum", "moron", "grumblefoo", "grumblebar"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic if r.random() > 0.03 else not toxic)))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(df, lab)
    got = {x[0]: x[1] for x in toxicity.score_documents(df, model).select("doc_id", "score").collect()}
    held = [(got[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held for b, y in held if x == 1 and y == 0]
    assert sum(pairs) / len(pairs) > 0.9
    scored = toxicity.score_documents(docs, model, name="toxic_score").collect()
    assert ids(scored) == ALL_IDS and all(0 <= x["toxic_score"] <= 1 for x in scored)
    again = toxicity.score_documents(docs, model)  # the column score is there already, and is replaced
    assert again.columns.count("score") == 1 and sorted(again.columns) == sorted(docs.columns)
    assert {x["doc_id"]: x["score"] for x in again.collect()} == {x["doc_id"]: x["toxic_score"] for x in scored}
    assert toxicity.score_documents(empty.drop("score"), toxicity.train(empty, lab.limit(0))).count() == 0


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    """More rows of a label than any sample that was taken, in several shards and blocks of labels; held-out rows have no part."""
    r = random.Random(12)
    plain = words(r, 40)
    rows = [(i, " ".join(r.choice(plain) for _ in range(12)) + (" grumblefoo scum" if i % 4 == 0 else "")) for i in range(9000)]
    labels = [(i, int(i % 4 == 0)) for i, _ in rows]
    seen, linear, ranked = [], toxicity.LabelModel.fit, []

    def spy(self, votes, gold, rounds=25, times=None):
        seen.append({y: round(times[gold == y].sum()) for y in (0, 1)})  # both labels weigh the same
        return linear(self, votes, gold, rounds, times)

    def rank(sample, n0, n1, rank=toxicity.rank_features):
        ranked.append((n0, n1))
        return rank(sample, n0, n1)

    monkeypatch.setattr(toxicity.LabelModel, "fit", spy)
    monkeypatch.setattr(toxicity, "rank_features", rank)
    monkeypatch.setattr(toxicity, "LABELS", 2500)
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    used = [y for i, y in labels if zlib.crc32(str(i).encode()) % 5]
    assert seen == [{0: used.count(0), 1: used.count(0)}] and ranked == [(used.count(0), used.count(1))]
    assert used.count(0) > 5000 and len(used) > toxicity.SHARD_ROWS
    score = model.scorer()
    assert score("grumblefoo scum " + rows[1][1]) > 0.5 > score(rows[1][1])


def test_label_model_takes_repeated_rows_once_with_their_number(monkeypatch):
    g = np.random.default_rng(4)
    votes, gold = g.integers(-1, 2, (300, 4)), g.integers(-1, 2, 300)
    times = g.integers(1, 4, 300)
    one = toxicity.LabelModel().fit(np.repeat(votes, times, axis=0), np.repeat(gold, times))
    monkeypatch.setattr(toxicity, "CHUNK", 70)
    other = toxicity.LabelModel().fit(votes, gold, times=times.astype(float))
    assert np.allclose(one.evidence(votes), other.evidence(votes)) and np.allclose(one.correlation, other.correlation)


def test_label_model_finds_accuracies_and_damps_copies():
    g = np.random.default_rng(1)
    y = (g.random(3000) < 0.4).astype(int)
    vote = lambda right: np.where(g.random(3000) < right, 2 * y - 1, 1 - 2 * y)
    good, bad = vote(0.9), vote(0.6)
    votes = np.stack([good, vote(0.8), bad, bad, bad, bad], axis=1)
    m = toxicity.LabelModel().fit(votes, np.where(np.arange(3000) < 300, y, -1))
    gain = m.log_odds[:, 2] - m.log_odds[:, 0]
    assert gain[0] > gain[1] > gain[2] > 0
    assert m.weight[2] < 0.6 * m.weight[0]
    assert ((m.evidence(votes) > 0) == y).mean() > 0.88


def test_the_label_models_posterior_is_bayes_rule_over_its_tables():
    g = np.random.default_rng(4)
    votes = g.integers(-1, 2, (400, 4))
    m = toxicity.LabelModel().fit(votes, np.where(g.random(400) < 0.5, (votes[:, 0] > 0).astype(int), -1))
    for row, got in zip(votes.tolist(), m.evidence(votes).tolist(), strict=True):
        odds = m.prior / (1 - m.prior)
        for k, v in enumerate(row):
            odds *= np.exp(m.log_odds[k][v + 1]) ** m.weight[k]
        assert abs(np.log(odds) - got) < 1e-9


# ---- tokens


def test_tokens_equal_the_ranks_and_come_back(docs, empty):
    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.encode_documents(docs).collect()
    assert ids(rows) == ALL_IDS
    for r in rows:
        assert list(r["ids"]) == other.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["ids"]) and bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode_documents(empty).count() == 0


def test_offsets_and_split_characters():
    c = bpe.codec(*bpe.default_paths())
    text = "<|endoftext|> I'll pay 5€ \U0001f600‍\U0001f525 naïve  x  \n\n y"
    (got, offsets), *_ = c.encode_with_offsets([text])
    assert c.encode([text])[0].tolist() == got and c.decode_bytes(got) == text.encode()
    assert all(text[a:b].encode().find(c.table[i]) >= 0 for i, (a, b) in zip(got, offsets, strict=True))
    parts = list(c.decode_stream(got))
    assert "".join(parts) == text and "" in parts[:-1]
    assert len(set(bpe.byte_to_char().values())) == 256


# ---- near duplicates


def brute_components(rows):
    sets, top = {}, {}
    for k, (i, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets[k] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
        top[k] = k

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    keys = list(sets)
    for x in keys:
        for y in keys[:x]:
            both = len(sets[x] & sets[y])
            linked = both and 100 * both >= 75 * len(sets[x] | sets[y])
            same = rows[x][0] is not None and rows[x][0] == rows[y][0] and sets[x] and sets[y]
            if rows[x][0] is not None and rows[y][0] is not None and (linked or same):
                top[root(x)] = root(y)
    least: dict[int, int] = {}
    for k in keys:
        if rows[k][0] is not None:
            least[root(k)] = min(least.get(root(k), rows[k][0]), rows[k][0])
    return sorted(((rows[k][0] is not None, rows[k][0] or 0), len(sets[k]), None if rows[k][0] is None else least[root(k)] if sets[k] else rows[k][0]) for k in keys)


def as_tuples(rows):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in rows)


def test_components_equal_brute_force(docs, empty):
    rows = minhash.near_duplicates(docs).collect()
    assert as_tuples(rows) == brute_components([(i, t) for i, t, _ in ROWS])
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert minhash.near_duplicates(empty).count() == 0


def test_large_groups_of_near_copies_and_repeated_ids(spark):
    r = random.Random(9)
    base = words(r, 120)
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = words(r, 1)[0]
        rows.append((i, " ".join(w)))
    edge = words(r, 39)  # 35 shingles; the others share 30 of 40: just linked
    rows += [(500, " ".join(edge)), (501, " ".join(edge[:34] + words(r, 5))), (502, " ".join(edge[:33] + words(r, 6)))]
    rows += [(500, "quite another text of some words that repeats an id")]
    rows += [(503, "quite another text of some words that repeats an id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_tuples(minhash.near_duplicates(df).collect()) == brute_components(rows)


def test_no_link_is_lost_in_a_large_group_of_heavily_edited_copies(spark):
    r = random.Random(1)
    base, rows = words(r, 240), []
    for i in range(400):
        w = list(base)
        for _ in range(r.randint(5, 10)):
            w[r.randrange(len(w))] = words(r, 1)[0]
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_tuples(minhash.near_duplicates(df).collect()) == brute_components(rows)


def test_components_of_a_long_path(spark):
    n = 200
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long")
    got = minhash.components(links, minhash.Scratch(spark, "test")).collect()
    assert len(got) == n and {r["component"] for r in got} == {0}


# ---- media


def test_gif_columns_round_trip(docs, empty):
    rows = gif.payload_features(gif.store_payloads(docs)).collect()
    assert ids(rows) == ALL_IDS
    for r in rows:
        raw = (r["text"] or "").encode()
        full = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:]))
    assert gif.payload_features(gif.store_payloads(empty)).count() == 0
    frames = gif.read_frames(gif.store_payloads(docs.where("doc_id = 1006")).drop("text")).first()["frames"]
    assert len(frames) > 5 and [f["start_cs"] for f in frames] == [4 * k for k in range(len(frames))]
    assert all(sum(f["histogram"][:8]) == 64 * 256 for f in frames)


@pytest.mark.parametrize("bits", [2, 4, 8])
def test_lzw_round_trip(bits):
    r = random.Random(bits)
    top = 1 << bits
    for data in (b"", b"\0", bytes(5000), bytes(r.randrange(top) for _ in range(30_000)), bytes(k // 7 % top for k in range(40_000))):
        assert gif.lzw_decode(gif.lzw_encode(data, bits), bits, len(data)) == data


def test_known_gif_with_transparency_disposal_and_interlace():
    sample = bytes.fromhex("474946383961030002009100 00ff000000ff000000ffffffff".replace(" ", ""))
    body = lambda left, top, w, h, data, control, how=0: control + b"\x2c" + left.to_bytes(2, "little") + top.to_bytes(2, "little") + w.to_bytes(2, "little") + h.to_bytes(2, "little") + bytes([how]) + b"\x02" + gif._blocks(gif.lzw_encode(data, 2))
    control = lambda disposal, delay, index=None: b"\x21\xf9\x04" + bytes([disposal << 2 | (index is not None), delay, 0, index or 0, 0])
    data = sample + body(0, 0, 3, 2, bytes([0] * 6), control(1, 5)) + body(1, 0, 2, 1, bytes([1, 3]), control(2, 6, 3)) + body(0, 1, 1, 1, bytes([2]), control(3, 7)) + body(2, 1, 1, 1, bytes([1]), control(0, 8)) + b"\x3b"
    width, height, _, frames = gif.read_gif(data)
    assert (width, height, [f.delay for f in frames]) == (3, 2, [5, 6, 7, 8])
    shown = [c[..., :3].tolist() + [c[..., 3].tolist()] for c in gif.compose(width, height, frames)]
    red, green, blue = [255, 0, 0], [0, 255, 0], [0, 0, 255]
    assert shown[0][:2] == [[red] * 3, [red] * 3]
    assert shown[1][0] == [red, green, red]  # the transparent sample shows what is below
    assert shown[2][1][0] == blue and shown[2][2][0] == [255, 0, 0]  # disposal 2 cleared the second frame's place
    assert shown[3][1] == [red, red, green]  # disposal 3 brought back what the third frame had covered
    rows = bytes(range(4)) * 8
    shuffled = b"".join(rows[4 * y : 4 * y + 4] for y in [0, 4, 2, 6, 1, 3, 5, 7])
    assert gif._rows_in_order(shuffled, 4, 8) == rows


def test_bad_code_streams_are_refused():
    with pytest.raises(ValueError):
        gif.lzw_decode(b"\x04\x0f\xff\xff", 2, 100)
    with pytest.raises(ValueError):
        gif.read_gif(b"PNG")


# ---- decontamination


def test_leaks_are_found_verbatim_and_paraphrased(spark, docs, empty):
    r = random.Random(8)
    items = [(k, prose(r, r.randint(15, 50))) for k in range(30)] + [(100, None), (101, ""), (102, "!!")]
    rows, expected = [], set()
    for i in range(120):
        text = prose(r, r.randint(20, 400))
        if i % 4 == 0:
            k = r.randrange(30)
            w = items[k][1].split()
            if i % 8 == 0:  # one word in eight changes
                for j in range(0, len(w), 8):
                    w[j] = words(r, 1)[0]
            cut = r.randrange(len(text))
            text = text[:cut] + " " + " ".join(w).upper() + " " + text[cut:]
            expected.add((i, k))
        rows.append((i, text, "other"))
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.find_leaks(df, bench).collect()}
    assert len(got & expected) >= 0.9 * len(expected) and not got - expected
    marked = {x["doc_id"]: x["leaked_items"] for x in decontaminate.mark_leaks(df, bench).collect()}
    assert {(i, k) for i, ks in marked.items() for k in ks} == got and len(marked) == 120
    assert ids(decontaminate.mark_leaks(docs, bench).collect()) == ALL_IDS
    assert decontaminate.find_leaks(empty, bench).count() == 0 and decontaminate.find_leaks(df, bench.limit(0)).count() == 0


def test_leaks_of_several_blocks_of_items(spark, monkeypatch):
    r = random.Random(9)
    items = [(k, prose(r, 30)) for k in range(12)]
    docs = [(i, prose(r, 60) + (" " + items[i % 12][1] + " " + items[(i + 5) % 12][1] if i % 2 else "")) for i in range(40)]
    df = spark.createDataFrame([(i, t, [i], str(i)) for i, t in docs] + [(40, None, None, None)], "doc_id long, text string, leaked_items array<int>, both string")
    bench = spark.createDataFrame([*items, (3, items[3][1])], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK", 5)
    expected = {i: sorted({i % 12, (i + 5) % 12}) if i % 2 else [] for i in range(40)} | {40: []}
    marked = decontaminate.mark_leaks(df, bench)
    assert {x["doc_id"]: x["leaked_items"] for x in marked.collect()} == expected
    assert sorted(marked.columns) == ["both", "doc_id", "leaked_items", "text"]
    found = decontaminate.find_leaks(df, bench).collect()
    assert sorted((x["doc_id"], x["item_id"]) for x in found) == [(i, k) for i, ks in expected.items() for k in ks]
    assert [x["leaked_items"] for x in decontaminate.mark_leaks(df, bench.limit(0)).collect()] == [[]] * 41


def test_common_subsequence_equals_dynamic_programming():
    r = random.Random(5)
    for _ in range(200):
        a, b = [r.randrange(6) for _ in range(r.randint(1, 30))], [r.randrange(-1, 6) for _ in range(r.randint(0, 70))]
        row = [0] * (len(b) + 1)
        for x in a:
            before = row[:]
            for j, y in enumerate(b):
                row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
        assert decontaminate.common_subsequence(a, b) == row[-1]


def test_svd_finds_the_leading_directions(spark):
    g = np.random.default_rng(2)
    a = (g.standard_normal((200, 5)) * [30, 20, 10, 5, 3]) @ np.linalg.qr(g.standard_normal((40, 5)))[0].T + 0.01 * g.standard_normal((200, 40))
    rows = spark.createDataFrame([(list(range(40)), [float(x) for x in v]) for v in a], decontaminate.SPARSE)
    basis = decontaminate.randomized_svd(rows, 40, rank=5, extra=5, iterations=4)
    true = np.linalg.svd(a)[2][:5].T
    assert np.allclose(np.linalg.svd(basis.T @ true)[1], 1, atol=1e-2)


@pytest.mark.parametrize("held", [8_000_000, 300])
def test_the_latent_space_is_fitted_on_every_passage_of_every_document(spark, monkeypatch, held):
    """More documents than any sample that was taken; sums over two terms equal a product of dense matrices."""
    r = random.Random(8)
    vocabulary = words(r, 60)
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 23, 24, 25, 48, 49, 72, 73, 130]))) for _ in range(900)]
    items = [(k, " ".join(vocabulary[2 * k : 2 * k + 12])) for k in range(20)]
    seen, pair_sums = [], decontaminate.pair_sums

    def spy(ids_, idf, scratch):
        out = pair_sums(ids_, idf, scratch)
        seen.append((idf, {x["term"]: np.frombuffer(x["sums"], np.float32) for x in out.collect()}))
        return out

    monkeypatch.setattr(decontaminate, "pair_sums", spy)
    monkeypatch.setattr(decontaminate, "HELD_PAIRS", held)
    index, _ = decontaminate.fit(spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id long, text string").repartition(5), items, "doc_id", "text")
    (idf, sums), = seen
    dense = np.zeros((len(idf), len(idf)))
    for t in texts:
        t_ids = decontaminate.term_ids(t, index.terms)
        for lo in range(0, max(1, len(t_ids) - decontaminate.STRIDE), decontaminate.STRIDE):
            at, value = decontaminate._tf_idf(t_ids[lo : lo + decontaminate.PASSAGE], idf)
            dense[np.ix_(at, at)] += np.outer(value, value)
    assert len(sums) == len(idf)
    assert all(np.allclose(v, dense[k, k:], rtol=1e-4, atol=1e-4) for k, v in sums.items())


def test_scratch_tables_go_when_cleared(spark):
    from forkline.llm.common import Scratch

    scratch = Scratch(spark, "gone")
    scratch.save(spark.range(3), "t")
    assert scratch.read("t").count() == 3
    others, Scratch.roots = [r for r in Scratch.roots if r is not scratch], [scratch]
    Scratch.clear()
    Scratch.roots += others
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        scratch.read("t").count()


def test_blocks_held_counts_and_partitions_change_no_component(spark, monkeypatch):
    r = random.Random(12)
    base, rows = words(r, 200), []
    for i in range(160):
        w = list(base)
        for _ in range(r.randint(3, 9)):
            w[r.randrange(len(w))] = words(r, 1)[0]
        rows.append((i, " ".join(w)))
    df, expected = spark.createDataFrame(rows, "doc_id long, text string"), brute_components(rows)
    assert len({c for _, _, c in expected}) > 1
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for name, value in (("REGION", 4), ("CHUNK", 8), ("HELD", 5)):
        monkeypatch.setattr(minhash, name, value)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert as_tuples(minhash.near_duplicates(df).collect()) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_columns_that_clash_are_replaced_and_own_names_are_kept(spark):
    text = prose(random.Random(2), 80)
    rows = [(i, text, "x", "y", "z") for i in range(3)]
    out = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, runs string, first_docs string, doc string")).collect()
    assert {(r["runs"], r["doc"]) for r in out} == {("x", "z")}
    assert sorted((r["doc_id"], r["first_docs"]) for r in out) == [(0, []), (1, [0]), (2, [0])]


@pytest.mark.parametrize("block", [16, 1 << 16])
def test_word_hashes_follow_the_words(monkeypatch, block):
    from forkline.llm import words as module

    monkeypatch.setattr(module, "BLOCK_BYTES", block)
    r = random.Random(6)
    texts = [None, "", " \t\n", "A a", "x" * 70 + "\x0b\x0c" + "é" * 20, *("".join(r.choice("abAB é 　\n\r\x00.") for _ in range(r.randint(0, 200))) for _ in range(60))]
    got = module.hashed(pa.array(["skipped", *texts]).slice(1))
    name: dict[bytes, int] = {}
    for k, t in enumerate(texts):
        own = got.hash[got.row[k] : got.row[k + 1]].tolist()
        expected = [b for b in (t or "").encode().lower().split()]
        assert len(own) == len(expected)
        assert all(name.setdefault(w, h) == h for w, h in zip(expected, own, strict=True))
    assert len(set(name.values())) == len(name)
