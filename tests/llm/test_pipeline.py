"""The pipeline over the smallest tables, stage by stage, against what each operator says."""

from __future__ import annotations

import corpus_pipeline
from forkline.llm import decontaminate, minhash, pii

from .corpus import prose

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, SF).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        if name == "near_dedup":
            kept = {r[0] for r in minhash.near_duplicates(before).where("kept").collect()}
            assert {r["doc_id"] for r in out.collect()} == kept and out.count() == len(kept)
        if name == "decontamination":
            assert decontaminate.find_leaks(out, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
        if name == "pii":
            assert out.count() == before.count() and not any(pii.base_spans(r["text"] or "") for r in out.collect())
        before = out
    last = {r["doc_id"]: r for r in before.collect()}
    assert all(len(r["ids"]) == r["n_tokens"] and r["n_chars"] == len(r["text"]) for r in last.values())
    assert {r["doc_id"]: (r["n_tokens"], r["text"]) for r in corpus_pipeline.run(spark, SF).collect()} == {i: (r["n_tokens"], r["text"]) for i, r in last.items()}


def test_awkward_rows_pass_through(spark):
    import random

    text = prose(random.Random(1), 80)
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (2, text, "en", "s", 1), (3, None, None, None, None), (4, "", "en", "s", 0), (None, "no id here", "en", "s", 9), (4, "", "en", "t", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = docs
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, got, SF)
    rows = got.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == [(False, 1), (False, 3), (False, 4), (True, 0)]
    assert {r["doc_id"]: r["text"] for r in rows}[3] is None
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
    assert none.count() == 0
