"""The queries of this subpackage that have SQL twins, and the columns that the others promise."""

from __future__ import annotations

import pytest

import corpus_pipeline
from forkline.llm import queries

from ..twins import compare, database

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_substring": "doc_id n_sentences n_removed removed first_docs text",
    "op2_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op4_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op5_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op6_toxicity": "doc_id held_out score predicted",
    "op7_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op8_minhash": "doc_id n_shingles component_id kept",
    "op9_gif": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
    "op10_decontaminate": "doc_id item_id cosine common answer word",
}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_twin(spark, name):
    assert compare(spark, database(SF), SF, queries.queries()[name], queries.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = queries.queries()[name](spark, SF)
    assert df.columns == COLUMNS[name].split()
    n = spark.read.parquet(f"{SF}/{'pages' if name == 'op3_warc' else 'documents'}.parquet").count()
    assert df.count() == n or name == "op10_decontaminate"


def test_every_operator_has_a_query_and_the_stages_are_in_order():
    assert set(queries.queries()) == set(COLUMNS)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"]
