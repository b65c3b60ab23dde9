"""A corpus pipeline: toxicity filter, near-duplicate removal, benchmark decontamination, redaction, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forkline.llm import bpe, decontaminate, minhash, pii, toxicity
from forkline.llm.common import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the toxicity model scores under 0.5; the model learns from the labelled documents."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_documents(docs, model, name="__toxic").where(F.col("__toxic") < 0.5).drop("__toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component; of rows that repeat its id, the smallest by the columns that have an order. Rows without an id stay."""
    kept = minhash.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    kinds = dict(docs.dtypes)
    ordered = [c for c in docs.columns if c != "doc_id" and not any(k in kinds[c] for k in ("map<", "variant", "void"))]
    others = [c for c in docs.columns if c != "doc_id"]
    least = F.min(F.struct(*others)) if len(ordered) == len(others) else F.min_by(F.struct(*others), F.struct(*ordered))
    one = docs.join(kept.hint("merge"), "doc_id", "left_semi").groupBy("doc_id").agg(least.alias("__row"))
    return one.select(*(F.col("doc_id") if c == "doc_id" else F.col(f"__row.{c}").alias(c) for c in docs.columns)).unionByName(docs.where("doc_id is null"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no benchmark item."""
    marked = decontaminate.mark_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.where(F.size("leaked_items") == 0).drop("leaked_items")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the names of its kinds, and count the characters anew."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Append n_tokens and ids; the text is what the ids decode to, and stays null where it was."""
    made = bpe.encode_documents(docs)
    text = F.when(F.col("text").isNotNull(), F.col("decoded").cast("string"))
    return made.withColumn("text", text).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("pii", redact),
    ("bpe", tokenize),
]

#: SQL can't express these models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each one's rows are written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
