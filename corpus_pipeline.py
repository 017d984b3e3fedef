"""Documents made ready for training, in five stages.

Quality rules drop what fails them, one document of each group of near
duplicates stays, secrets are cut out of texts, sources are mixed to target
weights, and texts become token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.llm import byte_bpe, mixing, near_dedup, quality_rules, secrets
from daymill.session import scratch_path

WEIGHTS = (5, 2, 1)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the policy in use, with all their columns as they are."""
    added = set(quality_rules.ledger(docs.select("text")).columns) - {"text"}
    own = {c: f"__own_{c}" for c in docs.columns if c in added}
    entries = quality_rules.ledger(docs.withColumnsRenamed(own))
    kept = entries.filter(quality_rules.passes(quality_rules.PRODUCTION))
    return kept.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by runs of five words."""
    return near_dedup.one_of_each(docs, words=5, percent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, each secret replaced by its kind in brackets; ``n_chars`` follows."""
    clean = docs.withColumn("text", secrets.redact("text"))
    chars = F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))
    return clean.withColumn("n_chars", chars).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixing.mixed_rows(docs, WEIGHTS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, ``n_tokens`` and ``ids`` of every row; no other column stays."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = docs.select("doc_id", "lang", "source", "text")
    return byte_bpe.encode_documents(rows, ranks)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("secret_scan", without_secrets),
    ("mixing", mixture),
    ("byte_bpe", tokens),
]

# Spans within decoded layers and links of MinHash candidates are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table of documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
