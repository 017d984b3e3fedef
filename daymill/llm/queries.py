"""Registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.llm import (
    byte_bpe, language_id, mixing, near_dedup, neighbours, quality_model, quality_rules, secrets,
    sharding, spelling, token_files, url_filter, vector_codes,
)
from daymill.llm.oracles import ORACLES
from daymill.llm.shared import whole_text, word_count
from daymill.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]

RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)
SHARDS = 24
WEIGHTS = (5, 2, 1)
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan_documents(docs, keep_text=False)


def op2_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out)
    model = quality_model.train(docs, labels.withColumnRenamed("quality", "label"))
    scored = quality_model.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    entries = quality_rules.ledger(docs).drop("text")
    policies = {"base": quality_rules.BASE, "kept": quality_rules.PRODUCTION}
    judged = quality_rules.apply_policies(entries, policies)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("base")).alias("base_failed"), "kept", "failed",
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_dedup.near_duplicates(docs, words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.filter_urls(pages, RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    facts = docs.select(
        "doc_id", "source",
        (F.octet_length(whole_text()) + sharding.KEY_BYTES).cast("bigint").alias("size"),
        F.crc32(whole_text()).alias("text_crc32"),
    )
    placed = sharding.interleave(facts, SHARDS, content=F.col("text_crc32"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    facts = docs.select("doc_id", "source", word_count(whole_text()).alias("n_words"))
    mixed = mixing.mix(facts, WEIGHTS, size=F.col("n_words"))
    taken = (F.col("copies") * F.col("size")).cast("bigint").alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = scratch_path(spark, "llm-tokens")
    manifest = token_files.write_token_files(
        docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=END_ID
    )
    return token_files.read_token_files(manifest, folder)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, ranks)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("vec_id") % 100 == 0)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(~language_id.held_out(F.col("doc_id"))))
    predicted = language_id.predict(docs.select("doc_id", "text"), model)
    held_out = language_id.held_out(F.col("doc_id")).alias("held_out")
    return predicted.select("doc_id", held_out, "lang_pred", "score")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    codes, codebooks = vector_codes.compress(vectors)
    found = vector_codes.with_label_errors(codes)
    return found.select(
        "vec_id", "code", "error", "label_error",
        F.lit(vector_codes.checksum(codebooks)).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_quality_scores, op3_quality_rules, op4_near_duplicates,
        op5_url_filter, op6_sharding, op7_mixing, op8_token_files, op9_byte_bpe, op10_nearest,
        op11_language_id, op12_spelling_variants, op13_vector_codes,
    )
}
