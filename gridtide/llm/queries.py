"""The registered queries over the text tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import bpe, decontaminate, exact_dedup, html_text, line_dedup, ngram_join, preference, quality, resample
from gridtide.llm import secrets, source_audit, substring_dedup, suffix_dedup
from gridtide.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2n and 2n + 1 as a pair: the even one is the chosen one."""
    turns = table(spark, sf_dir, "conversations")
    pair = F.floor(F.col("conv_id") / 2)
    return preference.format_preferences(turns, pair, F.pmod("conv_id", F.lit(2)) == 0)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract_text(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnt from the labelled rows that are not held out."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    scored = quality.score_quality(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(secrets.listed_spans("spans", base_only=True), 256).alias("base_sha256"),
        secrets.listed_spans("spans").alias("spans"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(table(spark, sf_dir, "documents"))


def registered() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
