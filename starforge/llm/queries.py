"""Registered queries of this subpackage: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from starforge.llm import (embedding_dedup, language_id, license_scan,
                           merkle_manifest, minhash_dedup, mixing,
                           quality_rules, sentencepiece_codec, substring_dedup,
                           suffix_dedup, token_alignment, toxicity, url_filter)
from starforge.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.minhash_dedup(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", substring_dedup.removed_length().alias("n_removed"),
                      F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.sp_report(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", substring_dedup.removed_length().alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest_report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_toxicity, op2_license_scan, op3_minhash_dedup, op4_substring_dedup, op5_language_id,
           op6_sentencepiece, op7_suffix_dedup, op8_mixing, op9_embedding_dedup, op10_quality_rules, op11_url_filter,
           op12_token_alignment, op13_merkle_manifest)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """Statements of the operators that SQL can express."""
    return {"op2_license_scan": license_scan.license_sql(),
            "op3_minhash_dedup": minhash_dedup.minhash_sql(),
            "op4_substring_dedup": substring_dedup.substring_sql(),
            "op7_suffix_dedup": suffix_dedup.suffix_sql(), "op8_mixing": mixing.mix_sql(),
            "op10_quality_rules": quality_rules.quality_sql(), "op11_url_filter": url_filter.url_sql(),
            "op13_merkle_manifest": merkle_manifest.manifest_sql()}
