"""Registered queries of the subpackage: each reads its whole table and applies one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from edgewise.llm import alignment, bpe, decontaminate, fingerprints, language, paragraphs, phrases, quality, secrets, simhash, suffix_dedup, token_counts, url_filter


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op2_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(_table(spark, sf, "pages"), _table(spark, sf, "documents"))


def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.removal_report(_table(spark, sf, "documents")).drop("spans")


def op5_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprint_report(_table(spark, sf, "documents"))


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf, "documents"), _table(spark, sf, "labels")).drop("key")


def op8_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return paragraphs.repeat_report(_table(spark, sf, "documents"))


def op9_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.secret_report(_table(spark, sf, "documents"))


def op10_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip_report(_table(spark, sf, "documents"),
                                 public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.url_report(_table(spark, sf, "pages"))


def op12_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf, "documents"))


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.alignment_report(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                      public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_language": op2_language,
    "op3_simhash": op3_simhash,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_token_counts": op6_token_counts,
    "op7_quality": op7_quality,
    "op8_paragraphs": op8_paragraphs,
    "op9_secrets": op9_secrets,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_url_filter": op11_url_filter,
    "op12_phrases": op12_phrases,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL = {
    "op1_decontaminate": decontaminate.ORACLE,
    "op9_secrets": secrets.ORACLE,
    "op11_url_filter": url_filter.ORACLE,
    "op12_phrases": phrases.ORACLE,
}
