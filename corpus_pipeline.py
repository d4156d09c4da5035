"""Corpus pipeline: five operators of ``edgewise.llm`` over the documents table.

Each stage is a function of (spark, docs, sf_dir) and gets what its
predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from edgewise.llm import bpe, decontaminate, quality, secrets, simhash


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.without_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.without_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials in the texts are replaced by a mark."""
    return secrets.redacted(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the round trip."""
    return bpe.round_trip_report(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: The language model and the token ids of the later stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
