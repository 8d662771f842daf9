"""A corpus pipeline over ``documents``: five stages, each on all rows that the
stage before kept, each written as Parquet and read again.

1. quality          documents that the classifier rejects go
2. near_dedup       one document of each class of near copies stays
3. decontamination  documents that contain a benchmark item go
4. secrets          found secrets are masked in the text, n_chars is renewed
5. sentencepiece    the texts are encoded and decoded; one row per document

Defined results: rows with a null id pass through every stage like others, so
their copies and contaminated texts go; a null text is empty, has no words and
is a copy of other empty texts; of repeated rows one stays after stage 2; very
long texts are worked on whole; further columns of documents stay, whatever their
names, up to stage 4; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumen.llm import decontam, neardup, quality, secretscan, sentencepieces
from lumen.session import scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secretscan.mask_secrets(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_decode(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("sentencepiece", sentencepiece_stage),
]

# A trained classifier, signatures and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
