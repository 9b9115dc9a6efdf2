"""The corpus pipeline: quality rules, quality classifier, near-dedup, decontamination, encoding.

Each stage takes the documents that the one before kept and returns those that it keeps, with all their columns; the
last returns the digests of every document's tokens. Stages filter where the text stands, so rows with a repeated or
null doc_id are judged one by one (near-dedup keeps one row of each group).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from galeframe.llm.bpe import round_trip
from galeframe.llm.decontaminate import decontaminated
from galeframe.llm.near_dup import deduplicated
from galeframe.llm.quality_classifier import fit_quality, quality_filtered
from galeframe.llm.quality_rules import rule_filtered
from galeframe.llm.staging import new_folder

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rule_filtered(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model is learnt from the labelled rows of the whole table, so that it has seen rejected ones too."""
    model = fit_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_filtered(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]
#: Covariance estimates, fitted rules, alignment and merges have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
