"""A training corpus from ``documents``: documents of bad quality go, one of each group of
near-duplicates stays, documents that hold benchmark items go, secrets are masked, and
sources are mixed to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, ngram_join, quality, secrets
from tidemark.llm.common import shared_parquet, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.with_quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with the words it takes of each."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("mixing", mixed),
]

# The classifier is learnt, so SQL cannot express the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_parquet(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
