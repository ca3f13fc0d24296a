"""The operators as queries over (spark, sf_dir), and their SQL where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    chat,
    collocations,
    decontaminate,
    licenses,
    merkle,
    mixing,
    neighbours,
    ngram_join,
    quality,
    secrets,
    simhash,
    token_counts,
    warc,
)
from tidemark.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame(
        [(-1, 0, "user", chat.CONFLICT), (-1, 1, "assistant", chat.CONFLICT)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_turns(rows.union(own)))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages).drop("url", "payload")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.with_quality(documents, table(spark, sf_dir, "labels")).drop("text")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_report(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.similar_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_ngram_jaccard,
        op3_chat_format,
        op4_warc,
        op5_license_scan,
        op6_nearest,
        op7_secret_scan,
        op8_quality,
        op9_token_counts,
        op10_mixing,
        op11_merkle_manifest,
        op12_collocations,
        op13_simhash_neardup,
    )
}

ORACLE: dict[str, str] = {
    "op3_chat_format": chat.SQL,
    "op4_warc": warc.SQL,
    "op10_mixing": mixing.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_collocations": collocations.SQL,
}
