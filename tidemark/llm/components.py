"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_one_each, kept


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``, the root being the component's
    smallest node. NULL ends and loops are ignored.

    Each round hooks every root to its smallest neighbouring root, collapses the
    resulting trees by pointer doubling, and keeps the edges between different roots.
    Rows only shrink from round to round; each round is checkpointed. Joins are on nodes that
    can have any number of rows, such as the root of a large component, so hot ones are
    joined without a shuffle.
    """
    edges = kept(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b").distinct())
    labels = kept(
        edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select(
            "node", F.col("node").alias("root")
        )
    )
    while edges.take(1):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = kept(
            both.groupBy("a").agg(F.min("b").alias("b")).select(
                F.col("a").alias("node"), F.least("a", "b").alias("parent")
            )
        )
        parents = _collapsed(parents)
        labels = kept(
            join_one_each(labels, parents.withColumnRenamed("node", "root"), "root").select(
                "node", F.coalesce("parent", "root").alias("root")
            )
        )
        for end in ("a", "b"):
            edges = join_one_each(edges, parents.withColumnRenamed("node", end), end).drop(end)
            edges = edges.withColumnRenamed("parent", end)
        edges = kept(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels


def _collapsed(parents: DataFrame) -> DataFrame:
    """Every node's top ancestor."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        jumped = kept(
            join_one_each(parents, above, "parent").select(
                "node", F.col("top").alias("parent"), (F.col("top") != F.col("parent")).alias("moved")
            )
        )
        parents = jumped.select("node", "parent")
        if not jumped.where("moved").take(1):
            return parents
