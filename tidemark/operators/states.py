"""Aggregates that can be merged and taken back: states of groups.

A state of amounts holds their number, sum, sum of squared deviations from the mean, least
and greatest. States of disjoint rows merge exactly as their rows would aggregate; a state
whose rows go is merged with the sign -1. The least and greatest cannot be taken back, nor
sums with a NaN or an infinity in them: such groups are marked to be computed anew.

Distinct whole numbers are bitmaps of 32,768 bits each, one per bucket of a group that holds
any. Bitmaps merge by OR, so groups are extended without reading earlier rows; groups that
lose rows are computed anew, as a number may be in other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATE = ("rows", "n", "total", "m2", "least", "most")
WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def moments(rows: DataFrame, keys: Sequence[str], amount: str = "amount", counted: str = "id") -> DataFrame:
    """The state of each group: rows with ``counted``, and the state of ``amount``."""
    n = F.count(amount)
    return rows.groupBy(*keys).agg(
        F.count(counted).alias("rows"),
        n.alias("n"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("total"),
        F.coalesce(F.var_pop(amount) * n, F.lit(0.0)).alias("m2"),
        F.min(amount).alias("least"),
        F.max(amount).alias("most"),
    )


def _finite(column: Column) -> Column:
    return ~(F.isnan(column) | (F.abs(column) == float("inf")))


def combined(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per group of ``parts``, states with a ``sign``, and ``anew``: whether its
    rows have to be read to know it.

    The deviations of all rows from the common mean are each part's own, and its rows times
    the squared distance of its mean: ``sum(sign * (m2 + n * (mean - common) ** 2))``. The
    parts of a sign are states of disjoint rows, so a group can have several.
    """
    signed = {c: F.sum(F.col("sign") * F.col(c)).alias(c) for c in ("rows", "n", "total")}
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n")).otherwise(0.0)
    part = F.struct("sign", "n", mean.alias("mean"), "m2")
    kept, gone = F.col("sign") > 0, F.col("sign") < 0
    groups = parts.groupBy(*keys).agg(
        *signed.values(),
        F.collect_list(part).alias("parts"),
        F.min(F.when(kept, F.col("least"))).alias("least"),
        F.max(F.when(kept, F.col("most"))).alias("most"),
        F.min(F.when(gone, F.col("least"))).alias("gone_least"),
        F.max(F.when(gone, F.col("most"))).alias("gone_most"),
        F.bool_and(_finite(F.col("total")) & _finite(F.col("m2"))).alias("finite"),
        F.bool_or(gone).alias("shrunk"),
    )
    common = F.when(F.col("n") > 0, F.col("total") / F.col("n")).otherwise(0.0)
    m2 = F.aggregate(
        "parts",
        F.lit(0.0),
        lambda found, p: found + p["sign"] * (p["m2"] + p["n"] * (p["mean"] - common) * (p["mean"] - common)),
    )
    lost = F.coalesce(F.col("gone_least") <= F.col("least"), F.lit(False)) | F.coalesce(
        F.col("gone_most") >= F.col("most"), F.lit(False)
    )
    anew = (F.col("rows") > 0) & F.col("shrunk") & (lost | ~F.col("finite"))
    return groups.select(
        *keys, "rows", "n", "total", F.greatest(m2, F.lit(0.0)).alias("m2"), "least", "most", anew.alias("anew")
    )


def deviation() -> Column:
    """The sample deviation of a state; NULL of fewer than two amounts."""
    return F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))


def bitmaps(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """``(keys, bucket, bits)``: the distinct values of ``number`` in each group."""
    bucket = F.bitmap_bucket_number(F.col(number).cast("long")).alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number).cast("long"))).alias("bits")
    return rows.where(F.col(number).isNotNull()).groupBy(*keys, bucket).agg(bits)


def merged_bitmaps(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_numbers(maps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many numbers each group has; groups without any have no row."""
    return maps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
