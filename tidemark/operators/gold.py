"""Silver to gold: aggregates of the valid rows.

Both are plain hash aggregations, combined map-side before the shuffle, so a
group holding a large share of the rows reaches the final step as one partial
row per task. The exact distinct count shuffles on (group, customer) first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import hour_of
from tidemark.functions.marks import instant
from tidemark.operators.states import deviation

GROUP_KEYS = {"by_category": ("category_code", "dt"), "by_hour": ("dt", "hour")}


def valid_rows(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("is_valid"))


def with_hour(silver: DataFrame) -> DataFrame:
    """Hour of ``ts``. ``dt`` is the day of ``transaction_date``: another clock."""
    return silver.withColumn("hour", hour_of(F.col("ts"), silver.schema["ts"].dataType))


def agg_key(*parts: str) -> Column:
    """Parts joined by ``_``, numbers not padded; NULL if any part is NULL."""
    pieces = [F.col(parts[0])]
    for part in parts[1:]:
        pieces += [F.lit("_"), F.col(part)]
    return F.concat(*pieces)


def _tag(groups: DataFrame, keys: tuple[str, ...], batch_id: str, as_of: datetime | None) -> DataFrame:
    return groups.withColumns(
        {"processed_at": instant(as_of), "batch_id": F.lit(batch_id), "agg_key": agg_key(*keys)}
    )


def by_category(silver: DataFrame, batch_id: str, as_of: datetime | None = None) -> DataFrame:
    """Valid transactions per category and day. The deviation is the sample one."""
    keys = GROUP_KEYS["by_category"]
    groups = (
        valid_rows(silver)
        .groupBy(*keys)
        .agg(
            F.count("id").alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            F.avg("amount").alias("avg_amount"),
            F.max("amount").alias("max_amount"),
            F.min("amount").alias("min_amount"),
            F.stddev("amount").alias("stddev_amount"),
        )
    )
    return _tag(groups, keys, batch_id, as_of)


def by_hour(silver: DataFrame, batch_id: str, as_of: datetime | None = None) -> DataFrame:
    """Valid transactions and exact distinct customers per day and hour."""
    keys = GROUP_KEYS["by_hour"]
    groups = (
        with_hour(valid_rows(silver))
        .groupBy(*keys)
        .agg(
            F.count("id").alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
    )
    return _tag(groups, keys, batch_id, as_of)


def from_states(states: DataFrame, name: str, batch_id: str, as_of: datetime | None = None) -> DataFrame:
    """The same rows from the states of their groups (``operators.states``)."""
    keys, total = GROUP_KEYS[name], F.when(F.col("n") > 0, F.col("total"))
    columns = {"transaction_count": F.col("rows"), "total_amount": total}
    if name == "by_category":
        columns |= {
            "avg_amount": total / F.col("n"),
            "max_amount": F.col("most"),
            "min_amount": F.col("least"),
            "stddev_amount": deviation(),
        }
    else:
        columns["unique_customers"] = F.col("uniques")
    groups = states.select(*keys, *[column.alias(name) for name, column in columns.items()])
    return _tag(groups, keys, batch_id, as_of)


def aggregations(silver: DataFrame, batch_id: str, as_of: datetime | None = None) -> dict[str, DataFrame]:
    return {
        "by_category": by_category(silver, batch_id, as_of),
        "by_hour": by_hour(silver, batch_id, as_of),
    }
