"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(field.dataType) for field in dtype.fields)
    return isinstance(dtype, T.MapType)


def _sortable(field: T.StructField) -> Column:
    # Maps have no order of their own; their JSON text does.
    column = F.col(field.name)
    return F.to_json(F.struct(column)) if _has_map(field.dataType) else column


def latest_per_key(df: DataFrame, keys: Sequence[str], ordering: str) -> DataFrame:
    """Keep, per key, the row with the greatest ``ordering`` value (NULL is least).

    Ties fall to the greatest remaining columns, in schema order, so the result
    is the same on every run and after any task is retried. Spark limits each
    key to one row per task before the shuffle, so a key with a huge number of
    versions costs no more than any other.
    """
    rest = [f for f in df.schema.fields if f.name not in keys and f.name != ordering]
    order = [F.col(ordering).desc_nulls_last(), *[_sortable(f).desc_nulls_last() for f in rest]]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_and_times(df: DataFrame, keys: Sequence[str], ordering: str, times: str) -> DataFrame:
    """As :func:`latest_per_key`, with the number of versions each key had in ``times``.

    An aggregate, as a rank limit would forget the versions it drops: each task sends a
    key's greatest version and their number.
    """
    rest = [f for f in df.schema.fields if f.name not in keys and f.name != ordering]
    order = F.struct(F.col(ordering), *[_sortable(f).alias(f.name) for f in rest])
    if any(_has_map(f.dataType) for f in rest):
        latest = F.max_by(F.struct(ordering, *[f.name for f in rest]), order)
    else:
        latest = F.max(order)
    found = df.groupBy(*keys).agg(latest.alias("_latest"), F.count(F.lit(1)).alias(times))
    columns = [F.col(c) if c in keys else F.col("_latest")[c].alias(c) for c in df.columns]
    return found.select(*columns, times)
