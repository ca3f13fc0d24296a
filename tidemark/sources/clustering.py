"""Files clustered by several columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ranges a column is cut into: eight bits of each are interleaved.
RANGES = 256
_BITS = 8


def _bounds(df: DataFrame, columns: Sequence[str]) -> list[list]:
    """Values that cut each column into ranges of about equally many rows, from one pass."""
    shares = [i / RANGES for i in range(1, RANGES)]
    cuts = df.agg(*[F.percentile_approx(_number(df, c), shares, 10_000).alias(f"_{i}") for i, c in enumerate(columns)])
    return [sorted(set(found or [])) for found in cuts.first()]


def _number(df: DataFrame, column: str) -> Column:
    """A number that grows with the column: of text its first six characters, of instants
    and days their count."""
    kind = df.schema[column].dataType.simpleString()
    value = F.col(column)
    if kind == "string":
        codes = [F.ascii(F.substring(value, i, 1)).cast("double") * 256.0 ** (6 - i) for i in range(1, 7)]
        return sum(codes[1:], codes[0])
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind == "timestamp_ntz":
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if kind == "timestamp":
        return F.unix_micros(value).cast("double")
    return value.cast("double")


def with_z_order(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``df`` with a number whose leading bits are those of all columns' ranges in turn, so
    that rows near in it are near in every column. NULL is in the first range."""
    rows, places = df, []
    for i, (column, cuts) in enumerate(zip(columns, _bounds(df, columns), strict=True)):
        number, place, width = f"_number_{i}", f"_place_{i}", RANGES // 2
        bounds = F.array(*[F.lit(float(c)) for c in cuts], *[F.lit(float("inf"))] * (RANGES - len(cuts)))
        rows = rows.withColumn(number, F.coalesce(_number(df, column), F.lit(float("-inf"))))
        rows = rows.withColumn(place, F.lit(0))
        while width:  # the number of bounds below, by halving
            above = F.col(number) > F.element_at(bounds, F.col(place) + width)
            rows = rows.withColumn(place, F.col(place) + F.when(above, width).otherwise(0))
            width //= 2
        places.append(place)
    value = F.lit(0).cast("long")
    for bit in reversed(range(_BITS)):
        for place in places:
            value = F.shiftleft(value, 1).bitwiseOR(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"))
    return rows.select(*df.columns, value.alias(name))


def clustered(df: DataFrame, partition_fields: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows range-partitioned and sorted by partition and Z-order: a file holds a small
    range of every column, and a hot partition is spread over many. The ranges come from a
    sample of the rows, so ``df`` is read three times; results do not depend on them."""
    if not 1 <= len(columns) <= 62 // _BITS:
        raise ValueError(f"cluster by one to {62 // _BITS} columns")
    order = [*partition_fields, "_z"]
    return with_z_order(df, columns, "_z").repartitionByRange(*order).sortWithinPartitions(*order).drop("_z")
