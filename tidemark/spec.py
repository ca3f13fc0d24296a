"""Table identity: where a table lives, how it is partitioned and keyed."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Commit mark every table carries: microseconds since the epoch (UTC) of the
# commit that last wrote the row. BIGINT on purpose: Parquet row groups are
# skipped on a BIGINT range, but not on the default timestamp encodings.
COMMIT_COL = "_commit_us"

COPY_ON_WRITE = "COPY_ON_WRITE"


@dataclass(frozen=True)
class TableSpec:
    """Layout of one table. The identity of a row is its partition values plus
    its record key; ``ordering_field`` decides which version of it is latest.

    ``schema`` (optional) fixes the stored columns; without it they are read
    from the data files.
    """

    partition_fields: tuple[str, ...] = ("dt",)
    record_key: str = "id"
    ordering_field: str = "ts"
    table_type: str = COPY_ON_WRITE
    schema: T.StructType | None = None

    def __post_init__(self) -> None:
        if self.table_type != COPY_ON_WRITE:
            raise ValueError(f"table type {self.table_type!r} is not supported; tables are {COPY_ON_WRITE}")
        if not self.partition_fields:
            raise ValueError("a table needs at least one partition field")

    @property
    def keys(self) -> tuple[str, ...]:
        """What identifies a row. The record key leads: sorts by it settle almost
        every comparison at once, where partition values mostly tie."""
        return (self.record_key, *self.partition_fields)


BRONZE_SPEC = TableSpec()
SILVER_SPEC = TableSpec(partition_fields=("dt", "category_code"))

_GOLD_TAIL = [
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("agg_key", T.StringType()),
    T.StructField(COMMIT_COL, T.LongType()),
]
GOLD_BY_CATEGORY_SPEC = TableSpec(
    record_key="agg_key",
    ordering_field="processed_at",
    schema=T.StructType(
        [
            T.StructField("category_code", T.StringType()),
            T.StructField("dt", T.StringType()),
            T.StructField("transaction_count", T.LongType()),
            T.StructField("total_amount", T.DoubleType()),
            T.StructField("avg_amount", T.DoubleType()),
            T.StructField("max_amount", T.DoubleType()),
            T.StructField("min_amount", T.DoubleType()),
            T.StructField("stddev_amount", T.DoubleType()),
            *_GOLD_TAIL,
        ]
    ),
)
GOLD_BY_HOUR_SPEC = TableSpec(
    record_key="agg_key",
    ordering_field="processed_at",
    schema=T.StructType(
        [
            T.StructField("dt", T.StringType()),
            T.StructField("hour", T.IntegerType()),
            T.StructField("transaction_count", T.LongType()),
            T.StructField("total_amount", T.DoubleType()),
            T.StructField("unique_customers", T.LongType()),
            *_GOLD_TAIL,
        ]
    ),
)

# States of gold's groups, from which running totals are kept (``plans.totals``).
_STATE = [
    T.StructField("dt", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("m2", T.DoubleType()),
    T.StructField("least", T.DoubleType()),
    T.StructField("most", T.DoubleType()),
    T.StructField(COMMIT_COL, T.LongType()),
]


def _state_spec(*columns: T.StructField, shared: list[T.StructField] = _STATE) -> TableSpec:
    return TableSpec(record_key="dt", ordering_field=COMMIT_COL, schema=T.StructType([*shared, *columns]))


STATE_SPECS: Mapping[str, TableSpec] = {
    "state_by_category": _state_spec(T.StructField("category_code", T.StringType())),
    "state_by_hour": _state_spec(T.StructField("hour", T.IntegerType()), T.StructField("uniques", T.LongType())),
    "state_customers": _state_spec(
        T.StructField("hour", T.IntegerType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        shared=[_STATE[0], _STATE[-1]],
    ),
    "state_stale": _state_spec(shared=[_STATE[0], _STATE[-1]]),
}

PROGRESS_SPEC = TableSpec(
    partition_fields=("trigger_date",),
    record_key="epoch_id",
    ordering_field="trigger_us",
    schema=T.StructType(
        [
            T.StructField("stream_id", T.StringType()),
            T.StructField("run_id", T.StringType()),
            T.StructField("epoch_id", T.LongType()),
            T.StructField("trigger_us", T.LongType()),
            T.StructField("input_rows", T.LongType()),
            T.StructField("millis", T.LongType()),
            T.StructField("trigger_date", T.StringType()),
        ]
    ),
)

DEFAULT_SPECS: Mapping[str, TableSpec] = {
    "bronze_events": BRONZE_SPEC,
    "silver_events": SILVER_SPEC,
    "gold_agg_by_category": GOLD_BY_CATEGORY_SPEC,
    "gold_agg_by_hour": GOLD_BY_HOUR_SPEC,
}


@dataclass(frozen=True)
class Lake:
    """A set of layered tables under one base path."""

    base_path: str
    bronze_table: str = "bronze_events"
    silver_table: str = "silver_events"
    gold_prefix: str = "gold"
    audit_table: str = "batch_audit"
    progress_table: str = "stream_progress"
    specs: Mapping[str, TableSpec] = field(default_factory=lambda: dict(DEFAULT_SPECS))

    def spec(self, table: str) -> TableSpec:
        """Spec of ``table``; a table nobody described gets the defaults."""
        return self.specs.get(table, TableSpec())

    def path(self, table: str) -> str:
        return f"{self.base_path}/{table}"

    def gold_table(self, aggregation: str) -> str:
        return f"{self.gold_prefix}_agg_{aggregation}"
