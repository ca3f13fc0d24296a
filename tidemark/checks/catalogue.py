"""One query per operator. Each reads whole tables; those that exercise a sink
write their tables to a fresh folder and return a read of the result."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.checks.bronze import bronze_rows, table, workspace
from tidemark.functions.marks import from_micros
from tidemark.operators import gold
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import COMMIT_TIME
from tidemark.operators.silver import to_silver
from tidemark.plans.batch import BatchWindow, read_audit, with_batch_metadata
from tidemark.plans.layers import REFRESH, TOTALS, run_batch
from tidemark.sources.readers import incremental, snapshot, table_exists
from tidemark.sources.writers import bulk_insert, insert, remove, upsert
from tidemark.spec import BRONZE_SPEC, COMMIT_COL, PROGRESS_SPEC, SILVER_SPEC, Lake
from tidemark.streaming.arrivals import run_stream
from tidemark.streaming.progress import ProgressLog

Query = Callable[[SparkSession, str], DataFrame]

# Stands in for the clock, so that stamped columns can be compared.
AS_OF = datetime(2024, 3, 1, tzinfo=timezone.utc)
BATCH_ID = "20240301000000"

# Number of windows the commit range is cut into by the queries that run batches.
BATCHES = 3

_KEY = ["id", "ver"]
_MEASURES = {
    "total_amount": 2,
    "avg_amount": 4,
    "max_amount": 2,
    "min_amount": 2,
    "stddev_amount": 4,
    "discount_amount": 4,
}


def _settled(name: str) -> Column:
    if name == "transaction_date":  # as text: the two engines' clients box dates differently
        return F.col(name).cast("string").alias(name)
    # Floating sums differ in their last digits with the order of addition; the
    # nudge keeps values that end in a five from rounding either way.
    if name not in _MEASURES:
        return F.col(name)
    nudge = 1e-9 if _MEASURES[name] > 2 else 0.0
    return F.round(F.col(name) + F.lit(nudge), _MEASURES[name]).alias(name)


def _pick(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[_settled(c) for c in columns])


_CATEGORY = (
    "category_code",
    "dt",
    "transaction_count",
    "total_amount",
    "avg_amount",
    "max_amount",
    "min_amount",
    "stddev_amount",
    "batch_id",
    "agg_key",
)
_HOUR = ("dt", "hour", "transaction_count", "total_amount", "unique_customers", "batch_id", "agg_key")
_SILVER = (
    "id",
    "ver",
    "ts",
    "category",
    "customer_id",
    "amount",
    "quantity",
    "discount_pct",
    "transaction_date",
    "dt",
    COMMIT_COL,
    "is_valid",
    "category_code",
    "has_customer_id",
    "discount_amount",
)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(bronze_rows(spark, sf_dir), AS_OF)


def _silver_columns(*columns: str) -> Query:
    return lambda spark, sf_dir: _pick(_silver(spark, sf_dir), *_KEY, *columns)


def gold_valid_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(gold.valid_rows(_silver(spark, sf_dir)), *_KEY, "amount", "category_code", "dt")


def gold_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(gold.by_category(_silver(spark, sf_dir), BATCH_ID, AS_OF), *_CATEGORY)


def gold_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pick(gold.by_hour(_silver(spark, sf_dir), BATCH_ID, AS_OF), *_HOUR)


def gold_agg_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = gold.aggregations(_silver(spark, sf_dir), BATCH_ID, AS_OF)
    keys = [t.select(F.lit(name).alias("aggregation"), "dt", "agg_key") for name, t in tables.items()]
    return keys[0].unionByName(keys[1])


def precombine_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_per_key(_silver(spark, sf_dir), SILVER_SPEC.keys, SILVER_SPEC.ordering_field)
    return _pick(latest, *_SILVER)


def precombine_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(
        table(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"), "l_shipdate"
    )


def _originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(spark, sf_dir).where("ver = 0")


def _corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(spark, sf_dir).where("ver = 1")


def insert_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    insert(_originals(spark, sf_dir), path, BRONZE_SPEC, 1)
    insert(_corrections(spark, sf_dir), path, BRONZE_SPEC, 2)
    return snapshot(spark, path, BRONZE_SPEC)


def bulk_inserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    bulk_insert(_silver(spark, sf_dir), path, SILVER_SPEC)
    return _pick(snapshot(spark, path, SILVER_SPEC), *_SILVER)


def snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    bulk_insert(bronze_rows(spark, sf_dir), path, BRONZE_SPEC)
    return snapshot(spark, path, BRONZE_SPEC)


def partitioned_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition directory; a blank category and a missing one share it."""
    path = workspace(spark)
    blank = F.when(F.col("ver") == 0, F.col("category_code")).otherwise(F.lit(""))
    bulk_insert(_silver(spark, sf_dir).withColumn("category_code", blank), path, SILVER_SPEC)
    stored = snapshot(spark, path, SILVER_SPEC)
    return stored.groupBy("dt", "category_code").agg(F.count(F.lit(1)).alias("row_count"))


def commit_windows(bronze: DataFrame, batches: int = BATCHES) -> list[BatchWindow]:
    """Adjoining windows that cover every commit of ``bronze``."""
    first, last = bronze.agg(F.min(COMMIT_COL), F.max(COMMIT_COL)).first()
    begin = first - 1
    marks = [begin + i * (last - begin) // batches for i in range(batches + 1)]
    return [BatchWindow(a, b) for a, b in zip(marks, marks[1:])]


def incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commits of the middle window."""
    path, rows = workspace(spark), bronze_rows(spark, sf_dir)
    bulk_insert(rows, path, BRONZE_SPEC)
    window = commit_windows(rows)[1]
    return incremental(spark, path, BRONZE_SPEC, window.begin_us, window.end_us)


def _upserts(first: Query, second: Query, **options: str) -> Query:
    """Silver after two batches, the second committed over the first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = workspace(spark)
        for mark, rows in enumerate((first, second), start=1):
            upsert(to_silver(rows(spark, sf_dir), AS_OF), path, SILVER_SPEC, mark, **options)
        return _pick(snapshot(spark, path, SILVER_SPEC), *_SILVER)

    return run


def upsert_partition_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose correction fell on another day: a row stays in each partition."""
    stored = _upserts(_originals, _corrections)(spark, sf_dir)
    places = stored.groupBy("id").agg(F.count(F.lit(1)).alias("partitions"))
    return places.where("partitions > 1")


def batch_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the five-minute batch behind every commit slot."""
    slots = bronze_rows(spark, sf_dir).select(F.col(COMMIT_COL).alias("end_us")).distinct()
    five_minutes = 5 * 60 * 1_000_000
    return with_batch_metadata(slots.withColumn("begin_us", F.col("end_us") - F.lit(five_minutes)))


def _run_batches(spark: SparkSession, sf_dir: str, **options: str) -> Lake:
    lake, rows = Lake(workspace(spark)), bronze_rows(spark, sf_dir)
    bulk_insert(rows, lake.path(lake.bronze_table), lake.spec(lake.bronze_table))
    for window in commit_windows(rows):
        run_batch(spark, lake, window, as_of=from_micros(window.end_us), **options)
    return lake


def _stored(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return snapshot(spark, lake.path(name), lake.spec(name))


def batches_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _run_batches(spark, sf_dir)
    return _pick(_stored(spark, lake, lake.silver_table), *_SILVER)


def _gold_after_batches(aggregation: str, columns: tuple[str, ...], **options: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = _run_batches(spark, sf_dir, **options)
        return _pick(_stored(spark, lake, lake.gold_table(aggregation)), *columns)

    return run


_AUDIT = (
    "batch_id",
    "bronze_record_count",
    "silver_record_count",
    "silver_slice_count",
    "gold_by_category_count",
    "gold_by_hour_count",
    "total_gold_records",
    "silver_rejected_count",
    "gold_rejected_count",
)


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_audit(spark, _run_batches(spark, sf_dir)).select(*_AUDIT)


def empty_batch_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window after the last commit writes nothing but its audit row."""
    lake, rows = Lake(workspace(spark)), bronze_rows(spark, sf_dir)
    bulk_insert(rows, lake.path(lake.bronze_table), lake.spec(lake.bronze_table))
    everything = commit_windows(rows, 1)[0]
    hour = 3600 * 1_000_000
    for window in (everything, BatchWindow(everything.end_us, everything.end_us + hour)):
        run_batch(spark, lake, window, as_of=from_micros(window.end_us))
    return read_audit(spark, lake).select(*_AUDIT)


def scheduled_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows arrive between runs; each run takes what became visible since the last."""
    lake, rows = Lake(workspace(spark)), bronze_rows(spark, sf_dir)
    for window in commit_windows(rows):
        arrived = (F.col(COMMIT_COL) > window.begin_us) & (F.col(COMMIT_COL) <= window.end_us)
        insert(rows.where(arrived), lake.path(lake.bronze_table), lake.spec(lake.bronze_table))
        run_batch(spark, lake, as_of=from_micros(window.end_us))
    return _pick(_stored(spark, lake, lake.silver_table), *_SILVER)


def backfill_older_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows, then the first again: its rows that still stand get a later commit."""
    lake = _run_batches(spark, sf_dir)
    first = commit_windows(bronze_rows(spark, sf_dir))[0]
    run_batch(spark, lake, first, as_of=from_micros(first.end_us))
    return _pick(_stored(spark, lake, lake.silver_table), *_SILVER)


def bronze_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections bring a column that the originals lack."""
    lake, rows = Lake(workspace(spark)), bronze_rows(spark, sf_dir)
    path, spec = lake.path(lake.bronze_table), lake.spec(lake.bronze_table)
    insert(_originals(spark, sf_dir), path, spec)
    insert(_corrections(spark, sf_dir).withColumn("extra", F.concat(F.lit("c"), "id")), path, spec)
    window = commit_windows(rows, 1)[0]
    run_batch(spark, lake, window, as_of=from_micros(window.end_us))
    return _pick(_stored(spark, lake, lake.silver_table), *_SILVER, "extra")


def upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two batches is delivered twice."""
    path = workspace(spark)
    for mark, rows in ((1, _originals), (2, _corrections), (2, _corrections)):
        upsert(to_silver(rows(spark, sf_dir), AS_OF), path, SILVER_SPEC, mark)
    return _pick(snapshot(spark, path, SILVER_SPEC), *_SILVER)


def _gold_after_an_emptied_day(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """After all windows, every amount of the first day is corrected to an invalid one."""
        lake = _run_batches(spark, sf_dir, gold_mode=mode)
        rows = bronze_rows(spark, sf_dir)
        first_day = rows.agg(F.min("transaction_date")).first()[0]
        end = commit_windows(rows)[-1].end_us
        corrected = rows.where(F.col("transaction_date") == first_day).withColumns(
            {"amount": F.lit("-1"), "ts": F.col("ts") + F.expr("INTERVAL 2 DAY")}
        )
        insert(corrected, lake.path(lake.bronze_table), lake.spec(lake.bronze_table), end + 1)
        run_batch(spark, lake, BatchWindow(end, end + 1), as_of=from_micros(end + 1), gold_mode=mode)
        return _pick(_stored(spark, lake, lake.gold_table("by_category")), *_CATEGORY)

    return run


def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals arrive and are taken, then corrections; the second run sees only
    the new files."""
    base = workspace(spark)
    lake, arrivals = Lake(f"{base}/tables"), f"{base}/arrivals"
    for step, rows in enumerate((_originals, _corrections), start=1):
        arriving = rows(spark, sf_dir)
        arriving.write.mode("append").parquet(arrivals)
        run_stream(
            spark,
            lake,
            arrivals,
            arriving.schema,
            f"{base}/checkpoint",
            available_now=True,
            clock=lambda _epoch, step=step: from_micros(step),
        ).awaitTermination()
    return _pick(_stored(spark, lake, lake.silver_table), *_SILVER)


def table_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which tables are there after a batch; one was never written."""
    lake = _run_batches(spark, sf_dir)
    names = (lake.bronze_table, lake.silver_table, lake.gold_table("by_category"), lake.gold_table("by_day"))
    found = [(name, table_exists(spark, lake.path(name), lake.spec(name))) for name in names]
    return spark.createDataFrame(found, "table_name string, present boolean")


def stream_epoch_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An epoch's audit row is lost, so the same files come again under another stream."""
    base = workspace(spark)
    lake, arrivals = Lake(f"{base}/tables"), f"{base}/arrivals"
    arriving = bronze_rows(spark, sf_dir)
    arriving.write.parquet(arrivals)
    for step in (1, 2):
        if step == 2:
            remove(spark, lake.path(lake.audit_table))
        run_stream(
            spark, lake, arrivals, arriving.schema, f"{base}/checkpoint-{step}", available_now=True,
            clock=lambda _epoch: from_micros(7),
        ).awaitTermination()
    return _pick(_stored(spark, lake, lake.silver_table), *_SILVER)


def stream_then_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals wait in bronze while corrections are streamed into the same lake; the
    scheduled batch then takes the originals, all of them."""
    base = workspace(spark)
    lake, arrivals = Lake(f"{base}/tables"), f"{base}/arrivals"
    originals, corrections = _originals(spark, sf_dir), _corrections(spark, sf_dir)
    insert(originals, lake.path(lake.bronze_table), lake.spec(lake.bronze_table))
    corrections.write.parquet(arrivals)
    last = commit_windows(bronze_rows(spark, sf_dir), 1)[0].end_us
    run_stream(
        spark, lake, arrivals, corrections.schema, f"{base}/checkpoint", available_now=True,
        clock=lambda _epoch: from_micros(last + 1),
    ).awaitTermination()
    run_batch(spark, lake, as_of=from_micros(last + 2))
    return _pick(_stored(spark, lake, lake.silver_table), *[c for c in _SILVER if c != COMMIT_COL])


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The epochs that read rows, as Spark's listener was told."""
    base = workspace(spark)
    lake, arrivals = Lake(f"{base}/tables"), f"{base}/arrivals"
    log = ProgressLog(spark, lake)
    spark.streams.addListener(log)
    try:
        for step, rows in enumerate((_originals, _corrections), start=1):
            arriving = rows(spark, sf_dir)
            arriving.write.mode("append").parquet(arrivals)
            query = run_stream(
                spark, lake, arrivals, arriving.schema, f"{base}/checkpoint", available_now=True,
                clock=lambda _epoch, step=step: from_micros(step),
            )
            query.awaitTermination()
            log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    told = snapshot(spark, lake.path(lake.progress_table), PROGRESS_SPEC)
    return told.groupBy("epoch_id").agg(F.bool_and(F.col("input_rows") > 0).alias("read_rows"))


def bulk_insert_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    bulk_insert(_silver(spark, sf_dir), path, SILVER_SPEC, cluster_by=("ts", "customer_id"))
    return _pick(snapshot(spark, path, SILVER_SPEC), *_SILVER)


QUERIES: dict[str, Query] = {
    "bronze_fixture": bronze_rows,
    "silver_processed_at": _silver_columns("processed_at"),
    "silver_amount_cast": _silver_columns("amount"),
    "silver_quantity_cast": _silver_columns("quantity"),
    "silver_transaction_date": _silver_columns("transaction_date"),
    "silver_is_valid": _silver_columns("is_valid"),
    "silver_category_code": _silver_columns("category_code"),
    "silver_dt": _silver_columns("dt"),
    "silver_has_customer_id": _silver_columns("has_customer_id"),
    "silver_discount_amount": _silver_columns("discount_amount"),
    "silver_full": lambda spark, sf_dir: _pick(_silver(spark, sf_dir), *_SILVER),
    "gold_valid_filter": gold_valid_filter,
    "gold_by_category": gold_by_category,
    "gold_by_hour": gold_by_hour,
    "gold_agg_keys": gold_agg_keys,
    "precombine_events": precombine_events,
    "precombine_lineitem": precombine_lineitem,
    "insert_append": insert_append,
    "bulk_insert": bulk_inserted,
    "snapshot_read": snapshot_read,
    "partitioned_layout": partitioned_layout,
    "incremental_read": incremental_read,
    "upsert_two_batches": _upserts(_originals, _corrections),
    "upsert_older_ts_loses": _upserts(_corrections, _originals),
    "upsert_commit_time": _upserts(_corrections, _originals, merge_order=COMMIT_TIME),
    "upsert_partition_move": upsert_partition_move,
    "batch_metadata": batch_metadata,
    "batch_counts": batch_counts,
    "empty_batch_guard": empty_batch_guard,
    "batches_end_to_end": batches_end_to_end,
    "gold_last_batch_wins": _gold_after_batches("by_category", _CATEGORY),
    "gold_last_batch_wins_by_hour": _gold_after_batches("by_hour", _HOUR),
    "gold_refresh": _gold_after_batches("by_category", _CATEGORY, gold_mode=REFRESH),
    "gold_refresh_by_hour": _gold_after_batches("by_hour", _HOUR, gold_mode=REFRESH),
    "gold_processed_at": _gold_after_batches("by_category", ("category_code", "dt", "processed_at")),
    "gold_refresh_emptied_day": _gold_after_an_emptied_day(REFRESH),
    "gold_totals": _gold_after_batches("by_category", _CATEGORY, gold_mode=TOTALS),
    "gold_totals_by_hour": _gold_after_batches("by_hour", _HOUR, gold_mode=TOTALS),
    "gold_totals_emptied_day": _gold_after_an_emptied_day(TOTALS),
    "table_probe": table_probe,
    "stream_epoch_replay": stream_epoch_replay,
    "stream_then_scheduled": stream_then_scheduled,
    "stream_progress": stream_progress,
    "bulk_insert_clustered": bulk_insert_clustered,
    "scheduled_batches": scheduled_batches,
    "backfill_older_window": backfill_older_window,
    "bronze_new_column": bronze_new_column,
    "upsert_replay": upsert_replay,
    "stream_available_now": stream_available_now,
}
