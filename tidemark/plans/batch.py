"""Batch windows, batch metadata and the audit table."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.marks import as_utc, from_micros, micros_to_wall, to_micros
from tidemark.sources.partitions import Partitions
from tidemark.sources.readers import AGE_MARGIN_US, read_table
from tidemark.spec import COMMIT_COL, Lake, TableSpec


@dataclass(frozen=True)
class BatchWindow:
    """The commits in ``(begin, end]``, as microsecond marks."""

    begin_us: int
    end_us: int

    def __post_init__(self) -> None:
        if self.begin_us >= self.end_us:
            raise ValueError("a batch window must end after it begins")

    @classmethod
    def between(cls, begin: datetime, end: datetime) -> BatchWindow:
        return cls(to_micros(begin), to_micros(end))

    @classmethod
    def last(cls, minutes: int = 5, now: datetime | None = None) -> BatchWindow:
        """The ``minutes`` up to now."""
        end = as_utc(now or datetime.now(timezone.utc))
        return cls.between(end - timedelta(minutes=minutes), end)

    @property
    def batch_id(self) -> str:
        return f"{from_micros(self.end_us):%Y%m%d%H%M%S}"


def with_batch_metadata(windows: DataFrame) -> DataFrame:
    """Add id, bounds and calendar parts to rows with ``begin_us`` and ``end_us``.
    Id and calendar parts are those of the window's end, in UTC."""
    begin, end = micros_to_wall(F.col("begin_us")), micros_to_wall(F.col("end_us"))

    def text(moment: Column, pattern: str) -> Column:
        return F.date_format(moment, pattern)

    return windows.withColumns(
        {
            "batch_id": text(end, "yyyyMMddHHmmss"),
            "start_time": text(begin, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "end_time": text(end, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "batch_date": text(end, "yyyy-MM-dd"),
            "batch_hour": text(end, "HH"),
            "batch_minute": text(end, "mm"),
        }
    )


@dataclass(frozen=True)
class BatchCounts:
    """Rows a batch read and wrote, layer by layer."""

    bronze_record_count: int = 0
    silver_record_count: int = 0
    silver_slice_count: int = 0
    gold_by_category_count: int = 0
    gold_by_hour_count: int = 0
    total_gold_records: int = 0
    silver_rejected_count: int = 0
    gold_rejected_count: int = 0


AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("begin_us", T.LongType()),
        T.StructField("end_us", T.LongType()),
        T.StructField("commit_us", T.LongType()),
        T.StructField("mark_us", T.LongType()),
        *[T.StructField(f.name, T.LongType()) for f in fields(BatchCounts)],
        T.StructField("stream_id", T.StringType()),
        T.StructField("epoch_id", T.LongType()),
        T.StructField("processing_seconds", T.DoubleType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("batch_date", T.StringType()),
        T.StructField("batch_hour", T.StringType()),
        T.StructField("batch_minute", T.StringType()),
        T.StructField("commit_date", T.StringType()),
    ]
)
# By the day of the commit mark, which never decreases: the newest batches, backfills of old
# windows included, are in the newest directories.
AUDIT_SPEC = TableSpec(
    partition_fields=("commit_date",),
    record_key="batch_id",
    ordering_field="end_us",
    schema=AUDIT_SCHEMA,
)


def append_audit(
    spark: SparkSession,
    lake: Lake,
    window: BatchWindow,
    counts: BatchCounts,
    processing_seconds: float,
    epoch: tuple[str, int] | None = None,
    commit_us: int | None = None,
    mark_us: int | None = None,
) -> None:
    """Record a finished batch, with the stream and epoch it came from if any, the mark
    its rows were committed with and the high-water mark after it, by default both the
    window's end. Written last: a batch that fails before this is
    read again by the next run."""
    values = {
        "begin_us": window.begin_us,
        "end_us": window.end_us,
        "commit_us": window.end_us if commit_us is None else commit_us,
        "mark_us": window.end_us if mark_us is None else mark_us,
        **asdict(counts),
        "stream_id": epoch[0] if epoch else None,
        "epoch_id": epoch[1] if epoch else None,
        "processing_seconds": processing_seconds,
    }
    columns = [
        F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in AUDIT_SCHEMA if f.name in values
    ]
    (
        with_batch_metadata(spark.range(0, 1, numPartitions=1).select(*columns))
        .withColumn("commit_date", F.date_format(micros_to_wall(F.col("commit_us")), "yyyy-MM-dd"))
        .write.mode("append")
        .partitionBy(*AUDIT_SPEC.partition_fields)
        .parquet(lake.path(lake.audit_table))
    )


def read_audit(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """One row per finished batch; None before the first."""
    return read_table(spark, lake.path(lake.audit_table), AUDIT_SPEC)


@dataclass(frozen=True)
class Progress:
    """Where finished batches stand: ``mark_us``, up to where windows cover all commits of
    bronze without a gap; ``commit_us``, the greatest mark rows were committed with, and the
    window of that batch; ``epoch``, the last of the stream asked for."""

    mark_us: int | None = None
    commit_us: int | None = None
    window: BatchWindow | None = None
    epoch: int | None = None

    def commit_for(self, window: BatchWindow) -> int:
        """The mark to commit the rows of ``window`` with: its end, or just after the last
        commit if that is as late. The last window, run again, keeps its mark."""
        if self.commit_us is None or window.end_us > self.commit_us:
            return window.end_us
        return self.commit_us if window == self.window else self.commit_us + 1


def progress(spark: SparkSession, lake: Lake, stream_id: str | None = None) -> Progress:
    """One read of the audit: of the directories of these days, and of the others only if
    these hold nothing. It gains a small file every few minutes, for years."""
    now = datetime.now(timezone.utc)
    recent = tuple((f"{now - timedelta(days=back):%Y-%m-%d}",) for back in (-1, 0, 1))
    latest = F.max(F.struct("commit_us", "begin_us", "end_us"))
    epoch = F.max(F.when(F.col("stream_id") == F.lit(stream_id), F.col("epoch_id")))
    row = None
    for days in (Partitions(AUDIT_SPEC.partition_fields, recent), None):
        audit = read_table(spark, lake.path(lake.audit_table), AUDIT_SPEC, days)
        if audit is not None:
            row = audit.agg(F.max("mark_us").alias("mark"), latest.alias("latest"), epoch.alias("epoch")).first()
            if row.latest is not None and (stream_id is None or row.epoch is not None):
                break
    if row is None or row.latest is None:
        return Progress()
    window = BatchWindow(row.latest.begin_us, row.latest.end_us)
    return Progress(row.mark, row.latest.commit_us, window, row.epoch)


def high_water_mark(spark: SparkSession, lake: Lake) -> int | None:
    """Up to where finished windows cover all commits without a gap."""
    return progress(spark, lake).mark_us


def next_window(
    spark: SparkSession, lake: Lake, now: datetime | None = None, begin: int | None = None
) -> BatchWindow | None:
    """Every commit visible in bronze since ``begin``, by default the high-water mark, so
    that windows tile without gap or overlap. It ends at the greatest of these, not at the
    present: a commit that becomes visible later with a greater mark, as those of one writer
    do, is in the next window. None if there is none. Files older than ``begin`` stay shut."""
    if begin is None:
        begin = high_water_mark(spark, lake) or 0
    spec = TableSpec(
        lake.spec(lake.bronze_table).partition_fields,
        schema=T.StructType([T.StructField(COMMIT_COL, T.LongType())]),
    )
    marks = read_table(spark, lake.path(lake.bronze_table), spec, after_us=begin - AGE_MARGIN_US)
    if marks is None:
        return None
    new = (F.col(COMMIT_COL) > begin) & (F.col(COMMIT_COL) <= to_micros(now or datetime.now(timezone.utc)))
    end = marks.where(new).agg(F.max(COMMIT_COL)).first()[0]
    return None if end is None else BatchWindow(begin, end)


def epoch_finished(spark: SparkSession, lake: Lake, stream_id: str, epoch_id: int) -> bool:
    last = progress(spark, lake, stream_id).epoch
    return last is not None and last >= epoch_id
