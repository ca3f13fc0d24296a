"""One batch through the layers: bronze slice, silver upsert, gold upserts."""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel
from pyspark.util import inheritable_thread_target

from tidemark.functions.casts import lenient_date
from tidemark.functions.marks import as_utc
from tidemark.operators import gold
from tidemark.operators.merge import COMMIT_TIME, EVENT_TIME
from tidemark.operators.silver import event_day, to_silver
from tidemark.plans.batch import (
    BatchCounts,
    BatchWindow,
    append_audit,
    next_window,
    progress,
)
from tidemark.plans.totals import REPLACED_COLUMNS, TOTALS, Totals
from tidemark.sources.partitions import (
    MAX_LITERAL_PARTITIONS,
    Partitions,
    PartitionSpan,
    in_partitions_of,
    partitions_of,
)
from tidemark.sources.readers import incremental, read_table, snapshot
from tidemark.sources.writers import UpsertReport, clear_partitions, replace_partitions, stamped, upsert
from tidemark.spec import Lake, TableSpec

SLICE = "slice"
REFRESH = "refresh"
GOLD_MODES = (SLICE, REFRESH, TOTALS)

# A refresh recomputes whole days; gold tables are partitioned by them.
GOLD_DAY = ("dt",)


def process(
    spark: SparkSession,
    lake: Lake,
    bronze: DataFrame,
    window: BatchWindow,
    *,
    as_of: datetime | None = None,
    gold_mode: str = SLICE,
    merge_order: str = EVENT_TIME,
    commit_us: int | None = None,
    max_literal_partitions: int = MAX_LITERAL_PARTITIONS,
) -> BatchCounts:
    """Run the bronze rows of one batch through silver and gold.

    Silver and gold rows are committed as ``commit_us``, by default the window's end, and
    gold reads exactly the silver rows that commit wrote. ``merge_order`` is silver's;
    in gold the last batch always wins. ``gold_mode="slice"`` upserts aggregates of the batch
    alone, so the latest batch to touch a group replaces its row; ``"refresh"``
    recomputes the days the batch touches from all of silver, and a day without any
    valid row left has none in gold; ``"totals"`` gives the same from states that the
    batch's rows are added to and taken from. Rows without a day are left out of both.
    """
    if gold_mode not in GOLD_MODES:
        raise ValueError(f"unknown gold mode {gold_mode!r}")
    as_of = as_utc(as_of or datetime.now(timezone.utc))
    commit_us = window.end_us if commit_us is None else commit_us
    silver_path, silver_spec = lake.path(lake.silver_table), lake.spec(lake.silver_table)
    totals = Totals(spark, lake, commit_us)
    before_write = totals.before_write if gold_mode == TOTALS else totals.mark if totals.kept() else None

    silver_rows = to_silver(bronze, as_of)
    silver = upsert(
        silver_rows,
        silver_path,
        silver_spec,
        commit_us,
        merge_order=merge_order,
        on_null_key="reject",
        max_literal_partitions=max_literal_partitions,
        before_write=before_write,
        replaced_columns=REPLACED_COLUMNS if gold_mode == TOTALS else (),
    )
    sent = silver.rows + silver.rejected  # silver keeps every bronze row
    counts = {
        "bronze_record_count": sent,
        "silver_record_count": sent,
        "silver_rejected_count": silver.rejected,
        "silver_slice_count": silver.written,
    }
    if not silver.written:
        return BatchCounts(**counts)

    # The columns are known, so no file has to be opened to learn them.
    stored = replace(silver_spec, schema=stamped(silver_rows, commit_us).schema)
    # Not cached: each use reads a few columns of the row groups this commit wrote,
    # which is cheaper than building the cache.
    silver_slice = incremental(
        spark, silver_path, stored, commit_us - 1, commit_us, silver.partitions
    )
    dated = silver_slice.where(F.col("dt").isNotNull())
    days = touched = None
    if gold_mode == SLICE:
        tables = gold.aggregations(silver_slice, window.batch_id, as_of)
        touched = _days_of(silver.partitions)
    else:
        # Rows without a day, of all times, make no group that gold keeps.
        days = partitions_of(dated, GOLD_DAY, max_literal_partitions)
        if gold_mode == TOTALS and days is not None and days.values:
            states = totals.update(dated, days, lambda places: snapshot(spark, silver_path, stored, places))
            tables = {name: gold.from_states(found, name, window.batch_id, as_of) for name, found in states.items()}
        else:
            source = snapshot(spark, silver_path, stored, days or silver.partitions).where("dt IS NOT NULL")
            if days is None:  # too many to list: the same days by a join
                source = in_partitions_of(source, dated, GOLD_DAY)
            tables = gold.aggregations(source, window.batch_id, as_of)

    def clear_emptied(groups: DataFrame, path: str, spec: TableSpec) -> None:
        """Touched days that have no group any more lose the rows gold holds for them."""
        held = read_table(spark, path, spec, days)
        if held is None:
            return
        left = groups.where(F.col(spec.record_key).isNotNull())
        emptied = (
            in_partitions_of(held.select(*GOLD_DAY).distinct(), dated, GOLD_DAY)
            .join(left.select(*GOLD_DAY), list(GOLD_DAY), "left_anti")
        )
        clear_partitions(emptied, path, spec)

    def write(name: str) -> UpsertReport:
        path, spec = lake.path(lake.gold_table(name)), lake.spec(lake.gold_table(name))
        common = {"on_null_key": "reject", "unique": True}
        if gold_mode == SLICE:
            return upsert(tables[name], path, spec, commit_us, merge_order=COMMIT_TIME, touched=touched, **common)
        groups = tables[name].persist(StorageLevel.MEMORY_AND_DISK)
        try:
            report = replace_partitions(groups, path, spec, commit_us, **common)
            clear_emptied(groups, path, spec)
            return report
        finally:
            groups.unpersist()

    # Separate tables, so their jobs can share the cluster.
    with ThreadPoolExecutor(len(tables)) as pool:
        inherit = inheritable_thread_target(spark)
        writing = {name: pool.submit(inherit(write), name) for name in tables}
        reports = {name: future.result() for name, future in writing.items()}
    written = {name: report.rows + report.rejected for name, report in reports.items()}
    return BatchCounts(
        **counts,
        gold_by_category_count=written["by_category"],
        gold_by_hour_count=written["by_hour"],
        total_gold_records=sum(written.values()),
        gold_rejected_count=sum(report.rejected for report in reports.values()),
    )


def _days_of(touched: Partitions | PartitionSpan | None) -> Partitions | PartitionSpan | None:
    """The gold days that silver's touched partitions can change, None if they don't tell."""
    if isinstance(touched, PartitionSpan):
        return touched if (touched.field,) == GOLD_DAY else None
    if touched is None or GOLD_DAY[0] not in touched.fields:
        return None
    place = touched.fields.index(GOLD_DAY[0])
    return Partitions(GOLD_DAY, tuple({(value[place],): None for value in touched.values}))


def run_batch(
    spark: SparkSession,
    lake: Lake,
    window: BatchWindow | None = None,
    *,
    as_of: datetime | None = None,
    gold_mode: str = SLICE,
    merge_order: str = EVENT_TIME,
    max_literal_partitions: int = MAX_LITERAL_PARTITIONS,
) -> BatchCounts | None:
    """Process the bronze commits of ``window``, or everything since the last
    finished batch, and record the batch. None if there is nothing to cover.

    A window older than the last commit is a backfill: its rows are committed just after
    that, so that marks never decrease. A window that begins after the high-water mark
    leaves the mark where it is, so that what lies between is still read.
    """
    if gold_mode not in GOLD_MODES:
        raise ValueError(f"unknown gold mode {gold_mode!r}")
    started = time.monotonic()
    before = progress(spark, lake)
    mark = before.mark_us or 0
    window = window or next_window(spark, lake, as_of, mark)
    if window is None:
        return None
    bronze = incremental(
        spark, lake.path(lake.bronze_table), lake.spec(lake.bronze_table), window.begin_us, window.end_us
    )
    commit_us = before.commit_for(window)
    counts = process(
        spark,
        lake,
        bronze,
        window,
        as_of=as_of,
        gold_mode=gold_mode,
        merge_order=merge_order,
        commit_us=commit_us,
        max_literal_partitions=max_literal_partitions,
    )
    append_audit(
        spark,
        lake,
        window,
        counts,
        time.monotonic() - started,
        commit_us=commit_us,
        mark_us=max(mark, window.end_us) if window.begin_us <= mark else mark,
    )
    return counts


def rebuild_days(
    spark: SparkSession, lake: Lake, days: Sequence[str | None], *, as_of: datetime | None = None
) -> BatchCounts:
    """Run every bronze row of some event days (``yyyy-MM-dd``; None: rows without one)
    through the layers again, with gold refreshed.

    It brings back the rows a partition lost with a driver that went during a commit. Of
    the days' rows, those of the latest event time get a new commit, just after the last,
    whether they were lost or not. For silver merged by event time. Recorded like a
    backfill; the high-water mark stays.
    """
    started = time.monotonic()
    bronze = snapshot(spark, lake.path(lake.bronze_table), lake.spec(lake.bronze_table))
    day = event_day(lenient_date(F.col("transaction_date"), bronze.schema["transaction_date"].dataType))
    wanted = day.isin([d for d in days if d is not None])
    if None in days:
        wanted = wanted | day.isNull()
    before = progress(spark, lake)
    last, mark = before.commit_us or 0, before.mark_us or 0
    window = BatchWindow(last, last + 1)
    counts = process(spark, lake, bronze.where(wanted), window, as_of=as_of, gold_mode=REFRESH)
    append_audit(spark, lake, window, counts, time.monotonic() - started, mark_us=mark)
    return counts
