"""Batches through the layers: delivery, recovery, audit, streaming."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions.marks import from_micros, micros_to_wall, to_micros, wall_to_micros
from tidemark.operators import gold
from tidemark.plans import layers
from tidemark.plans.batch import (
    BatchCounts,
    BatchWindow,
    append_audit,
    epoch_finished,
    high_water_mark,
    next_window,
    read_audit,
)
from tidemark.plans.layers import REFRESH, rebuild_days, run_batch
from tidemark.sources.readers import ColumnTypeError, snapshot, table_exists
from tidemark.sources.writers import clear_partitions, insert
from tidemark.spec import COMMIT_COL, Lake
from tidemark.streaming.arrivals import CADENCE, run_stream

START = datetime(2024, 1, 10, 12, tzinfo=timezone.utc)

BRONZE = (
    "id bigint, ts timestamp_ntz, dt string, amount string, quantity string, "
    "transaction_date string, category string, customer_id bigint, discount_pct double"
)


def _event(id_, day=1, amount="10", category="a", hour=7, ts_day=None):
    ts = datetime(2024, 1, ts_day or day, hour)
    date = f"2024-01-{day:02}"
    return (id_, ts, date, amount, "1", date, category, 5, None)


def _arrive(spark, lake, minute, *events):
    """Commit bronze rows ``minute`` minutes after START."""
    rows = spark.createDataFrame(list(events), BRONZE)
    mark = to_micros(START + timedelta(minutes=minute))
    insert(rows, lake.path(lake.bronze_table), lake.spec(lake.bronze_table), mark)


def _stored(spark, lake, name):
    return snapshot(spark, lake.path(name), lake.spec(name))


def _totals(spark, lake, name="by_category"):
    return {r.agg_key: r.total_amount for r in _stored(spark, lake, lake.gold_table(name)).collect()}


def test_window_arithmetic():
    end = datetime(2024, 1, 1, 0, 0, 0, 123456)
    window = BatchWindow.last(5, end)
    assert window.end_us - window.begin_us == 300_000_000
    assert window.batch_id == "20240101000000"
    assert to_micros(from_micros(window.end_us)) == window.end_us
    # A naive moment is UTC; another zone is converted.
    assert to_micros(end) == to_micros(end.replace(tzinfo=timezone.utc))
    assert to_micros(datetime(2024, 1, 1, 2, tzinfo=timezone(timedelta(hours=2)))) == to_micros(
        datetime(2024, 1, 1)
    )
    with pytest.raises(ValueError):
        BatchWindow(5, 5)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_marks_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 05:00:00.000001' AS wall")
        row = df.select(
            wall_to_micros(F.col("wall")).alias("us"),
            micros_to_wall(wall_to_micros(F.col("wall"))).alias("wall"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.us == to_micros(datetime(2024, 7, 1, 5, 0, 0, 1))
    assert row.wall == datetime(2024, 7, 1, 5, 0, 0, 1)


def test_windows_follow_the_mark(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1))
    assert next_window(spark, lake, START) is None  # not committed yet
    assert next_window(spark, lake, START + timedelta(minutes=5)).begin_us == 0
    run_batch(spark, lake, as_of=START + timedelta(minutes=5))
    assert from_micros(high_water_mark(spark, lake)) == START + timedelta(minutes=1)
    # The next run starts late; what arrived meanwhile is not lost.
    _arrive(spark, lake, 6, _event(2))
    _arrive(spark, lake, 13, _event(3))
    counts = run_batch(spark, lake, as_of=START + timedelta(minutes=14))
    assert counts.bronze_record_count == 2
    assert run_batch(spark, lake, as_of=START + timedelta(minutes=14)) is None
    assert read_audit(spark, lake).count() == 2


def test_mark_is_found_in_recent_and_in_old_days(spark, folder):
    lake, now = Lake(folder), datetime.now(timezone.utc)
    assert high_water_mark(spark, lake) is None
    for end in (START, now - timedelta(days=40), now - timedelta(days=30), now, now + timedelta(minutes=20)):
        append_audit(spark, lake, BatchWindow(0, to_micros(end)), BatchCounts(), 0.0, ("s", end.day))
        assert high_water_mark(spark, lake) == to_micros(end)
    audit = read_audit(spark, lake)
    assert audit.count() == 5


def test_epochs_are_told_apart(spark, folder):
    lake, now = Lake(folder), datetime.now(timezone.utc)
    assert not epoch_finished(spark, lake, "s", 0)
    append_audit(spark, lake, BatchWindow.between(START, now - timedelta(days=9)), BatchCounts(), 0.0, ("s", 4))
    append_audit(spark, lake, BatchWindow.between(START, now), BatchCounts(), 0.0, ("other", 9))
    append_audit(spark, lake, BatchWindow.between(START, now), BatchCounts(), 0.0)
    assert epoch_finished(spark, lake, "s", 4) and not epoch_finished(spark, lake, "s", 5)
    assert not epoch_finished(spark, lake, "new", 0)


def test_audit_row(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1), _event(1, hour=8), _event(2, category=None), _event(None))
    window = BatchWindow.between(START, START + timedelta(minutes=5))
    run_batch(spark, lake, window, as_of=START)
    row = read_audit(spark, lake).first().asDict()
    assert row.pop("processing_seconds") > 0
    assert row == {
        "begin_us": window.begin_us,
        "end_us": window.end_us,
        "commit_us": window.end_us,
        "mark_us": 0,  # the window left a gap before it
        "bronze_record_count": 4,
        "silver_record_count": 4,
        "silver_slice_count": 2,  # one older version, one row without a key
        "gold_by_category_count": 2,
        "gold_by_hour_count": 2,
        "total_gold_records": 4,
        "silver_rejected_count": 1,
        "gold_rejected_count": 1,  # the group without a category
        "stream_id": None,
        "epoch_id": None,
        "batch_id": "20240110120500",
        "start_time": "2024-01-10 12:00:00.000000",
        "end_time": "2024-01-10 12:05:00.000000",
        "batch_date": "2024-01-10",
        "batch_hour": "12",
        "batch_minute": "05",
        "commit_date": "2024-01-10",
    }


def test_empty_windows_and_empty_slices(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 20, _event(1))
    counts = run_batch(spark, lake, BatchWindow.between(START, START + timedelta(minutes=5)))
    assert set(vars(counts).values()) == {0}
    assert not table_exists(spark, lake.path("silver_events"), lake.spec("silver_events"))
    # Rows that all lose to newer stored ones leave gold alone.
    run_batch(spark, lake, BatchWindow.between(START, START + timedelta(minutes=21)))
    _arrive(spark, lake, 22, _event(1, hour=1, amount="99"))
    counts = run_batch(spark, lake, BatchWindow.between(START + timedelta(minutes=21), START + timedelta(minutes=25)))
    assert (counts.bronze_record_count, counts.silver_slice_count, counts.total_gold_records) == (1, 0, 0)
    assert _totals(spark, lake) == {"A_2024-01-01": 10.0}


def test_only_keyless_rows(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(None))
    counts = run_batch(spark, lake, BatchWindow.between(START, START + timedelta(minutes=5)))
    assert (counts.bronze_record_count, counts.silver_rejected_count) == (1, 1)


def test_slice_replaces_and_refresh_recomputes(spark, folder):
    for mode, expected in (("slice", 7.0), (REFRESH, 27.0)):
        lake = Lake(f"{folder}/{mode}")
        _arrive(spark, lake, 1, _event(1), _event(2), _event(9, day=2))
        _arrive(spark, lake, 6, _event(3, amount="7"))
        for minute in (5, 10):
            run_batch(spark, lake, as_of=START + timedelta(minutes=minute), gold_mode=mode)
        assert _totals(spark, lake) == {"A_2024-01-01": expected, "A_2024-01-02": 10.0}
    with pytest.raises(ValueError):
        run_batch(spark, lake, as_of=START + timedelta(minutes=20), gold_mode="guess")


@pytest.mark.parametrize("mode", ["slice", REFRESH])
def test_many_partitions_give_what_few_give(spark, folder, mode):
    """Groups, marks and counts do not depend on how partitions are matched."""
    results = []
    for cap in (1000, 2):
        lake = Lake(f"{folder}/{mode}-{cap}")
        _arrive(spark, lake, 1, *(_event(d, day=d) for d in range(1, 7)), _event(50, day=20))
        _arrive(spark, lake, 6, *(_event(10 + d, day=d, amount="5") for d in range(1, 4)), _event(51, day=20))
        counts = [
            run_batch(
                spark, lake, as_of=START + timedelta(minutes=m), gold_mode=mode, max_literal_partitions=cap
            )
            for m in (5, 10)
        ]
        rows = _stored(spark, lake, lake.gold_table("by_category")).drop("processed_at")
        results.append((counts, sorted(map(repr, rows.collect()))))
    assert results[0] == results[1]


def test_commits_visible_late_and_gaps_are_read(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1))
    run_batch(spark, lake, as_of=START + timedelta(minutes=10))
    _arrive(spark, lake, 5, _event(2))  # in flight at the tick, with an earlier mark
    assert run_batch(spark, lake, as_of=START + timedelta(minutes=15)).bronze_record_count == 1
    _arrive(spark, lake, 20, _event(3))
    _arrive(spark, lake, 30, _event(4))
    ahead = BatchWindow.between(START + timedelta(minutes=25), START + timedelta(minutes=35))
    run_batch(spark, lake, ahead)
    assert run_batch(spark, lake, as_of=START + timedelta(minutes=40)).bronze_record_count == 2
    assert _totals(spark, lake)["A_2024-01-01"] == 20.0
    assert _stored(spark, lake, "silver_events").count() == 4


def test_older_window_is_committed_after_the_last(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1))
    _arrive(spark, lake, 6, _event(2))
    windows = [BatchWindow.between(START + timedelta(minutes=m), START + timedelta(minutes=m + 5)) for m in (0, 5, 0)]
    marks = []
    for window in windows:
        run_batch(spark, lake, window)
        rows = _stored(spark, lake, lake.gold_table("by_category"))
        marks.append(rows.agg(F.max(COMMIT_COL)).first()[0])
    assert marks == sorted(marks) and marks[2] == marks[1] + 1


def test_gold_takes_the_last_batch_whatever_its_time(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1))
    _arrive(spark, lake, 6, _event(2, amount="7"))
    windows = [BatchWindow.between(START + timedelta(minutes=m), START + timedelta(minutes=m + 5)) for m in (0, 5)]
    for window, as_of in zip(windows, (START + timedelta(days=1), START), strict=True):
        run_batch(spark, lake, window, as_of=as_of)
    assert _totals(spark, lake) == {"A_2024-01-01": 7.0}


def test_new_bronze_columns_reach_silver(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1))
    wider = spark.createDataFrame([(*_event(2, day=2), "more")], BRONZE + ", extra string")
    mark = to_micros(START + timedelta(minutes=2))
    insert(wider, lake.path(lake.bronze_table), lake.spec(lake.bronze_table), mark)
    run_batch(spark, lake, as_of=START + timedelta(minutes=5))
    assert {r.id: r.extra for r in _stored(spark, lake, "silver_events").collect()} == {1: None, 2: "more"}


def test_text_discounts_do_not_stop_a_batch(spark):
    from tidemark.operators.silver import discount_amount

    rows = spark.createDataFrame([(10.0, "0.5"), (10.0, "n/a"), (10.0, None)], "amount double, pct string")
    found = rows.select(discount_amount(F.col("amount"), F.col("pct")).alias("d")).collect()
    assert [r.d for r in found] == [5.0, None, 0.0]


def test_inserting_another_type_is_refused(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1))
    other = spark.createDataFrame([_event(2)], BRONZE).withColumn("amount", F.lit(1.0))
    with pytest.raises(ColumnTypeError):
        insert(other, lake.path(lake.bronze_table), lake.spec(lake.bronze_table), 5)
    assert _stored(spark, lake, lake.bronze_table).collect()[0].amount == "10"


def test_refresh_drops_groups_that_emptied(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1, hour=7), _event(2, hour=9))
    _arrive(spark, lake, 6, _event(1, hour=8))
    for minute in (5, 10):
        run_batch(spark, lake, as_of=START + timedelta(minutes=minute), gold_mode=REFRESH)
    assert set(_totals(spark, lake, "by_hour")) == {"2024-01-01_8", "2024-01-01_9"}


@pytest.mark.parametrize("cap", [1000, 1])
def test_refresh_empties_days_without_valid_rows(spark, folder, cap):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1), _event(2, day=2), _event(3, day=3))
    _arrive(spark, lake, 6, _event(1, amount="-5", hour=8), _event(4, day=2, amount="1"))
    for minute in (5, 10):
        run_batch(
            spark, lake, as_of=START + timedelta(minutes=minute), gold_mode=REFRESH, max_literal_partitions=cap
        )
    assert _totals(spark, lake) == {"A_2024-01-02": 11.0, "A_2024-01-03": 10.0}
    assert set(_totals(spark, lake, "by_hour")) == {"2024-01-02_7", "2024-01-03_7"}
    # The day can fill again.
    _arrive(spark, lake, 11, _event(1, amount="3", hour=9))
    run_batch(spark, lake, as_of=START + timedelta(minutes=15), gold_mode=REFRESH)
    assert _totals(spark, lake)["A_2024-01-01"] == 3.0


def test_lost_partitions_are_rebuilt_from_bronze(spark, folder):
    lake = Lake(folder)
    undated = (8, datetime(2024, 1, 1, 7), "2024-01-01", "4", "1", "never", "a", 5, None)
    _arrive(spark, lake, 1, _event(1), _event(2, day=2), _event(2, day=2, hour=9, amount="6"), undated)
    _arrive(spark, lake, 6, _event(3, amount="1"))
    for minute in (5, 10):
        run_batch(spark, lake, as_of=START + timedelta(minutes=minute), gold_mode=REFRESH)
    state = lambda: sorted(
        (tuple(r) for r in _stored(spark, lake, "silver_events").drop(COMMIT_COL, "processed_at").collect()), key=repr
    )
    before, totals, mark = state(), _totals(spark, lake), high_water_mark(spark, lake)
    for table in ("silver_events", lake.gold_table("by_category")):
        stored, spec = _stored(spark, lake, table), lake.spec(table)
        lost = stored.where("dt = '2024-01-01'").select(*spec.partition_fields).distinct()
        clear_partitions(lost, lake.path(table), spec)
    assert len(state()) == len(before) - 2 and len(_totals(spark, lake)) == 1
    rebuild_days(spark, lake, ["2024-01-01", None], as_of=START)
    assert state() == before and _totals(spark, lake) == totals
    assert high_water_mark(spark, lake) == mark
    untouched = _stored(spark, lake, "silver_events").where("dt = '2024-01-02'").first()
    assert untouched[COMMIT_COL] <= mark


@pytest.mark.parametrize("mode", ["slice", REFRESH])
def test_crash_between_silver_and_gold_is_repaired(spark, folder, monkeypatch, mode):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1), _event(2, day=2))
    with monkeypatch.context() as patch:
        patch.setattr(layers.gold, "aggregations", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError, match="crash"):
            run_batch(spark, lake, as_of=START + timedelta(minutes=5), gold_mode=mode)
    assert high_water_mark(spark, lake) is None and _stored(spark, lake, "silver_events").count() == 2
    _arrive(spark, lake, 6, _event(3, amount="1"))
    counts = run_batch(spark, lake, as_of=START + timedelta(minutes=10), gold_mode=mode)
    assert counts.silver_slice_count == 3
    assert _totals(spark, lake) == {"A_2024-01-01": 11.0, "A_2024-01-02": 10.0}


def test_replay_of_a_window_changes_nothing(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1), _event(2, category="b"))
    window = BatchWindow.between(START, START + timedelta(minutes=5))
    states = []
    for _ in range(2):
        run_batch(spark, lake, window, as_of=START)
        names = ("silver_events", "gold_agg_by_category", "gold_agg_by_hour")
        states.append([sorted(map(tuple, _stored(spark, lake, n).collect()), key=repr) for n in names])
    assert states[0] == states[1]


def test_late_row_joins_its_own_day(spark, folder):
    lake = Lake(folder)
    _arrive(spark, lake, 1, _event(1))
    _arrive(spark, lake, 6, _event(2, day=3), _event(3, day=1, amount="5", ts_day=9))
    for minute in (5, 10):
        run_batch(spark, lake, as_of=START + timedelta(minutes=minute))
    # Accepted however late, and the day's row becomes that of the late slice.
    assert _totals(spark, lake) == {"A_2024-01-01": 5.0, "A_2024-01-03": 10.0}


def _stream(spark, lake, folder, checkpoint="checkpoint", **options):
    query = run_stream(
        spark,
        lake,
        f"{folder}/arrivals",
        spark.createDataFrame([], BRONZE).schema,
        f"{folder}/{checkpoint}",
        available_now=True,
        **options,
    )
    query.awaitTermination()
    return query


def _drop_off(spark, folder, *events):
    spark.createDataFrame(list(events), BRONZE).coalesce(1).write.mode("append").parquet(f"{folder}/arrivals")


def test_stream_takes_each_file_once(spark, folder):
    lake = Lake(f"{folder}/tables")
    _drop_off(spark, folder, _event(1), _event(2, day=2))
    _stream(spark, lake, folder)
    _stream(spark, lake, folder)
    _drop_off(spark, folder, _event(3, amount="7"))
    query = _stream(spark, lake, folder)
    audit = sorted(read_audit(spark, lake).collect(), key=lambda r: r.epoch_id)
    assert [(r.epoch_id, r.bronze_record_count) for r in audit] == [(0, 2), (1, 1)]
    assert {r.stream_id for r in audit} == {query.id}
    assert audit[0].end_us == audit[1].begin_us
    assert _totals(spark, lake) == {"A_2024-01-01": 7.0, "A_2024-01-02": 10.0}


def test_stream_on_a_cadence(spark, folder):
    lake = Lake(f"{folder}/tables")
    _drop_off(spark, folder, _event(1))
    assert CADENCE == "5 minutes"
    schema = spark.createDataFrame([], BRONZE).schema
    query = run_stream(
        spark, lake, f"{folder}/arrivals", schema, f"{folder}/checkpoint", cadence="1 second"
    )
    try:
        query.processAllAvailable()
        _drop_off(spark, folder, _event(2, day=2))
        query.processAllAvailable()
    finally:
        query.stop()
    assert _stored(spark, lake, "silver_events").count() == 2


def test_stream_started_over_counts_epochs_anew(spark, folder):
    lake = Lake(f"{folder}/tables")
    _drop_off(spark, folder, _event(1))
    _stream(spark, lake, folder, "first")
    _stream(spark, lake, folder, "second")
    assert [r.epoch_id for r in read_audit(spark, lake).collect()] == [0, 0]
    assert _stored(spark, lake, "silver_events").count() == 1


def test_stream_clock_that_stands_still(spark, folder):
    lake = Lake(f"{folder}/tables")
    for n in (1, 2, 3):
        _drop_off(spark, folder, _event(n, day=n))
    _stream(spark, lake, folder, max_files_per_trigger=1, clock=lambda _epoch: START)
    ends = sorted(r.end_us for r in read_audit(spark, lake).collect())
    assert ends == [to_micros(START) + n for n in range(3)]
    assert _stored(spark, lake, "silver_events").select(COMMIT_COL).distinct().count() == 3


def test_stream_repairs_a_crashed_epoch(spark, folder, monkeypatch):
    lake = Lake(f"{folder}/tables")
    _drop_off(spark, folder, _event(1), _event(2))
    with monkeypatch.context() as patch:
        patch.setattr(gold, "by_hour", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(Exception, match="crash"):
            _stream(spark, lake, folder)
    _stream(spark, lake, folder)
    assert read_audit(spark, lake).count() == 1
    assert _totals(spark, lake) == {"A_2024-01-01": 20.0}


def test_stream_archives_what_it_took(spark, folder):
    """Files leave the listing a run later; a crash in between brings nothing twice."""
    from pathlib import Path

    lake = Lake(f"{folder}/tables")
    for n in (1, 2, 3):
        _drop_off(spark, folder, _event(n, day=n))
        _stream(spark, lake, folder, archive=f"{folder}/archive", max_bytes_per_trigger=1 << 30, max_file_age="30d")
    left, moved = (len(list(Path(f"{folder}/{place}").rglob("part-*.parquet"))) for place in ("arrivals", "archive"))
    assert left + moved == 3 and moved >= 1
    assert _stored(spark, lake, "silver_events").count() == 3 and read_audit(spark, lake).count() == 3


def test_stream_leaves_bronze_to_the_schedule(spark, folder):
    lake = Lake(f"{folder}/tables")
    _arrive(spark, lake, 1, _event(1))
    _drop_off(spark, folder, _event(2, day=2))
    _stream(spark, lake, folder)
    counts = run_batch(spark, lake, as_of=START + timedelta(minutes=5))
    assert counts.bronze_record_count == 1 and _stored(spark, lake, "silver_events").count() == 2
    marks = sorted(r.commit_us for r in read_audit(spark, lake).collect())
    assert marks[1] == marks[0] + 1  # committed after the stream, whatever its window
    # a backfill and a clock that stands still: marks only grow
    rebuild_days(spark, lake, ["2024-01-01"], as_of=START)
    _drop_off(spark, folder, _event(3, day=3))
    _stream(spark, lake, folder, clock=lambda _epoch: START)
    marks = sorted(r.commit_us for r in read_audit(spark, lake).collect())
    assert len(set(marks)) == 4


def test_an_opening_write_counts_as_it_goes(spark, folder):
    """Rows, rows without a key and older versions, from the one job that writes them."""
    from tidemark.sources.writers import upsert
    from tidemark.spec import TableSpec

    spec = TableSpec(partition_fields=("dt",), record_key="id", ordering_field="ts")
    frame = spark.range(0, 1000, 1, 4).selectExpr("if(id % 10 = 0, null, id % 800) AS id", "id AS ts", "concat('d', id % 4) AS dt")
    report = upsert(frame, folder, spec, 1, on_null_key="reject")
    assert (report.rows, report.rejected, report.written) == (900, 100, 720)
    assert snapshot(spark, folder, spec).count() == 720


def test_a_batch_takes_few_executions(spark, folder):
    """Queries that Spark ran for one merged batch, those of the audit included."""
    lake = Lake(folder)
    _arrive(spark, lake, 1, *(_event(n, day=1 + n % 3) for n in range(30)))
    run_batch(spark, lake, as_of=START + timedelta(minutes=5))
    _arrive(spark, lake, 6, *(_event(n, day=1 + n % 3, hour=8) for n in range(15, 45)))
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run_batch(spark, lake, as_of=START + timedelta(minutes=10))
    # audit, window, survey, matched partitions, merge, two aggregates, audit row: 10 as counted
    assert store.executionsCount() - before <= 10


def test_stream_skips_a_recorded_epoch(spark, folder, monkeypatch):
    """The audit row was written, but not the checkpoint: the epoch comes again."""
    lake = Lake(f"{folder}/tables")
    _drop_off(spark, folder, _event(1))
    import tidemark.streaming.arrivals as arrivals

    append = arrivals.append_audit
    with monkeypatch.context() as patch:

        def append_then_crash(*args):
            append(*args)
            raise RuntimeError("crash")

        patch.setattr(arrivals, "append_audit", append_then_crash)
        with pytest.raises(Exception, match="crash"):
            _stream(spark, lake, folder)
    _drop_off(spark, folder, _event(2, day=2))
    _stream(spark, lake, folder)
    audit = sorted(read_audit(spark, lake).collect(), key=lambda r: r.epoch_id)
    assert [(r.epoch_id, r.bronze_record_count) for r in audit] == [(0, 1), (1, 1)]
    assert _stored(spark, lake, "silver_events").count() == 2
