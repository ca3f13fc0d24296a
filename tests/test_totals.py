"""Running totals against whole days read again, and the states they are kept in."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions.marks import to_micros
from tidemark.operators import states
from tidemark.plans import layers, totals
from tidemark.plans.layers import REFRESH, SLICE, TOTALS, run_batch
from tidemark.sources.readers import read_table, snapshot
from tidemark.sources.writers import insert
from tidemark.spec import STATE_SPECS, Lake

START = datetime(2024, 1, 10, 12, tzinfo=timezone.utc)
BRONZE = (
    "id bigint, ts timestamp_ntz, dt string, amount string, quantity string, "
    "transaction_date string, category string, customer_id {}, discount_pct double"
)


def _event(id_, day=1, amount="10", category="a", hour=7, minute=0, customer=5):
    date = f"2024-01-{day:02}"
    return (id_, datetime(2024, 1, 1, hour, minute), date, amount, "1", date, category, customer, None)


def _arrive(spark, lake, minute, events, ids="bigint"):
    rows = spark.createDataFrame(events, BRONZE.format(ids))
    insert(rows, lake.path(lake.bronze_table), lake.spec(lake.bronze_table), to_micros(START + timedelta(minutes=minute)))


def _rows(spark, lake, name):
    table = lake.gold_table(name)
    return snapshot(spark, lake.path(table), lake.spec(table)).drop("_commit_us", "processed_at").collect()


def _gold(spark, lake):
    found = []
    for name in ("by_category", "by_hour"):
        for row in _rows(spark, lake, name):
            found.append(tuple(f"{v:.9g}" if isinstance(v, float) else v for v in row))
    return sorted(found, key=repr)


def _run(spark, lake, minute, mode):
    return run_batch(spark, lake, as_of=START + timedelta(minutes=minute), gold_mode=mode)


@pytest.mark.parametrize("ids", ["bigint", "string"])
def test_totals_equal_whole_days(spark, folder, ids):
    """Batches that add, correct, invalidate and move rows; amounts that are not finite."""
    chance = random.Random(11)
    whole, running = Lake(f"{folder}/whole"), Lake(f"{folder}/running")
    for batch in range(1, 4):
        events = []
        for n in range(60):
            amount = chance.choice(["5", "7.25", "0.1", "1e9", "-3", "n/a", None] + (["NaN", "Infinity"] if batch == 2 else []))
            customer = chance.choice([None, 1, 2, 40_000, -7, 10**12])
            events.append(
                _event(
                    chance.randrange(90),
                    day=chance.choice([1, 1, 2, batch + 2]),
                    amount=amount,
                    category=chance.choice(["a", "B", None]),
                    hour=chance.randrange(7, 10),
                    minute=10 * batch + n % 10,
                    customer=customer if ids == "bigint" or customer is None else f"c{customer}",
                )
            )
        for lake, mode in ((whole, REFRESH), (running, TOTALS)):
            _arrive(spark, lake, batch, events, ids)
            counts = _run(spark, lake, batch, mode)
            assert counts.total_gold_records > 0
        assert _gold(spark, running) == _gold(spark, whole)


def test_only_changed_groups_are_read_again(spark, folder, monkeypatch):
    lake, read = Lake(folder), []
    _arrive(spark, lake, 1, [_event(1, amount="1"), _event(2, amount="5"), _event(3, amount="9"), _event(4, category="b")])
    _run(spark, lake, 1, TOTALS)
    plain = totals.moments

    def seen(rows, keys, *rest):
        read.append((rows.select("id").distinct().count(), tuple(keys)))
        return plain(rows, keys, *rest)

    monkeypatch.setattr(totals, "moments", seen)
    # neither the least nor the greatest goes: the added row and the one it replaces are read
    _arrive(spark, lake, 6, [_event(2, amount="6", hour=8)])
    _run(spark, lake, 6, TOTALS)
    assert {n for n, _ in read} == {1}
    read.clear()
    # the greatest goes: of its category, three rows are read again; the other one's are not
    _arrive(spark, lake, 11, [_event(3, amount="2", hour=9)])
    _run(spark, lake, 11, TOTALS)
    assert max(n for n, keys in read if "category_code" in keys) == 3
    rows = {r.agg_key: (r.max_amount, r.total_amount) for r in _rows(spark, lake, "by_category")}
    assert rows == {"A_2024-01-01": (6.0, 9.0), "B_2024-01-01": (10.0, 10.0)}


def test_emptied_days_leave_and_return(spark, folder):
    lake = Lake(folder)
    for minute, events in (
        (1, [_event(1), _event(2, day=2)]),
        (6, [_event(1, amount="-1", hour=8)]),
        (11, [_event(1, amount="4", hour=9)]),
    ):
        _arrive(spark, lake, minute, events)
        _run(spark, lake, minute, TOTALS)
        days = {r.dt for name in ("by_category", "by_hour") for r in _rows(spark, lake, name)}
        assert days == ({"2024-01-02"} if minute == 6 else {"2024-01-01", "2024-01-02"})


@pytest.mark.parametrize("between", ["crash", SLICE])
def test_states_that_missed_a_batch_are_made_anew(spark, folder, monkeypatch, between):
    lake = Lake(folder)
    _arrive(spark, lake, 1, [_event(1), _event(2, customer=6)])
    _run(spark, lake, 1, TOTALS)
    _arrive(spark, lake, 6, [_event(3, amount="2"), _event(1, amount="1", hour=8)])
    if between == SLICE:
        _run(spark, lake, 6, SLICE)
    else:
        with monkeypatch.context() as patch:
            patch.setattr(layers.gold, "from_states", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
            patch.setattr(totals.Totals, "update", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
            with pytest.raises(RuntimeError, match="crash"):
                _run(spark, lake, 6, TOTALS)
    _arrive(spark, lake, 11, [_event(4, amount="3", customer=7)])
    _run(spark, lake, 11, TOTALS)
    (row,) = _rows(spark, lake, "by_category")
    assert (row.transaction_count, row.total_amount, row.max_amount, row.min_amount) == (4, 16.0, 10.0, 1.0)
    assert {r.hour: r.unique_customers for r in _rows(spark, lake, "by_hour")} == {7: 3, 8: 1}
    marks = read_table(spark, lake.path("state_stale"), STATE_SPECS["state_stale"])
    assert marks.where("dt IS NOT NULL").count() == 0


def test_bitmaps_count_distinct_numbers(spark):
    numbers = [0, 1, -1, 32_767, 32_768, 32_769, 10**15, -(10**15), 5, 5, None]
    rows = spark.createDataFrame([(i % 2, n) for i, n in enumerate(numbers * 3)], "g int, n bigint")
    halves = [states.bitmaps(rows.where(condition), ["g"], "n") for condition in ("n > 5", "n <= 40000 OR n IS NULL")]
    merged = states.merged_bitmaps(halves[0].unionByName(halves[1]), ["g"])
    found = {r.g: r.k for r in states.distinct_numbers(merged, ["g"], "k").collect()}
    assert found == {r.g: r.k for r in rows.groupBy("g").agg(F.countDistinct("n").alias("k")).collect()}


def test_states_merge_and_part(spark):
    rows = spark.range(200).selectExpr("id", "id % 3 AS g", "id % 7 AS part", "double(id * id % 31) + 1e6 AS amount")
    whole = states.moments(rows.where("part <> 2"), ["g"])
    parts = states.moments(rows, ["g"]).withColumn("sign", F.lit(1)).union(
        states.moments(rows.where("part = 2"), ["g"]).withColumn("sign", F.lit(-1))
    )
    found = {r.g: r for r in states.combined(parts, ["g"]).collect()}
    for row in whole.collect():
        merged = found[row.g]
        assert (merged.rows, merged.n, merged.total) == (row.rows, row.n, row.total)
        assert merged.m2 == pytest.approx(row.m2, rel=1e-6)
        assert merged.anew or (merged.least, merged.most) == (row.least, row.most)


def test_states_of_several_parts_are_taken_back(spark):
    rows = spark.range(200).selectExpr("id", "id % 3 AS g", "id % 7 AS part", "double(id * id % 31) + 1e6 AS amount")
    whole = {r.g: r for r in states.moments(rows.where("part < 5"), ["g"]).collect()}
    gone = states.moments(rows.where("part >= 5"), ["g", "part"]).drop("part").withColumn("sign", F.lit(-1))
    for row in states.combined(states.moments(rows, ["g"]).withColumn("sign", F.lit(1)).union(gone), ["g"]).collect():
        assert (row.rows, row.n, row.total) == (whole[row.g].rows, whole[row.g].n, whole[row.g].total)
        assert row.m2 == pytest.approx(whole[row.g].m2, rel=1e-6)


def test_replaced_rows_are_aggregated_once(spark, folder, monkeypatch):
    lake, made = Lake(folder), []
    _arrive(spark, lake, 1, [_event(1), _event(2, hour=8), _event(3, category="b")])
    _run(spark, lake, 1, TOTALS)
    plain = totals.moments
    monkeypatch.setattr(totals, "moments", lambda rows, keys, *rest: made.append(tuple(keys)) or plain(rows, keys, *rest))
    before = totals.Totals.before_write
    passes = []

    def counted(self, replaced, touched):
        before(self, replaced, touched)
        passes.append(len(made))

    monkeypatch.setattr(totals.Totals, "before_write", counted)
    _arrive(spark, lake, 6, [_event(1, amount="4", hour=9), _event(2, amount="5", hour=9)])
    _run(spark, lake, 6, TOTALS)
    assert passes == [1]
    assert {r.agg_key: r.total_amount for r in _rows(spark, lake, "by_category")} == {"A_2024-01-01": 9.0, "B_2024-01-01": 10.0}
    assert {r.hour: r.total_amount for r in _rows(spark, lake, "by_hour")} == {7: 10.0, 9: 9.0}
