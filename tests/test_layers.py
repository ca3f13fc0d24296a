"""Edge rows of the silver and gold operators."""

from __future__ import annotations

import math
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark.operators import gold
from tidemark.operators.latest import latest_per_key
from tidemark.operators.silver import to_silver

AS_OF = datetime(2024, 3, 1, tzinfo=timezone.utc)

BRONZE = (
    "id bigint, ts timestamp_ntz, dt string, amount string, quantity string, "
    "transaction_date string, category string, customer_id string, discount_pct double, note string"
)


def _silver(spark, *rows):
    base = {
        "id": 1,
        "ts": datetime(2024, 1, 1, 7),
        "dt": "1999-01-01",
        "amount": "10",
        "quantity": "1",
        "transaction_date": "2024-01-01",
        "category": "a",
        "customer_id": "c",
        "discount_pct": None,
        "note": "kept",
    }
    values = [tuple({**base, **row}.values()) for row in rows]
    return to_silver(spark.createDataFrame(values, BRONZE), AS_OF)


def test_silver_types_and_order(spark):
    df = _silver(spark, {})
    assert dict(df.dtypes) == {
        "id": "bigint",
        "ts": "timestamp_ntz",
        "dt": "string",
        "amount": "double",
        "quantity": "int",
        "transaction_date": "date",
        "category": "string",
        "customer_id": "string",
        "discount_pct": "double",
        "note": "string",
        "processed_at": "timestamp",
        "is_valid": "boolean",
        "category_code": "string",
        "has_customer_id": "boolean",
        "discount_amount": "double",
    }
    row = df.first()
    assert row.dt == "2024-01-01" and row.note == "kept"
    assert row.processed_at.replace(tzinfo=None) == datetime(2024, 3, 1)


def test_silver_keeps_every_row_and_flags(spark):
    rows = [{"amount": a} for a in ("5", "0", "-1", "abc", None, "NaN")]
    assert [r.is_valid for r in _silver(spark, *rows).collect()] == [True, False, False, False, False, True]


def test_silver_discount(spark):
    rows = [
        {"discount_pct": 0.5},
        {},
        {"amount": "x", "discount_pct": 0.5},
        {"amount": "x"},
        {"amount": "-10", "discount_pct": 2.0},
    ]
    assert [r.discount_amount for r in _silver(spark, *rows).collect()] == [5.0, 0.0, None, 0.0, -20.0]


def test_silver_text(spark):
    rows = _silver(
        spark,
        {"category": "straße", "customer_id": ""},
        {"category": None, "customer_id": None, "transaction_date": "never"},
    ).collect()
    assert (rows[0].category_code, rows[0].has_customer_id) == ("STRASSE", True)
    assert (rows[1].category_code, rows[1].has_customer_id, rows[1].dt) == (None, False, None)


def test_silver_clock(spark):
    df = to_silver(_silver(spark, {}).drop("processed_at"))
    assert df.first().processed_at is not None


def test_gold_by_category_edges(spark):
    silver = _silver(
        spark,
        {"id": 1, "category": "solo"},
        {"id": 2, "category": "nan", "amount": "NaN"},
        {"id": 3, "category": "nan", "amount": "4"},
        {"id": None, "category": "keyless"},
        {"id": 4, "category": None},
        {"id": 5, "transaction_date": None},
        {"id": 6, "category": "invalid", "amount": "0"},
    )
    groups = {(r.category_code, r.dt): r for r in gold.by_category(silver, "b", AS_OF).collect()}
    solo = groups["SOLO", "2024-01-01"]
    assert (solo.transaction_count, solo.stddev_amount, solo.agg_key) == (1, None, "SOLO_2024-01-01")
    assert solo.batch_id == "b"
    nan = groups["NAN", "2024-01-01"]
    assert math.isnan(nan.total_amount) and math.isnan(nan.avg_amount) and math.isnan(nan.max_amount)
    assert nan.min_amount == 4
    assert groups["KEYLESS", "2024-01-01"].transaction_count == 0
    assert groups[None, "2024-01-01"].agg_key is None
    assert groups["A", None].agg_key is None
    assert ("INVALID", "2024-01-01") not in groups


def test_gold_by_hour_edges(spark):
    silver = _silver(
        spark,
        {"id": 1},
        {"id": 2, "customer_id": "c"},
        {"id": 3, "customer_id": None},
        # The day is the transaction's, the hour the event's.
        {"id": 4, "ts": datetime(2024, 1, 2, 23), "customer_id": "d"},
    )
    groups = {r.agg_key: r for r in gold.by_hour(silver, "b", AS_OF).collect()}
    assert set(groups) == {"2024-01-01_7", "2024-01-01_23"}
    seven = groups["2024-01-01_7"]
    assert (seven.hour, seven.transaction_count, seven.unique_customers) == (7, 3, 1)


def test_gold_of_text_timestamps(spark):
    silver = _silver(spark, {}).withColumn("ts", F.col("ts").cast("string"))
    assert gold.by_hour(silver, "b").first().hour == 7


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (2, None, "c"), (2, 0, "d"), (3, 5, "x"), (3, 5, "y"), (None, 1, "n")],
        "k int, o int, v string",
    )
    kept = {(r.k, r.v) for r in latest_per_key(df, ["k"], "o").collect()}
    assert kept == {(1, "b"), (2, "d"), (3, "y"), (None, "n")}


def test_latest_per_key_with_maps(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS o, map('a', v) AS m FROM VALUES (1), (2), (3) AS t(v)")
    for shuffled in (df, df.repartition(3)):
        assert [r.m for r in latest_per_key(shuffled, ["k"], "o").collect()] == [{"a": 3}]
