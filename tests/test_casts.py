"""Edge values of the lenient casts, against Spark's own non-ANSI casts."""

from __future__ import annotations

import math
from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import hour_of, lenient_date, lenient_double, lenient_int

AMOUNTS = ["12.7", "abc", " 5 ", "1e3", "", "NaN", "Infinity", None, "0", "-1", "12.7f", "1d", "+3"]
QUANTITIES = [
    "12.7",
    "-12.7",
    "abc",
    " 5 ",
    "3000000000",
    "2147483647.9999999",
    "2147483648",
    "-2147483648.5",
    "9.9999999",
    "1e3",
    ".",
    "-.",
    ".5",
    "5.",
    "-",
    "+",
    "+7",
    "007",
    "5L",
    "5.5.5",
    "1 2",
    "\t8.9\n",
    "\x018.9",
    "",
    "  ",
    "NaN",
    None,
]
DATES = [
    "2024-01-31",
    "2024-01-31 10:20:30",
    "2024-01-31T10:20",
    "2024-01-31 junk",
    "2024-1-3",
    "2024-02",
    "2024",
    "2024-13-01",
    "31/01/2024",
    "",
    None,
]


@contextmanager
def ansi(spark, enabled):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(enabled).lower())
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def _texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "n int, s string")


def _column(df, column):
    rows = df.select("n", column.alias("v")).orderBy("n").collect()
    return ["nan" if isinstance(r.v, float) and math.isnan(r.v) else r.v for r in rows]


@pytest.mark.parametrize(
    "values, ours, plain",
    [
        (AMOUNTS, lenient_double, lambda s: s.cast("double")),
        (QUANTITIES, lambda s: lenient_int(s, T.StringType()), lambda s: s.cast("int")),
        (DATES, lambda s: lenient_date(s, T.StringType()), F.to_date),
    ],
    ids=["amount", "quantity", "date"],
)
def test_text_equals_the_non_ansi_cast(spark, values, ours, plain):
    df = _texts(spark, values)
    with ansi(spark, False):
        expected = _column(df, plain(F.col("s")))
        assert _column(df, ours(F.col("s"))) == expected
    with ansi(spark, True):
        assert _column(df, ours(F.col("s"))) == expected


def test_known_values(spark):
    quantities = dict(zip(QUANTITIES, _column(_texts(spark, QUANTITIES), lenient_int(F.col("s"), T.StringType()))))
    assert quantities["12.7"] == 12 and quantities["-12.7"] == -12 and quantities["."] == 0
    assert quantities["2147483647.9999999"] == 2147483647
    assert quantities["1e3"] is quantities["5L"] is quantities["-"] is None
    dates = dict(zip(DATES, _column(_texts(spark, DATES), lenient_date(F.col("s"), T.StringType()))))
    assert dates["2024-02"] == date(2024, 2, 1) and dates["2024-13-01"] is None


def test_numbers_and_dates_as_input(spark):
    df = spark.sql("SELECT 0 AS n, 12.7D AS d, 3000000000L AS big, DATE'2024-01-31' AS day")
    assert _column(df, lenient_int(F.col("d"), T.DoubleType())) == [12]
    assert _column(df, lenient_int(F.col("big"), T.LongType())) == [None]
    assert _column(df, lenient_date(F.col("day"), T.DateType())) == [date(2024, 1, 31)]


def test_hour(spark):
    df = _texts(spark, ["2024-01-01 07:30:00", "soon", None])
    assert _column(df, hour_of(F.col("s"), T.StringType())) == [7, None, None]
    wall = df.select("n", F.col("s").try_cast("timestamp_ntz").alias("t"))
    assert _column(wall, hour_of(F.col("t"), T.TimestampNTZType())) == [7, None, None]
