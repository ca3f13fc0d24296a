"""Bronze rows derived from the ``events`` table.

Every event becomes a bronze row. As the events themselves are clean, some get a
missing, malformed, negative or zero field, every tenth a later correction, and
every fiftieth arrives two days late. Bronze rows are committed at the end of the
five-minute slot they arrive in.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.marks import wall_to_micros
from tidemark.spec import COMMIT_COL


def workspace(spark: SparkSession) -> str:
    """A fresh folder for the tables of one run, under the cluster's shared
    folder. Only a local session may fall back to a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _slot_end(arrival: Column) -> Column:
    """End of the five-minute slot ``arrival`` falls in."""
    into_slot = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(arrival) % 5, F.date_part(F.lit("SECOND"), arrival)
    )
    return arrival - into_slot + F.expr("INTERVAL '5' MINUTE")


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    event_id = F.col("event_id")

    def every(n: int) -> Column:
        return event_id % n == 0

    versions = F.when(every(10), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    events = (
        table(spark, sf_dir, "events")
        .select("event_id", "ts", "user_id", "event_type", "value", F.explode(versions).alias("ver"))
        .withColumns(
            {
                "ts": F.when(F.col("ver") == 1, F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(
                    F.col("ts")
                ),
                "value": F.when(F.col("ver") == 1, F.col("value") * 2).otherwise(F.col("value")),
            }
        )
    )
    ts, day = F.col("ts"), F.col("ts").cast("date").cast("string")
    value, units = F.col("value").cast("string"), (event_id % 9).cast("string")
    arrival = F.when(every(50), ts + F.expr("INTERVAL 2 DAY")).otherwise(ts)
    return events.select(
        event_id.alias("id"),
        "ver",
        "ts",
        F.when(every(19), None)
        .when(every(2), F.col("event_type"))
        .otherwise(F.upper("event_type"))
        .alias("category"),
        F.when(~every(7), F.col("user_id")).alias("customer_id"),
        F.when(every(17), None)
        .when(every(13), "n/a")
        .when(every(11), F.concat(F.lit("-"), value))
        .when(every(29), "0")
        .otherwise(value)
        .alias("amount"),
        F.when(every(31), "many")
        .when(every(5), F.concat(units, F.lit(".7")))
        .otherwise(units)
        .alias("quantity"),
        F.when(~every(3), (event_id % 20).cast("double") / 100).alias("discount_pct"),
        F.when(every(23), "not-a-date").otherwise(day).alias("transaction_date"),
        day.alias("dt"),
        wall_to_micros(_slot_end(arrival)).alias(COMMIT_COL),
    )


# The same rows for DuckDB.
BRONZE_SQL = f"""
v AS (
  SELECT event_id, 0 AS ver, ts, user_id, event_type, value FROM events
  UNION ALL
  SELECT event_id, 1 AS ver, ts + INTERVAL 1 HOUR AS ts, user_id, event_type, value * 2 AS value
  FROM events WHERE event_id % 10 = 0
),
bronze AS (
  SELECT event_id AS id, ver, ts,
    CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 2 = 0 THEN event_type
         ELSE upper(event_type) END AS category,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS customer_id,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'n/a'
         WHEN event_id % 11 = 0 THEN concat('-', cast(value AS varchar))
         WHEN event_id % 29 = 0 THEN '0' ELSE cast(value AS varchar) END AS amount,
    CASE WHEN event_id % 31 = 0 THEN 'many'
         WHEN event_id % 5 = 0 THEN concat(cast(event_id % 9 AS varchar), '.7')
         ELSE cast(event_id % 9 AS varchar) END AS quantity,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(event_id % 20 AS double) / 100 END AS discount_pct,
    CASE WHEN event_id % 23 = 0 THEN 'not-a-date'
         ELSE cast(cast(ts AS date) AS varchar) END AS transaction_date,
    cast(cast(ts AS date) AS varchar) AS dt,
    epoch_us(date_trunc('hour', arr)
      + cast(floor(minute(arr) / 5) + 1 AS int) * INTERVAL '5' MINUTE) AS {COMMIT_COL}
  FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN ts + INTERVAL 2 DAY ELSE ts END AS arr FROM v) w
)"""
