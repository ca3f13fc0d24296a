"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   tables to read      (default /root/testdata/sf0.1)
BENCH_CPUS     local cores         (default 8)
BENCH_RUNS     runs, best counts   (default 2)
BENCH_SHAPE_RUNS  runs of each shape of a batch, the median counts  (default 3)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from statistics import median

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.checks.bronze import bronze_rows, workspace
from tidemark.checks.catalogue import AS_OF, QUERIES, commit_windows
from tidemark.functions.marks import from_micros
from tidemark.operators import gold
from tidemark.operators.silver import to_silver
from tidemark.plans.batch import BatchWindow
from tidemark.plans.layers import REFRESH, SLICE, TOTALS, run_batch
from tidemark.sources.writers import bulk_insert, upsert
from tidemark.spec import SILVER_SPEC, Lake

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
SHAPE_RUNS = int(os.environ.get("BENCH_SHAPE_RUNS", "3"))
MEMORY = "8g"

HEADLINES = (
    "silver_full",
    "gold_by_category",
    "gold_by_hour",
    "precombine_events",
    "precombine_lineitem",
    "bulk_insert",
    "incremental_read",
    "upsert_two_batches",
    "batches_end_to_end",
    "gold_last_batch_wins",
    "gold_refresh",
    "gold_totals",
    "stream_available_now",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", MEMORY)
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-bench-"))
        # The tables are small here: keep every core busy with smaller tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def best(action: Callable[[], object], runs: int = RUNS) -> float:
    seconds = []
    for _ in range(runs):
        started = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - started)
    return round(min(seconds), 3)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def loaded_lake(spark: SparkSession, bronze: DataFrame) -> Lake:
    lake = Lake(workspace(spark))
    bulk_insert(bronze, lake.path(lake.bronze_table), lake.spec(lake.bronze_table))
    return lake


def plain_merge(rows: DataFrame, path: str, fields: list[str], keys: list[str], order: str) -> None:
    """An upsert as it is usually written: the touched partitions, read, united with the
    batch, ranked per key and overwritten."""
    spark = rows.sparkSession
    if os.path.exists(path):
        touched = F.broadcast(rows.select(*[F.col(f).alias(f"_{f}") for f in fields]).distinct())
        stored = spark.read.schema(rows.schema).parquet(path)
        here = [F.col(f).eqNullSafe(F.col(f"_{f}")) for f in fields]
        rows = rows.unionByName(stored.join(touched, here, "left_semi"))
    latest = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last())
    rows = rows.withColumn("_place", F.row_number().over(latest)).where("_place = 1").drop("_place")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*fields).parquet(path)


def nine_actions(spark: SparkSession, lake: Lake, window) -> None:
    """One batch the way it is usually written, in nine actions and plain Spark: nothing
    cached, a count before each write."""
    as_of = from_micros(window.end_us)
    begin, end = F.lit(window.begin_us), F.lit(window.end_us)
    mark = F.col("_commit_us")
    bronze = spark.read.option("mergeSchema", True).parquet(lake.path(lake.bronze_table))
    bronze = bronze.withColumn("dt", F.col("dt").cast("string")).where((mark > begin) & (mark <= end))
    bronze.count()
    silver = to_silver(bronze, as_of).withColumn("_commit_us", end)
    silver.count()
    silver_path = lake.path(lake.silver_table)
    plain_merge(silver, silver_path, ["dt", "category_code"], ["id", "dt", "category_code"], "ts")
    silver.count()
    slice_ = spark.read.schema(silver.schema).parquet(silver_path).where(mark == end)
    slice_.count()
    for name, groups in gold.aggregations(slice_, window.batch_id, as_of).items():
        groups.count()
        path = lake.path(lake.gold_table(name))
        plain_merge(groups.where("agg_key IS NOT NULL"), path, ["dt"], ["agg_key"], "processed_at")


def compare(spark: SparkSession) -> dict[str, float]:
    """The batch in its three gold modes against its nine-action form, and upserts by how
    many partitions they touch; medians of runs on tables of their own."""
    bronze = bronze_rows(spark, SF_DIR)
    windows = commit_windows(bronze)

    def batch(mode: str) -> Callable[[Lake, BatchWindow], object]:
        return lambda lake, w: run_batch(spark, lake, w, as_of=from_micros(w.end_us), gold_mode=mode)

    shapes = {
        "nine_actions": lambda lake, w: nine_actions(spark, lake, w),
        "batch_slice": batch(SLICE),
        "batch_refresh": batch(REFRESH),
        "batch_totals": batch(TOTALS),
    }
    result = {}
    for name, step in shapes.items():
        seconds = []
        for _ in range(SHAPE_RUNS):
            lake = loaded_lake(spark, bronze)
            each = [best(lambda w=w: step(lake, w), runs=1) for w in windows]
            seconds += each[1:]
        result[f"{name}_per_batch"] = round(median(seconds), 3)
    silver = to_silver(bronze, AS_OF)
    for days in (1, 5, 25):
        path = workspace(spark)
        upsert(silver, path, SILVER_SPEC, 1)
        batch_rows = silver.where(f"dt <= '2024-01-{days:02}'")
        result[f"upsert_{days}_days"] = best(lambda: upsert(batch_rows, path, SILVER_SPEC, 2), runs=1)
    return result


def main() -> None:
    spark = session()
    for name in ("gold_by_category", "upsert_two_batches"):  # start the JVM's engines
        consume(QUERIES[name](spark, SF_DIR))
    queries = {name: best(lambda n=name: consume(QUERIES[n](spark, SF_DIR))) for name in HEADLINES}
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "driver_memory": MEMORY,
        "comparison": compare(spark),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    main()
