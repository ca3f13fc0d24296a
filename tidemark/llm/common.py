"""Helpers the operators share."""

from __future__ import annotations

import math
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a Java character class.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a local session without one gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_folder()
    return shared.rstrip("/")


_local: list[str] = []


def _local_folder() -> str:
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="tidemark-llm-"))
    return _local[0]


def ready(df: DataFrame) -> DataFrame:
    """``df``, once the executors' Python workers can import this package: the session
    sends them a copy, so it need not be installed on them."""
    context = df.sparkSession.sparkContext
    if not any("tidemark_tasks" in str(f) for f in context._python_includes):
        package = Path(__file__).resolve().parent.parent
        copy = Path(tempfile.mkdtemp(prefix="tidemark-ship-")) / "tidemark_tasks.zip"
        with zipfile.ZipFile(copy, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(str(copy))
    return df


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there: its lineage ends, it
    survives the loss of executors, and its true size is known to the plans that follow.
    (Checkpoints also carry the constraints of the plan they replace, which grow without
    bound in loops.)"""
    return shared_parquet(df, "kept")


def buckets_for(df: DataFrame, bytes_each: int) -> int:
    """How many buckets to deal ``df`` into for about ``bytes_each`` of its input in
    each, by the optimizer's size estimate; no fewer than the shuffle partitions."""
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:  # no estimate
        return least
    return max(least, math.ceil(size / bytes_each))


def broadcast_if_small(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Marks ``df`` for broadcast when its counted ``rows`` are no more than ``most``."""
    return F.broadcast(df) if rows <= most else df


#: A key of more than this share of the rows is hot: fewer than a thousand can be.
HOT_KEY = 1 / 1000


def join_one_each(rows: DataFrame, one: DataFrame, key: str, most: int = 100_000) -> DataFrame:
    """``rows`` with what ``one``, which has a row per ``key``, holds for theirs (NULL if
    nothing). ``one`` is broadcast if it has no more than ``most`` rows. Else its rows for
    hot keys are, and only rows of other keys are shuffled by key."""
    if one.count() <= most:
        return rows.join(F.broadcast(one), key, "left")
    rows = kept(rows)
    counts = rows.groupBy(key).agg(F.count("*").alias("_rows"))
    hot = kept(counts.where(F.col("_rows") > max(1, int(rows.count() * HOT_KEY))).select(key))
    ours = kept(one.join(F.broadcast(hot), key, "left_semi"))
    often = rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(ours), key, "left")
    rest = rows.join(F.broadcast(hot), key, "left_anti").join(one, key, "left")
    return often.unionByName(rest)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text``; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shared_parquet(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new place in the shared folder, and read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
