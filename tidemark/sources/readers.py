"""Snapshot and incremental reads of partitioned Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.marks import from_micros
from tidemark.sources.partitions import Partitions, PartitionSpan
from tidemark.spec import COMMIT_COL, TableSpec


# How far a commit mark may be ahead of the writer's clock, and how much older than a range a
# file is left out: what lies between allows for the clocks of writers and of the store.
MARK_AHEAD_US = 30 * 60 * 1_000_000
AGE_MARGIN_US = 60 * 60 * 1_000_000


class ColumnTypeError(ValueError):
    """A batch gives a stored column another type."""


def _reader(spark: SparkSession, path: str, after_us: int | None = None) -> DataFrameReader:
    """A reader of the files last modified after ``after_us``, if given."""
    reader = spark.read.option("basePath", path)
    if after_us is None or after_us <= 0:
        return reader
    moment = f"{from_micros(after_us):%Y-%m-%dT%H:%M:%S}"
    return reader.option("modifiedAfter", moment).option("timeZone", "UTC")


def _stored_schema(
    spark: SparkSession, path: str, location: str, spec: TableSpec, after_us: int | None = None, all_files: bool = True
) -> T.StructType | None:
    """Stored columns of all files at ``location``, as later files can have more, or of one of
    them. Partition values read as text, not as whatever type they look like."""
    reader = _reader(spark, path, after_us).option("mergeSchema", all_files)
    try:
        found = reader.parquet(location).schema
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # directories without data files
            return None
        raise
    return T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in spec.partition_fields else f for f in found]
    )


def _widened(stored: T.StructType, also: T.StructType, spec: TableSpec) -> T.StructType:
    wanted = {f.name: f for f in also.fields}
    fields = [wanted[f.name] if f.name in spec.partition_fields else f for f in stored.fields]
    for f in fields:
        # Rows of both types in one table could not be read back together.
        if f.name in wanted and f.dataType.simpleString() != wanted[f.name].dataType.simpleString():
            raise ColumnTypeError(
                f"{f.name} is stored as {f.dataType.simpleString()}, "
                f"not {wanted[f.name].dataType.simpleString()}"
            )
    return T.StructType(fields + [f for f in also.fields if f.name not in stored.names])


def read_table(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    partitions: Partitions | PartitionSpan | None = None,
    also: T.StructType | None = None,
    after_us: int | None = None,
) -> DataFrame | None:
    """Rows of the table, or of some of its partitions; None if it holds none of them.

    With ``after_us`` files last modified before that are left out, unopened.

    Every file's columns are read; a declared ``spec.schema`` saves opening the files to
    learn them. ``also`` is for reading rows to write them back: its columns are added,
    and partition fields take their types from it. A column they share must have one type.
    """
    location = partitions.directories(path) if partitions else path
    try:
        schema = spec.schema or _stored_schema(spark, path, location, spec, after_us)
        if schema is None:
            return None
        if also is not None:
            schema = _widened(schema, also, spec)
        df = _reader(spark, path, after_us).schema(schema).parquet(location)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return df.where(partitions.predicate()) if partitions else df


def check_types(
    spark: SparkSession, path: str, spec: TableSpec, batch: T.StructType, partitions: Partitions | None = None
) -> None:
    """Raises if ``batch`` gives a stored column another type: one of the declared schema, or
    without one, of the files in ``partitions`` (all files if None) and of one other file."""
    found = [spec.schema] if spec.schema is not None else []
    if not found:
        places = [(partitions.directories(path) if partitions else path, True), (path, False)]
        for place, all_files in places:
            try:
                found.append(_stored_schema(spark, path, place, spec, all_files=all_files))
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
    for stored in found:
        if stored is not None:
            _widened(stored, batch, spec)


def table_exists(spark: SparkSession, path: str, spec: TableSpec) -> bool:
    """False only if nothing is stored at ``path``; any other failure is raised."""
    schema = spec.schema or T.StructType([T.StructField(COMMIT_COL, T.LongType())])
    try:
        spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def snapshot(
    spark: SparkSession, path: str, spec: TableSpec, partitions: Partitions | PartitionSpan | None = None
) -> DataFrame:
    """Current rows of the table."""
    df = read_table(spark, path, spec, partitions)
    if df is None and partitions is None:
        raise FileNotFoundError(f"no table at {path}")
    if df is None:
        return snapshot(spark, path, spec).where(partitions.predicate())
    return df


def incremental(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    begin_us: int,
    end_us: int,
    partitions: Partitions | PartitionSpan | None = None,
) -> DataFrame:
    """Current rows whose last commit lies in ``(begin, end]``.

    Adjoining ranges cover every commit once. Files written before the range begins, by
    more than ``AGE_MARGIN_US``, are not opened: writers refuse marks ahead of their clock.
    In the others the range reaches the Parquet scan, where row groups of other commits
    are skipped.
    """
    df = read_table(spark, path, spec, partitions, after_us=begin_us - AGE_MARGIN_US)
    if df is None:  # nothing that new: the columns are those of all files
        df = snapshot(spark, path, spec, partitions)
    return df.where((F.col(COMMIT_COL) > F.lit(begin_us)) & (F.col(COMMIT_COL) <= F.lit(end_us)))
