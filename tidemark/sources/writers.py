"""Upsert, insert and bulk insert into partitioned Parquet tables.

One writer per table at a time. A commit replaces or adds whole partition
directories, one after another; it is no transaction. A driver lost while it swaps them
can leave a partition without the rows it held before, which running the batch again
does not bring back: ``plans.layers.rebuild_days`` does, from bronze.

What a write wrote is observed on the way, after the last shuffle: Spark counts a task of
the job's last stage once, however often it runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.functions.marks import to_micros
from tidemark.operators.latest import latest_and_times
from tidemark.operators.merge import (
    COMMIT_TIME,
    EVENT_TIME,
    merge_batch,
    stored_versions,
    without,
)
from tidemark.sources.clustering import clustered
from tidemark.sources.partitions import (
    MAX_LITERAL_PARTITIONS,
    NULL_DIRECTORY,
    Partitions,
    PartitionSpan,
    blank_to_null,
    in_partitions_of,
    partitions_of,
)
from tidemark.sources.readers import MARK_AHEAD_US, check_types, read_table, table_exists
from tidemark.spec import COMMIT_COL, TableSpec

# How many versions of a row's key the batch held.
_TIMES = "_times"

# What to do with the stored rows about to be replaced, None if there are none, and the
# partitions the batch touches, None if they are not known. Of the rows the keys, the ordering
# field and the columns asked for are given.
BeforeWrite = Callable[[DataFrame | None, "Partitions | PartitionSpan | None"], None]


class NullKeyError(ValueError):
    """A batch holds rows without a record key."""


@dataclass(frozen=True)
class UpsertReport:
    """Rows sent: ``rows`` with a record key and ``rejected`` without one; the partitions
    they touch, their span if there are too many to list, or None if nobody asked; and how
    many rows of the partitions written bear the batch's commit mark."""

    rows: int
    rejected: int
    partitions: Partitions | PartitionSpan | None
    written: int


def stamped(df: DataFrame, commit_us: int | None) -> DataFrame:
    """Mark every row with its commit; without one the rows bring their own mark. Reads of
    a range rely on marks that are not ahead of the clock, so those are refused."""
    latest = to_micros(datetime.now(timezone.utc)) + MARK_AHEAD_US
    if commit_us is None:
        if COMMIT_COL not in df.columns:
            raise ValueError(f"rows have no {COMMIT_COL}; pass commit_us")
        ahead = F.raise_error(F.concat(F.lit("commit mark ahead of the clock: "), F.col(COMMIT_COL))).cast("long")
        return df.withColumn(COMMIT_COL, F.when(F.col(COMMIT_COL) > latest, ahead).otherwise(F.col(COMMIT_COL)))
    if commit_us > latest:
        raise ValueError(f"commit mark {commit_us} is ahead of the clock")
    return df.withColumn(COMMIT_COL, F.lit(commit_us).cast("long"))


def _laid_out(df: DataFrame, spec: TableSpec, *within: str, counts: _Counts | None = None) -> DataFrame:
    """One shuffle that gathers each partition's rows into files of even size.

    Adaptive execution splits a partition that holds too many rows over several
    tasks and packs small ones together, so neither a hot partition nor thousands
    of tiny files come of it. ``counts`` observes the rows and drops those without a key.
    """
    fields = spec.partition_fields
    gathered = df.hint("rebalance", *[F.col(f) for f in fields])
    if counts is not None:
        gathered = counts.of(gathered)
    return gathered.sortWithinPartitions(*fields, *within)


class _Counts:
    """Counts of the rows that a write lays out, known when it is done."""

    def __init__(self, spec: TableSpec, commit_us: int | None) -> None:
        self._seen = Observation()
        self._keyed = F.col(spec.record_key).isNotNull()
        self._ours = F.lit(True) if commit_us is None else F.col(COMMIT_COL) == commit_us

    def of(self, rows: DataFrame) -> DataFrame:
        metrics: dict[str, Column] = {"written": F.count_if(self._keyed & self._ours)}
        if _TIMES in rows.columns:  # NULL in rows that were stored before
            metrics["rows"] = F.sum(F.when(self._keyed, F.col(_TIMES)))
            metrics["rejected"] = F.sum(F.when(~self._keyed, F.col(_TIMES)))
        observed = rows.observe(self._seen, *[column.alias(name) for name, column in metrics.items()])
        return observed.where(self._keyed).drop(_TIMES)

    def __getitem__(self, name: str) -> int:
        return self._seen.get.get(name) or 0


def _save(df: DataFrame, path: str, spec: TableSpec, mode: str) -> None:
    (
        # The option, not the session's setting: a static overwrite would delete
        # the table while it is being read.
        df.write.option("partitionOverwriteMode", "dynamic")
        .mode(mode)
        .partitionBy(*spec.partition_fields)
        .parquet(path)
    )


def insert(df: DataFrame, path: str, spec: TableSpec, commit_us: int | None = None) -> None:
    """Append without looking for keys; duplicates are allowed."""
    rows = blank_to_null(stamped(df, commit_us), spec.partition_fields)
    _check(rows, path, spec)
    _save(_laid_out(rows, spec, COMMIT_COL), path, spec, "append")


def bulk_insert(
    df: DataFrame, path: str, spec: TableSpec, commit_us: int | None = None, *, cluster_by: Sequence[str] = ()
) -> None:
    """Append for a first load: as :func:`insert`, files sorted by record key, or clustered
    by several columns, so that a filter on any of them skips row groups."""
    rows = blank_to_null(stamped(df, commit_us), spec.partition_fields)
    _check(rows, path, spec)
    if cluster_by:
        laid_out = clustered(rows, spec.partition_fields, cluster_by)
    else:
        laid_out = _laid_out(rows, spec, spec.record_key)
    _save(laid_out, path, spec, "append")


def _check(rows: DataFrame, path: str, spec: TableSpec) -> None:
    """Refuses other types than those of the partitions that ``rows`` touch."""
    if spec.schema is not None:
        check_types(rows.sparkSession, path, spec, rows.schema)
    elif table_exists(rows.sparkSession, path, spec):
        touched = partitions_of(rows, spec.partition_fields)
        check_types(rows.sparkSession, path, spec, rows.schema, touched)


def _touched_rows(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    incoming: DataFrame,
    touched: Partitions | PartitionSpan,
) -> DataFrame | None:
    existing = read_table(spark, path, spec, touched, also=incoming.schema)
    if existing is None or isinstance(touched, Partitions):
        return existing
    return in_partitions_of(existing, incoming, spec.partition_fields)


def _survey(rows: DataFrame, spec: TableSpec, on_null_key: str, limit: int) -> tuple[UpsertReport, tuple | None]:
    """What a batch of counted versions holds, and its least and greatest record key."""
    fields, keyed = spec.partition_fields, F.col(spec.record_key).isNotNull()
    totals = [
        F.coalesce(F.sum(F.when(keyed, F.col(_TIMES))), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~keyed, F.col(_TIMES))), F.lit(0)).alias("keyless"),
        F.min(spec.record_key).alias("first_key"),
        F.max(spec.record_key).alias("last_key"),
    ]
    found = rows.groupBy(*fields).agg(*totals).limit(limit + 1).collect()
    listed = len(found) <= limit
    first = F.when(keyed, F.col(fields[0]))
    bounds = [
        F.min(first).alias("least"),
        F.max(first).alias("most"),
        F.bool_or(keyed & F.col(fields[0]).isNull()).alias("nulls"),
    ]
    sums = found if listed else rows.agg(*totals, *bounds).collect()
    rejected = sum(row["keyless"] for row in sums)
    if rejected and on_null_key == "raise":
        raise NullKeyError(f"{rejected} rows have no {spec.record_key}")
    values = tuple(tuple(row)[: len(fields)] for row in found if row["rows"])
    ends = [(row["first_key"], row["last_key"]) for row in sums if row["rows"]]
    report = UpsertReport(
        rows=sum(row["rows"] for row in sums),
        rejected=rejected,
        partitions=Partitions(fields, values)
        if listed
        else PartitionSpan(fields[0], sums[0]["least"], sums[0]["most"], bool(sums[0]["nulls"])),
        written=0,
    )
    return report, (min(e[0] for e in ends), max(e[1] for e in ends)) if ends else None


def _versions(df: DataFrame, spec: TableSpec, unique: bool) -> DataFrame:
    """One row per key, those without a record key included, with ``_TIMES``."""
    if unique:
        return df.withColumn(_TIMES, F.lit(1).cast("long"))
    return latest_and_times(df, spec.keys, spec.ordering_field, _TIMES)


def _key_range(existing: DataFrame, bounds: tuple | None, spec: TableSpec) -> DataFrame:
    """The stored rows whose record key lies between the batch's least and greatest: files
    and row groups of other keys are skipped by their statistics."""
    return existing if bounds is None else existing.where(F.col(spec.record_key).between(*map(F.lit, bounds)))


def upsert(
    df: DataFrame,
    path: str,
    spec: TableSpec,
    commit_us: int | None = None,
    *,
    merge_order: str = EVENT_TIME,
    on_null_key: str = "raise",
    unique: bool = False,
    max_literal_partitions: int = MAX_LITERAL_PARTITIONS,
    touched: Partitions | PartitionSpan | None = None,
    before_write: BeforeWrite | None = None,
    replaced_columns: Sequence[str] = (),
) -> UpsertReport:
    """Insert new keys and replace stored ones in the partitions the batch touches.

    ``unique`` says the batch has one row per key already. Rows without a record key raise,
    or with ``on_null_key="reject"`` are left out and counted. ``commit_us`` must be later
    than every earlier commit that is still to be read incrementally; writing a
    batch again with its own mark changes nothing.

    A batch that is merged is read once, deduplicated and cached. One that is rejecting and
    need not be compared with stored rows, as it opens the table or always wins in
    ``touched`` partitions, is read and written in one job. Such a batch must read the same
    each time if ``touched`` is given: it is merged with the rows it leaves in place.

    ``before_write`` gets ``replaced_columns`` of the stored rows too.
    """
    if on_null_key not in ("raise", "reject"):
        raise ValueError(f"unknown on_null_key {on_null_key!r}")
    if merge_order not in (EVENT_TIME, COMMIT_TIME):
        raise ValueError(f"unknown merge order {merge_order!r}")
    spark = df.sparkSession
    sent = blank_to_null(stamped(df, commit_us), spec.partition_fields)
    rows = _versions(sent, spec, unique)
    if on_null_key == "reject":
        if touched is not None and merge_order == COMMIT_TIME and before_write is None:
            existing = _touched_rows(spark, path, spec, rows.drop(_TIMES), touched)
            merged = rows if existing is None else merge_batch(existing, rows, spec, merge_order)
            return _written(merged, path, spec, commit_us, touched)
        opens = not table_exists(spark, path, spec) and not sent.where(F.col(spec.record_key).isNotNull()).isEmpty()
        if opens:
            if before_write is not None:
                before_write(None, None)
            return _written(rows, path, spec, commit_us, None)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        report, bounds = _survey(rows, spec, on_null_key, max_literal_partitions)  # fills the cache
        if not report.rows:
            return report
        keyed = rows.where(F.col(spec.record_key).isNotNull()).drop(_TIMES)
        return _merged(keyed, path, spec, commit_us, merge_order, report, bounds, before_write, replaced_columns)
    finally:
        rows.unpersist()


def _written(
    rows: DataFrame, path: str, spec: TableSpec, commit_us: int | None, touched: Partitions | PartitionSpan | None
) -> UpsertReport:
    """Writes counted versions over the partitions they touch."""
    counts = _Counts(spec, commit_us)
    _save(_laid_out(rows, spec, COMMIT_COL, counts=counts), path, spec, "overwrite")
    return UpsertReport(counts["rows"], counts["rejected"], touched, counts["written"])


def _merged(
    rows: DataFrame,
    path: str,
    spec: TableSpec,
    commit_us: int | None,
    merge_order: str,
    report: UpsertReport,
    bounds: tuple | None,
    before_write: BeforeWrite | None,
    replaced_columns: Sequence[str],
) -> UpsertReport:
    """Merges unique, cached rows. Those of partitions that store no key of the batch are
    appended, and the files there stay as they are: run again, they are found stored.

    The batch is joined with the stored rows once. What comes of that, the stored rows of
    its keys, is cached: all else is decided from it, and the batch is compared a second time
    only if stored rows outrank some of it."""
    touched, counts = report.partitions, []

    def save(laid: DataFrame, mode: str) -> None:
        counts.append(_Counts(spec, commit_us))
        _save(_laid_out(laid, spec, COMMIT_COL, spec.record_key, counts=counts[-1]), path, spec, mode)

    def done() -> UpsertReport:
        return replace(report, written=sum(c["written"] for c in counts))

    existing = _touched_rows(rows.sparkSession, path, spec, rows, touched)
    if existing is None:
        if before_write is not None:
            before_write(None, touched)
        save(rows, "overwrite")
        return done()
    versions = stored_versions(_key_range(existing, bounds, spec), rows, spec, replaced_columns)
    versions = versions.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fresh, merging, replaced = None, rows, versions
        if isinstance(touched, Partitions):
            found = versions.groupBy(*touched.fields).agg(F.count_if("_outranks").alias("outranking")).collect()
            matched = Partitions(touched.fields, tuple(tuple(row)[:-1] for row in found))
            outranked = any(row["outranking"] for row in found)
            if len(matched.values) < len(touched.values):
                to_merge = F.coalesce(matched.predicate(), F.lit(False))  # NULL fields match no literal
                fresh = rows.where(~to_merge)
                merging = rows.where(to_merge) if matched.values else None
                existing = existing.where(matched.predicate())
        else:
            outranked = versions.agg(F.bool_or("_outranks")).first()[0]
        if merge_order == EVENT_TIME and outranked and merging is not None:
            outranking = versions.where("_outranks")
            merging, replaced = without(merging, outranking, spec), without(versions, outranking, spec)
        replaced = replaced.drop("_outranks")
        if before_write is not None:
            before_write(None if merging is None else replaced, touched)
        if fresh is not None:
            save(fresh, "append")
        if merging is not None:
            save(merge_batch(existing, merging, spec, COMMIT_TIME, replaced), "overwrite")
        return done()
    finally:
        versions.unpersist()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes what is at ``path``, if anything."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear_partitions(partitions: DataFrame, path: str, spec: TableSpec) -> None:
    """Removes each of ``partitions``, one row of partition values a partition, by deleting
    its directory. For values that a directory name holds as they are, such as days."""
    for values in partitions.select(*spec.partition_fields).toLocalIterator():
        names = [f"{f}={NULL_DIRECTORY if v is None else v}" for f, v in values.asDict().items()]
        remove(partitions.sparkSession, "/".join([path, *names]))


def replace_partitions(
    df: DataFrame,
    path: str,
    spec: TableSpec,
    commit_us: int | None = None,
    *,
    on_null_key: str = "raise",
    unique: bool = False,
) -> UpsertReport:
    """Make the batch the whole content of every partition it touches."""
    sent = blank_to_null(stamped(df, commit_us), spec.partition_fields)
    _check(sent, path, spec)
    rows = _versions(sent, spec, unique)
    if on_null_key == "reject":
        return _written(rows, path, spec, commit_us, None)
    report, _ = _survey(rows, spec, on_null_key, MAX_LITERAL_PARTITIONS)
    return replace(_written(rows, path, spec, commit_us, None), partitions=report.partitions) if report.rows else report
