"""Running totals: gold of whole days from the rows a batch changes.

The states of gold's groups are kept in tables, a partition per day. A batch adds the state
of the rows it wrote and takes back that of the rows it replaced. Silver is read again only
for groups that lost their least or greatest amount, hours that lost a customer's row, and
days whose states are not current.

A day's states are current unless a mark says otherwise. Before silver changes, the days
about to change are marked with the batch's commit; once their states are written, with
that commit too, the marks go. So whatever ends a batch in between, and whatever other
gold mode ran meanwhile, the day is found marked later than its states and computed anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import gold
from tidemark.operators.states import STATE, WHOLE_NUMBERS, bitmaps, combined, distinct_numbers, merged_bitmaps, moments
from tidemark.sources.partitions import Partitions, PartitionSpan, partitions_of
from tidemark.sources.readers import read_table, table_exists
from tidemark.sources.writers import clear_partitions, insert, remove, replace_partitions
from tidemark.spec import COMMIT_COL, STATE_SPECS, Lake

TOTALS = "totals"
_CATEGORY, _HOUR, _CUSTOMERS, _STALE = "state_by_category", "state_by_hour", "state_customers", "state_stale"
_DAY = ("dt",)

# What the states of replaced rows are made of.
REPLACED_COLUMNS = ("id", "ts", "dt", "category_code", "amount", "is_valid")

# The groups that every gold group is made up of.
_FINEST = tuple(dict.fromkeys(key for keys in gold.GROUP_KEYS.values() for key in keys))


def _days(values: list[str | None]) -> Partitions:
    return Partitions(_DAY, tuple((v,) for v in values))


def _listed_days(touched: Partitions | PartitionSpan | None) -> list[str] | None:
    """The days among touched partitions, None if they are not listed."""
    if not isinstance(touched, Partitions) or _DAY[0] not in touched.fields:
        return None
    place = touched.fields.index(_DAY[0])
    return sorted({value[place] for value in touched.values if value[place] is not None})


class Totals:
    """The states of a lake, for the batch committed as ``commit_us``."""

    def __init__(self, spark: SparkSession, lake: Lake, commit_us: int) -> None:
        self.spark, self.lake, self.commit_us = spark, lake, commit_us
        self.current: set[str] = set()
        self.taken: str | None = None

    def kept(self) -> bool:
        """Whether the lake has states at all."""
        return table_exists(self.spark, self.lake.path(_CATEGORY), STATE_SPECS[_CATEGORY])

    def read(self, name: str, days: Partitions | None) -> DataFrame:
        found = read_table(self.spark, self.lake.path(name), STATE_SPECS[name], days)
        return self.spark.createDataFrame([], STATE_SPECS[name].schema) if found is None else found

    def mark(self, _replaced: DataFrame | None, touched: Partitions | PartitionSpan | None) -> None:
        """Marks the days a batch of another gold mode changes; all if they are not listed."""
        days = _listed_days(touched)
        if days != []:
            rows = self.spark.createDataFrame([(d,) for d in ([None] if days is None else days)], "dt string")
            insert(rows.coalesce(1), self.lake.path(_STALE), STATE_SPECS[_STALE], self.commit_us)

    def before_write(self, replaced: DataFrame | None, touched: Partitions | PartitionSpan | None) -> None:
        """Finds the days whose states are current, marks them, and sets aside the states of
        the rows about to be replaced in them."""
        days = _listed_days(touched)
        if days:
            latest = F.max(COMMIT_COL).alias("latest")
            marks = {r.dt: r.latest for r in self.read(_STALE, _days([*days, None])).groupBy("dt").agg(latest).collect()}
            states = self.read(_CATEGORY, _days(days)).groupBy("dt").agg(latest).collect()
            everything = marks.get(None, -1)
            self.current = {r.dt for r in states if r.latest >= max(everything, marks.get(r.dt, -1))}
        self.mark(replaced, touched)
        if replaced is None or not self.current:
            return
        self.taken = f"{self.lake.path('state_taken')}/{uuid.uuid4().hex}"
        rows = gold.with_hour(gold.valid_rows(replaced.where(F.col("dt").isin(sorted(self.current)))))
        moments(rows, _FINEST).write.parquet(self.taken)

    def update(
        self, silver_slice: DataFrame, days: Partitions, silver: Callable[[Partitions], DataFrame]
    ) -> dict[str, DataFrame]:
        """Brings the states of ``days`` up to date with the rows written in them, and returns
        these states. ``silver`` reads partitions of the table as it is now."""
        spark, path = self.spark, self.lake.path(_STALE)
        changes = _Changes(self, silver_slice, days, silver)
        categories = changes.states("by_category")
        self._write(_HOUR, changes.hours(), days)
        self._write(_CATEGORY, categories, days)  # the last, as it tells what is current
        changes.close()
        if table_exists(spark, path, STATE_SPECS[_STALE]):
            clear_partitions(spark.createDataFrame(list(days.values), "dt string"), path, STATE_SPECS[_STALE])
        if self.taken is not None:
            remove(spark, self.taken)
        return {"by_category": self.read(_CATEGORY, days), "by_hour": self.read(_HOUR, days)}

    def _write(self, name: str, states: DataFrame, days: Partitions) -> None:
        """Makes ``states`` the whole content of ``days``."""
        path, spec = self.lake.path(name), STATE_SPECS[name]
        replace_partitions(states, path, spec, self.commit_us, on_null_key="reject", unique=True)
        ours = self.read(name, days).where(F.col(COMMIT_COL) == self.commit_us)
        filled = {r.dt for r in ours.select("dt").distinct().collect()}
        emptied = [(day,) for (day,) in days.values if day not in filled]
        if emptied:
            clear_partitions(self.spark.createDataFrame(emptied, "dt string"), path, spec)


def _same(keys: tuple[str, ...]) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]


def _renamed(groups: DataFrame, keys: tuple[str, ...], *others: str) -> DataFrame:
    return groups.select(*[F.col(k).alias(f"_{k}") for k in keys], *others)


class _Changes:
    """What a batch changed in ``days``: rows added to days whose states are current, and
    all rows of the others."""

    def __init__(
        self, totals: Totals, silver_slice: DataFrame, days: Partitions, silver: Callable[[Partitions], DataFrame]
    ) -> None:
        self.totals, self.days, self.silver = totals, days, silver
        self.spec = totals.lake.spec(totals.lake.silver_table)
        self.current = _days([d for (d,) in days.values if d in totals.current])
        stale = _days([d for (d,) in days.values if d not in totals.current])
        added = gold.with_hour(gold.valid_rows(silver_slice))
        self.added = added.where(self.current.predicate()) if self.current.values else None
        self.anew = gold.with_hour(gold.valid_rows(silver(stale))) if stale.values else None
        self._cached: list[DataFrame] = []

    def close(self) -> None:
        for df in self._cached:
            df.unpersist()

    def _taken(self) -> DataFrame | None:
        """The states of the replaced rows, by all keys of gold: a group has several."""
        taken = self.totals.taken
        return None if taken is None else self.totals.spark.read.parquet(taken)

    def _rows_of(self, groups: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        """Silver's valid rows of some groups, from the partitions that hold them."""
        fields = tuple(f for f in self.spec.partition_fields if f in keys)
        places = partitions_of(groups, fields) or partitions_of(groups, _DAY)
        rows = gold.with_hour(gold.valid_rows(self.silver(places)))
        return rows.join(_renamed(groups, keys).distinct(), _same(keys), "left_semi")

    def states(self, name: str) -> DataFrame:
        """The states of the groups that hold rows."""
        keys, found = gold.GROUP_KEYS[name], []
        if self.added is not None:
            stored = self.totals.read(f"state_{name}", self.current).select(*keys, *STATE)
            parts = stored.unionByName(moments(self.added, keys)).withColumn("sign", F.lit(1))
            if self.totals.taken is not None:
                taken = self._taken().select(*keys, *STATE)
                parts = parts.unionByName(taken.withColumn("sign", F.lit(-1)))
            merged = combined(parts, keys).persist()
            self._cached.append(merged)
            found.append(merged.where(~F.col("anew")).drop("anew"))
            again = merged.where("anew").select(*keys)
            if not again.isEmpty():
                found.append(moments(self._rows_of(again, keys), keys))
        if self.anew is not None:
            found.append(moments(self.anew, keys))
        return reduce(DataFrame.unionByName, found).where("rows > 0")

    def hours(self) -> DataFrame:
        """The states of hours, with the exact number of their distinct customers."""
        keys, rows = gold.GROUP_KEYS["by_hour"], self.anew if self.added is None else self.added
        whole = isinstance(rows.schema["customer_id"].dataType, WHOLE_NUMBERS)
        uniques = self._bitmap_counts() if whole else self._plain_counts()
        counted = self.states("by_hour").join(_renamed(uniques, keys, "uniques"), _same(keys), "left")
        return counted.select(*keys, *STATE, F.coalesce("uniques", F.lit(0)).cast("long").alias("uniques"))

    def _bitmap_counts(self) -> DataFrame:
        """Hours that lost no row extend their bitmaps; the others make them anew."""
        keys, parts = gold.GROUP_KEYS["by_hour"], []
        if self.added is not None:
            stored = self.totals.read(_CUSTOMERS, self.current).select(*keys, "bucket", "bits")
            merged = merged_bitmaps(stored.unionByName(bitmaps(self.added, keys, "customer_id")), keys)
            shrunk = self._taken()
            if shrunk is not None and not shrunk.isEmpty():
                merged = merged.join(_renamed(shrunk, keys), _same(keys), "left_anti")
                parts.append(bitmaps(self._rows_of(shrunk.select(*keys), keys), keys, "customer_id"))
            parts.append(merged)
        if self.anew is not None:
            parts.append(bitmaps(self.anew, keys, "customer_id"))
        self.totals._write(_CUSTOMERS, reduce(DataFrame.unionByName, parts), self.days)
        return distinct_numbers(self.totals.read(_CUSTOMERS, self.days), keys, "uniques")

    def _plain_counts(self) -> DataFrame:
        """For ids that are no whole numbers: hours that changed are counted from silver."""
        keys, parts = gold.GROUP_KEYS["by_hour"], []
        uniques = F.countDistinct("customer_id").alias("uniques")
        if self.added is not None:
            changed = self.added.select(*keys)
            if self.totals.taken is not None:
                changed = changed.unionByName(self._taken().select(*keys))
            changed = changed.distinct().persist()
            self._cached.append(changed)
            stored = self.totals.read(_HOUR, self.current).select(*keys, "uniques")
            parts.append(stored.join(_renamed(changed, keys), _same(keys), "left_anti"))
            parts.append(self._rows_of(changed, keys).groupBy(*keys).agg(uniques))
        if self.anew is not None:
            parts.append(self.anew.groupBy(*keys).agg(uniques))
        return reduce(DataFrame.unionByName, parts)
