"""Instants as integers: commit marks and batch windows count microseconds
since the epoch in UTC, so comparisons are exact and reach the Parquet scan."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def as_utc(moment: datetime) -> datetime:
    """A naive datetime is taken to be UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def to_micros(moment: datetime) -> int:
    return (as_utc(moment) - EPOCH) // timedelta(microseconds=1)


def from_micros(micros: int) -> datetime:
    return EPOCH + timedelta(microseconds=micros)


def instant(moment: datetime | None) -> Column:
    """TIMESTAMP literal for ``moment``; the query's start time if none is given."""
    if moment is None:
        return F.current_timestamp()
    return F.timestamp_micros(F.lit(to_micros(moment)))


def wall_to_micros(wall: Column) -> Column:
    """Mark of a TIMESTAMP_NTZ column holding UTC wall-clock time."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall)
    return F.unix_micros(local.cast("timestamp"))


def micros_to_wall(micros: Column) -> Column:
    """TIMESTAMP_NTZ holding the UTC wall-clock time of a mark."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.timestamp_micros(micros).cast("timestamp_ntz")
    )
