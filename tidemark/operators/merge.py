"""Merge of a batch into the rows a table already holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import TableSpec

EVENT_TIME = "event_time"
COMMIT_TIME = "commit_time"

_INCOMING = "_incoming_"


def _prefixed(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(_INCOMING + c) for c in columns])


def _compared(spec: TableSpec) -> list[str]:
    """The columns that decide which version of a row stands."""
    return list(dict.fromkeys((*spec.keys, spec.ordering_field)))


def _same(columns: tuple[str, ...]) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(_INCOMING + c)) for c in columns]


def stored_versions(
    existing: DataFrame, incoming: DataFrame, spec: TableSpec, also: Sequence[str] = ()
) -> DataFrame:
    """The stored rows of keys that the batch holds too, and whether they outrank the
    batch's (``_outranks``), from one read of the stored keys, ordering field and ``also``."""
    columns = list(dict.fromkeys((*_compared(spec), *also)))
    sent = _prefixed(incoming, _compared(spec))
    both = existing.select(*columns).join(sent, _same(spec.keys))
    return both.select(*columns, _outranks(spec).alias("_outranks"))


def _outranks(spec: TableSpec) -> Column:
    stored, sent = F.col(spec.ordering_field), F.col(_INCOMING + spec.ordering_field)
    return F.coalesce((stored > sent) | (stored.isNotNull() & sent.isNull()), F.lit(False))


def without(rows: DataFrame, others: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of other keys than those of ``others``."""
    return rows.join(_prefixed(others, list(spec.keys)), _same(spec.keys), "left_anti")


def accepted_rows(existing: DataFrame, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """Incoming rows that no stored row outranks. Equal ordering values accept;
    NULL is the least.

    Only keys and the ordering field of the stored rows are read, and they are
    first cut down to the batch's own keys: a batch small enough to broadcast
    shuffles no stored row.
    """
    newer = existing.select(*_compared(spec)).join(
        _prefixed(incoming, _compared(spec)),
        [*_same(spec.keys), _outranks(spec)],
        "left_semi",
    )
    return without(incoming, newer, spec)


def merge_batch(
    existing: DataFrame,
    incoming: DataFrame,
    spec: TableSpec,
    merge_order: str = EVENT_TIME,
    replaced: DataFrame | None = None,
) -> DataFrame:
    """Stored rows of untouched keys, plus the incoming rows that win.

    ``incoming`` holds one row per key. With ``event_time`` an incoming row older
    than the stored one loses; with ``commit_time`` it always wins. A stored row
    that stays is passed through as it is, commit mark included. ``replaced``, if known,
    are the stored rows whose place the winners take: mostly far fewer than the batch's, so
    that no stored row is shuffled to be compared with the others.
    """
    if merge_order not in (EVENT_TIME, COMMIT_TIME):
        raise ValueError(f"unknown merge order {merge_order!r}")
    winners = accepted_rows(existing, incoming, spec) if merge_order == EVENT_TIME else incoming
    kept = without(existing, winners if replaced is None else replaced, spec)
    return kept.unionByName(winners, allowMissingColumns=True)
