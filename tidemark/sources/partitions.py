"""The partitions a batch touches, and predicates that read only those."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Beyond this many partitions a batch is matched by a join, and pruned by its span.
MAX_LITERAL_PARTITIONS = 1000

# Directory name Spark gives a NULL partition value.
NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"

# Values whose text is the same in Python and in a directory name.
_PLAIN_TYPES = (str, int, date, type(None))


@dataclass(frozen=True)
class Partitions:
    """Distinct partition values, one tuple per partition."""

    fields: tuple[str, ...]
    values: tuple[tuple, ...]

    def predicate(self) -> Column:
        """Literal condition on the partition fields; NULL matches NULL. Spark
        evaluates it on the directory listing, so other files are never opened."""
        return _matching(self.fields, self.values)

    def directories(self, path: str) -> str:
        """Glob over the first-level directories, so that only they are listed.
        The table's own path if a value would need escaping in it."""
        heads = {value[0] for value in self.values}
        if any(isinstance(head, bool) or not isinstance(head, _PLAIN_TYPES) for head in heads):
            return path
        names = sorted(NULL_DIRECTORY if head is None else str(head) for head in heads)
        if not names or not all(re.fullmatch(r"[\w.-]+", name) for name in names):
            return path
        return f"{path}/{self.fields[0]}={{{','.join(names)}}}"


@dataclass(frozen=True)
class PartitionSpan:
    """Bounds of the first partition field, for batches of too many partitions to list.
    It prunes, but holds partitions between the bounds that the batch does not touch."""

    field: str
    least: object
    most: object
    nulls: bool

    def predicate(self) -> Column:
        conditions = [F.col(self.field).isNull()] if self.nulls else []
        if self.least is not None:
            conditions.append(F.col(self.field).between(self.least, self.most))
        return _any(conditions)

    def directories(self, path: str) -> str:
        return path


def _one_of(name: str, values: Sequence) -> Column:
    present = [v for v in values if v is not None]
    conditions = [F.col(name).isin(present)] if present else []
    if len(present) < len(values):
        conditions.append(F.col(name).isNull())
    return _any(conditions)


def _matching(fields: Sequence[str], values: Iterable[tuple]) -> Column:
    """Condition that the fields hold one of ``values``. Leading values with the
    same continuations share a condition, which keeps it short when, say, every
    day of a batch has the same categories."""
    continuations: dict = defaultdict(set)
    for head, *tail in values:
        continuations[head].add(tuple(tail))
    heads = defaultdict(list)
    for head, tails in continuations.items():
        heads[frozenset(tails)].append(head)
    conditions = []
    for tails, alike in heads.items():
        condition = _one_of(fields[0], alike)
        if len(fields) > 1:
            condition = condition & _matching(fields[1:], tails)
        conditions.append(condition)
    return _any(conditions)


def _any(conditions: list[Column]) -> Column:
    # Pairwise, so that the expression stays shallow however many there are.
    while len(conditions) > 1:
        pairs = [conditions[i : i + 2] for i in range(0, len(conditions), 2)]
        conditions = [pair[0] | pair[1] if len(pair) == 2 else pair[0] for pair in pairs]
    return conditions[0] if conditions else F.lit(False)


def blank_to_null(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """An empty partition value is stored as NULL; make it NULL up front, so that
    rows compare as they will read back."""
    text = [f for f in fields if isinstance(df.schema[f].dataType, T.StringType)]
    return df.withColumns({f: F.when(F.col(f) != "", F.col(f)) for f in text})


def partitions_of(
    df: DataFrame, fields: Sequence[str], limit: int = MAX_LITERAL_PARTITIONS
) -> Partitions | None:
    """Distinct partitions of ``df``, or None if there are more than ``limit``."""
    rows = df.select(*fields).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return Partitions(tuple(fields), tuple(tuple(row) for row in rows))


def in_partitions_of(rows: DataFrame, batch: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The ``rows`` whose partition ``batch`` touches; NULL matches NULL."""
    wanted = batch.select(*[F.col(f).alias(f"_touched_{f}") for f in fields]).distinct()
    same = [F.col(f).eqNullSafe(F.col(f"_touched_{f}")) for f in fields]
    return rows.join(wanted, same, "left_semi")
