"""Reads and writes of partitioned tables."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import COMMIT_TIME, EVENT_TIME
from tidemark.sources import writers
from tidemark.sources.partitions import Partitions, PartitionSpan
from tidemark.sources.readers import (
    ColumnTypeError,
    incremental,
    read_table,
    snapshot,
    table_exists,
)
from tidemark.sources.writers import NullKeyError, bulk_insert, insert, replace_partitions, upsert
from tidemark.spec import BRONZE_SPEC, COMMIT_COL, DEFAULT_SPECS, Lake, TableSpec

SPEC = TableSpec(partition_fields=("dt", "kind"), record_key="id", ordering_field="ts")
SCHEMA = "id int, ts int, dt string, kind string, v string"


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def _stored(spark, path, spec=SPEC):
    return sorted((tuple(r) for r in snapshot(spark, path, spec).select("id", "ts", "dt", "kind", "v", COMMIT_COL).collect()), key=repr)


def test_specs_and_names():
    lake = Lake("/data")
    assert lake.path("silver_events") == "/data/silver_events"
    assert lake.gold_table("by_hour") == "gold_agg_by_hour"
    assert lake.spec("silver_events").keys == ("id", "dt", "category_code")
    assert lake.spec("never described") == TableSpec(("dt",), "id", "ts", "COPY_ON_WRITE")
    assert set(DEFAULT_SPECS) == {
        "bronze_events",
        "silver_events",
        "gold_agg_by_category",
        "gold_agg_by_hour",
    }
    with pytest.raises(ValueError):
        TableSpec(table_type="MERGE_ON_READ")


def test_exists(spark, folder):
    assert not table_exists(spark, folder, SPEC)
    with pytest.raises(FileNotFoundError):
        snapshot(spark, folder, SPEC)
    insert(_rows(spark, (1, 1, "2024-01-01", "a", "x")), folder, SPEC, 1)
    assert table_exists(spark, folder, SPEC)
    # Anything but a missing path is an error, not an absent table.
    with pytest.raises(Exception, match="(?i)scheme"):
        table_exists(spark, "nosuchscheme://host/table", SPEC)


def test_upsert_twice_is_once(spark, folder):
    batch = _rows(spark, (1, 1, "2024-01-01", "a", "x"), (2, 1, "2024-01-02", "b", "y"))
    upsert(batch, folder, SPEC, 5)
    once = _stored(spark, folder)
    report = upsert(batch, folder, SPEC, 5)
    assert _stored(spark, folder) == once and (report.rows, report.rejected) == (2, 0)


def test_merge_order(spark, folder):
    upsert(_rows(spark, (1, 5, "d", "a", "old"), (2, 5, "d", "a", "old"), (3, 5, "d", "a", "old")), folder, SPEC, 1)
    late = _rows(spark, (1, 4, "d", "a", "older"), (2, 5, "d", "a", "equal"), (3, 6, "d", "a", "newer"))
    upsert(late, folder, SPEC, 2)
    assert _stored(spark, folder) == [
        (1, 5, "d", "a", "old", 1),
        (2, 5, "d", "a", "equal", 2),
        (3, 6, "d", "a", "newer", 2),
    ]
    upsert(late, folder, SPEC, 3, merge_order=COMMIT_TIME)
    assert [r[4] for r in _stored(spark, folder)] == ["older", "equal", "newer"]
    with pytest.raises(ValueError):
        upsert(late, folder, SPEC, 4, merge_order="whatever")


def test_null_order_is_least(spark, folder):
    upsert(_rows(spark, (1, None, "d", "a", "none"), (2, 1, "d", "a", "some"), (3, None, "d", "a", "none")), folder, SPEC, 1)
    upsert(_rows(spark, (1, 1, "d", "a", "new"), (2, None, "d", "a", "new"), (3, None, "d", "a", "new")), folder, SPEC, 2)
    assert [r[4] for r in _stored(spark, folder)] == ["new", "some", "new"]


def test_key_that_moves_partition_stays_in_both(spark, folder):
    upsert(_rows(spark, (1, 1, "2024-01-01", "a", "x")), folder, SPEC, 1)
    upsert(_rows(spark, (1, 2, "2024-01-02", "a", "y")), folder, SPEC, 2)
    assert [(r[2], r[4]) for r in _stored(spark, folder)] == [("2024-01-01", "x"), ("2024-01-02", "y")]


def test_null_and_blank_partitions(spark, folder):
    upsert(_rows(spark, (1, 1, None, "", "x"), (2, 1, "d", None, "y")), folder, SPEC, 1)
    upsert(_rows(spark, (1, 2, None, None, "new"), (2, 2, "d", "", "new"), (3, 1, "", "k", "z")), folder, SPEC, 2)
    assert _stored(spark, folder) == [
        (1, 2, None, None, "new", 2),
        (2, 2, "d", None, "new", 2),
        (3, 1, None, "k", "z", 2),
    ]


def test_blank_and_null_partition_are_one_key(spark, folder):
    report = upsert(_rows(spark, (1, 1, "d", "", "x"), (1, 2, "d", None, "y")), folder, SPEC, 1)
    assert report.rows == 2 and _stored(spark, folder) == [(1, 2, "d", None, "y", 1)]


def test_partition_values_keep_their_text(spark, folder):
    awkward = ["007", "2024-01-01", "a/b", "50%", "x=y", "{a,b}", "*", "sp ace", "é"]
    rows = [(i, 1, dt, "1e3", "x") for i, dt in enumerate(awkward)]
    for mark in (1, 2):
        upsert(_rows(spark, *rows), folder, SPEC, mark)
    assert {(r[2], r[3], r[5]) for r in _stored(spark, folder)} == {(dt, "1e3", 2) for dt in awkward}


def test_null_keys(spark, folder):
    batch = _rows(spark, (1, 1, "d", "a", "x"), (None, 1, "d", "a", "p"), (None, 2, "d", "a", "q"))
    with pytest.raises(NullKeyError, match="2 rows"):
        upsert(batch, folder, SPEC, 1)
    assert not table_exists(spark, folder, SPEC)
    report = upsert(batch, folder, SPEC, 1, on_null_key="reject")
    assert (report.rows, report.rejected) == (1, 2)
    assert _stored(spark, folder) == [(1, 1, "d", "a", "x", 1)]


def test_empty_batch_writes_nothing(spark, folder):
    assert upsert(_rows(spark), folder, SPEC, 1).rows == 0
    assert not table_exists(spark, folder, SPEC)


def test_new_and_missing_columns_survive(spark, folder):
    upsert(_rows(spark, (1, 1, "d", "a", "x"), (2, 1, "e", "a", "x")), folder, SPEC, 1)
    upsert(_rows(spark, (3, 1, "d", "a", "z")).withColumn("extra", F.lit(7)), folder, SPEC, 2)
    upsert(_rows(spark, (4, 1, "d", "a", "w")).drop("v"), folder, SPEC, 3)
    stored = read_table(spark, folder, SPEC, Partitions(("dt",), (("d",),)))
    assert {(r.id, r.v, r.extra) for r in stored.collect()} == {(1, "x", None), (3, "z", 7), (4, None, None)}


def test_insert_and_bulk_insert_allow_duplicates(spark, folder):
    batch = _rows(spark, (1, 1, "d", "a", "x"))
    insert(batch, folder, SPEC, 1)
    bulk_insert(batch, folder, SPEC, 2)
    assert [r[5] for r in _stored(spark, folder)] == [1, 2]
    with pytest.raises(ValueError, match=COMMIT_COL):
        insert(batch, folder, SPEC)


def test_upsert_replaces_all_copies(spark, folder):
    for mark in (1, 2):
        insert(_rows(spark, (1, 1, "d", "a", "copy"), (2, 1, "d", "a", "other")), folder, SPEC, mark)
    upsert(_rows(spark, (1, 2, "d", "a", "new")), folder, SPEC, 3)
    assert _stored(spark, folder) == [
        (1, 2, "d", "a", "new", 3),
        (2, 1, "d", "a", "other", 1),
        (2, 1, "d", "a", "other", 2),
    ]


def test_windows_tile(spark, folder):
    for mark in (10, 20, 30):
        insert(_rows(spark, (mark, 1, "d", "a", "x")), folder, SPEC, mark)
    read = [[r.id for r in incremental(spark, folder, SPEC, b, e).collect()] for b, e in ((10, 20), (20, 30))]
    assert read == [[20], [30]]  # a commit at begin is out, at end is in


def test_untouched_rows_keep_their_mark(spark, folder):
    upsert(_rows(spark, (1, 1, "d", "a", "x"), (2, 1, "d", "a", "y")), folder, SPEC, 1)
    upsert(_rows(spark, (2, 2, "d", "a", "z")), folder, SPEC, 2)
    assert [r.id for r in incremental(spark, folder, SPEC, 1, 2).collect()] == [2]


def test_replace_partitions(spark, folder):
    upsert(_rows(spark, (1, 1, "d", "a", "x"), (2, 1, "e", "a", "y")), folder, SPEC, 1)
    replace_partitions(_rows(spark, (3, 1, "d", "a", "z")), folder, SPEC, 2)
    assert [(r[0], r[2]) for r in _stored(spark, folder)] == [(2, "e"), (3, "d")]


def test_session_overwrite_mode_does_not_matter(spark, folder):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        upsert(_rows(spark, (1, 1, "d", "a", "x"), (2, 1, "e", "a", "y")), folder, SPEC, 1)
        upsert(_rows(spark, (1, 2, "d", "a", "z")), folder, SPEC, 2)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r[4] for r in _stored(spark, folder)] == ["z", "y"]


@pytest.mark.parametrize(
    "literal", ["DATE'2024-01-01'", "7", "true", "1.50BD", "TIMESTAMP'2024-01-01 10:00:00'"]
)
def test_typed_partition_field(spark, folder, literal):
    spec = TableSpec(partition_fields=("part",), record_key="id", ordering_field="ts")
    frame = spark.sql(f"SELECT 1 AS id, t AS ts, {literal} AS part FROM VALUES (1), (2) AS v(t)")
    for mark in (1, 2):
        upsert(frame, folder, spec, mark)
    schema = T.StructType([*frame.schema.fields, T.StructField(COMMIT_COL, T.LongType())])
    typed = TableSpec(("part",), "id", "ts", schema=schema)
    stored = snapshot(spark, folder, typed).collect()
    assert [(r.ts, r.part, r[COMMIT_COL]) for r in stored] == [(2, frame.first().part, 2)]


def test_default_spec_table(spark, folder):
    rows = spark.sql("SELECT 1 AS id, 1 AS ts, '2024-01-01' AS dt")
    upsert(rows, folder, BRONZE_SPEC, 1)
    assert dict(snapshot(spark, folder, BRONZE_SPEC).dtypes)["dt"] == "string"


@pytest.mark.parametrize("merge_order", [EVENT_TIME, COMMIT_TIME])
@pytest.mark.parametrize("literal_partitions", [1000, 3])
def test_random_batches_against_a_dictionary(spark, folder, merge_order, literal_partitions):
    """A third of all rows share one key; partitions are matched by literals, or
    by a join once there are more of them than allowed."""
    chance, model = random.Random(7), {}
    for mark in range(1, 5):
        batch = []
        for n in range(300):
            key = 0 if n % 3 == 0 else chance.randrange(60)
            where = (chance.choice(["d1", "d2", "d3", None]), chance.choice(["a", "b", None]))
            batch.append((key, chance.randrange(20), *where, f"{mark}-{n:03}"))
        best = {}
        for row in batch:
            best[row[0], row[2], row[3]] = max(best.get((row[0], row[2], row[3]), row), row, key=lambda r: (r[1], r[4]))
        for key, row in best.items():
            if merge_order == COMMIT_TIME or key not in model or row[1] >= model[key][1]:
                model[key] = (*row, mark)
        frame = _rows(spark, *batch).repartition(5)
        report = upsert(
            frame, folder, SPEC, mark, merge_order=merge_order, max_literal_partitions=literal_partitions
        )
        assert report.rows == len(batch)
        assert isinstance(report.partitions, PartitionSpan) == (literal_partitions == 3)
    assert _stored(spark, folder) == sorted(model.values(), key=repr)


def _files(folder):
    return {str(f.relative_to(folder)) for f in Path(folder).rglob("*.parquet")}


def test_partitions_without_stored_keys_keep_their_files(spark, folder):
    first = [(1, 1, "d", "a", "x"), (2, 1, "e", "a", "x"), (3, 1, None, "a", "x"), (4, 1, "f", None, "x")]
    upsert(_rows(spark, *first), folder, SPEC, 1)
    before = _files(folder)
    second = [(5, 1, "d", "a", "y"), (2, 2, "e", "a", "y"), (6, 1, None, "a", "y"), (7, 1, "f", None, "y")]
    for _ in range(2):  # run again, the table is the same
        upsert(_rows(spark, *second), folder, SPEC, 2)
        assert _stored(spark, folder) == sorted(
            [(*r, 1) for r in first if r[0] != 2] + [(*r, 2) for r in second], key=repr
        )
        if _ == 0:
            kept = before & _files(folder)
            assert len(kept) == 3 and not any("dt=e" in f for f in kept)


def test_crash_between_append_and_merge_is_repaired(spark, folder, monkeypatch):
    upsert(_rows(spark, (1, 1, "d", "a", "x"), (2, 1, "e", "a", "x")), folder, SPEC, 1)
    batch = _rows(spark, (3, 1, "d", "a", "y"), (2, 2, "e", "a", "y"))
    with monkeypatch.context() as patch:
        patch.setattr(writers, "merge_batch", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError, match="crash"):
            upsert(batch, folder, SPEC, 2)
    upsert(batch, folder, SPEC, 2)
    assert [(r[0], r[4], r[5]) for r in _stored(spark, folder)] == [(1, "x", 1), (2, "y", 2), (3, "y", 2)]


def test_failed_write_leaves_the_table(spark, folder, monkeypatch):
    upsert(_rows(spark, (1, 1, "d", "a", "x")), folder, SPEC, 1)
    before, save = _stored(spark, folder), writers._save

    def broken(df, *rest):
        return save(df.withColumn("v", F.raise_error(F.lit("disk on fire")).cast("string")), *rest)

    monkeypatch.setattr(writers, "_save", broken)
    with pytest.raises(Exception, match="disk on fire"):
        upsert(_rows(spark, (1, 2, "d", "a", "y")), folder, SPEC, 2)
    assert _stored(spark, folder) == before


def test_conflicting_types_are_an_error(spark, folder):
    upsert(_rows(spark, (1, 1, "d", "a", "x")), folder, SPEC, 1)
    with pytest.raises(ColumnTypeError, match="v is stored as string, not int"):
        upsert(_rows(spark, (1, 2, "d", "a", "7")).withColumn("v", F.col("v").cast("int")), folder, SPEC, 2)
    assert [r[4] for r in _stored(spark, folder)] == ["x"]


def test_errors_keep_their_kind(spark, folder):
    insert(_rows(spark, (1, 1, "d", "a", "x")), folder, SPEC, 1)
    with pytest.raises(AnalysisException):
        snapshot(spark, folder, SPEC).select("nope")
