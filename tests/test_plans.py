"""Physical plans: what reaches the scan, what is shuffled, how files are laid out."""

from __future__ import annotations

import re
from contextlib import contextmanager, redirect_stdout
from io import StringIO
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.checks.bronze import bronze_rows
from tidemark.checks.catalogue import AS_OF, QUERIES
from tidemark.operators import gold
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import COMMIT_TIME, EVENT_TIME, merge_batch
from tidemark.operators.silver import to_silver
from tidemark.sources.partitions import Partitions, partitions_of
from tidemark.sources.readers import incremental, read_table, snapshot
from tidemark.sources.writers import bulk_insert, insert, upsert
from tidemark.spec import SILVER_SPEC, TableSpec

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def setting(spark, **values):
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df):
    out = StringIO()
    with setting(df.sparkSession, maxMetadataStringLength="10000"), redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def exchanges(text):
    """Shuffles in the plan tree."""
    return len(re.findall(r"^[^\n(]*[+:]- (?:Shuffle)?Exchange \(\d+\)", text.split("\n\n\n")[0], re.M))


@pytest.fixture(scope="module")
def silver_path(spark):
    from tidemark.checks.bronze import workspace

    path = workspace(spark)
    bulk_insert(to_silver(bronze_rows(spark, SF_DIR), AS_OF), path, SILVER_SPEC)
    return path


def test_silver_is_a_projection(spark):
    text = plan(to_silver(bronze_rows(spark, SF_DIR), AS_OF))
    assert exchanges(text) == 0 and "Python" not in text


def test_gold_reads_only_its_columns(spark, silver_path):
    silver = snapshot(spark, silver_path, SILVER_SPEC)
    text = plan(gold.by_category(silver, "b", AS_OF))
    assert "ReadSchema: struct<id:bigint,amount:double,is_valid:boolean>" in text
    assert "EqualTo(is_valid,true)" in text
    assert exchanges(text) == 1 and text.count("HashAggregate") > 1
    hourly = plan(gold.by_hour(silver, "b", AS_OF))
    assert exchanges(hourly) == 2  # the first on (day, hour, customer)
    assert re.search(r"hashpartitioning\(dt#\d+, hour#\d+, customer_id#\d+L", hourly)


def test_commit_range_reaches_the_scan(spark, silver_path):
    text = plan(incremental(spark, silver_path, SILVER_SPEC, 5, 9))
    assert "GreaterThan(_commit_us,5)" in text and "LessThanOrEqual(_commit_us,9)" in text


def test_commit_range_skips_row_groups(spark, folder):
    """One file with many row groups; rows of other commits are not decoded."""
    spec = TableSpec(partition_fields=("dt",), record_key="id", ordering_field="id")
    spark.conf.set("parquet.block.size", "65536")
    try:
        rows = spark.range(0, 400_000, 1, 1).selectExpr(
            "id", "'d' AS dt", "sha2(string(id), 256) AS v", "id AS _commit_us"
        )
        insert(rows, folder, spec)
    finally:
        spark.conf.unset("parquet.block.size")
    df = incremental(spark, folder, spec, 1000, 2000)
    assert df.agg(F.count("v")).first()[0] == 1000
    assert scanned(df.agg(F.count("v"))) < 100_000


def scanned(df):
    """Rows the file scans of ``df`` produced."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name.startswith("Scan "):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_touched_partitions_prune_the_scan(spark, silver_path):
    touched = Partitions(SILVER_SPEC.partition_fields, (("2024-01-05", "VIEW"), ("2024-01-05", None), (None, "CLICK")))
    df = read_table(spark, silver_path, SILVER_SPEC, touched)
    text = plan(df)
    assert "PartitionFilters: [" in text and "DataFilters" not in text
    # Only the two days' directories are even listed.
    assert sorted({r.dt or "" for r in df.select("dt").distinct().collect()}) == ["", "2024-01-05"]
    listed = read_table(spark, silver_path, SILVER_SPEC, touched).inputFiles()
    assert {Path(f).parent.parent.name for f in listed} == {"dt=2024-01-05", "dt=__HIVE_DEFAULT_PARTITION__"}


def test_predicate_stays_short(spark):
    days = [f"d{i:03}" for i in range(250)]
    touched = Partitions(("dt", "kind"), tuple((d, k) for d in days for k in ("a", "b", "c", None)))
    assert str(touched.predicate()).count("OR") < 5
    # However irregular, a thousand partitions make no deep expression.
    ragged = Partitions(("dt", "kind"), tuple((f"d{i}", f"k{i}") for i in range(1000)))
    df = spark.createDataFrame([("d7", "k7"), ("d7", "k8")], "dt string, kind string")
    assert df.where(ragged.predicate()).collect() == [("d7", "k7")]


def test_too_many_partitions_are_not_listed(spark):
    df = spark.range(20).selectExpr("string(id) AS dt")
    assert partitions_of(df, ("dt",), 19) is None
    assert len(partitions_of(df, ("dt",), 20).values) == 20


def _merge_plan(spark, silver_path, merge_order):
    existing = snapshot(spark, silver_path, SILVER_SPEC)
    batch = latest_per_key(existing.where("dt = '2024-01-05'"), SILVER_SPEC.keys, "ts")
    return plan(merge_batch(existing, batch.persist(), SILVER_SPEC, merge_order))


@pytest.mark.parametrize("merge_order, scans", [(EVENT_TIME, 3), (COMMIT_TIME, 1)])
def test_merge_of_a_small_batch_shuffles_no_stored_row(spark, silver_path, merge_order, scans):
    text = _merge_plan(spark, silver_path, merge_order)
    tree = text.split("\n\n\n")[0]
    assert "SortMergeJoin" not in tree and "CartesianProduct" not in text and "NestedLoop" not in text
    assert tree.count("BroadcastHashJoin LeftAnti BuildRight") >= 1
    # One wide scan; the others read keys and the ordering field.
    reads = re.findall(r"ReadSchema: (struct<.*>)", text)
    assert reads.count("struct<id:bigint,ts:timestamp_ntz>") == scans - 1


def test_merge_of_a_large_batch_falls_back_to_shuffles(spark, silver_path):
    with setting(spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1"):
        text = _merge_plan(spark, silver_path, EVENT_TIME)
    assert "SortMergeJoin LeftAnti" in text and "BroadcastHashJoin" not in text


def test_latest_limits_each_key_before_the_shuffle(spark):
    text = plan(latest_per_key(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"), ["l_orderkey", "l_linenumber"], "l_shipdate"))
    tree = text.split("\n\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2 and exchanges(text) == 1


HOT = TableSpec(partition_fields=("dt",), record_key="id", ordering_field="ts")


def _hot_rows(spark, n=200_000):
    """Half of all rows on one day, in eight map tasks."""
    return spark.range(0, n, 1, 8).selectExpr(
        "id", "id AS ts", "if(id % 2 = 0, 'hot', concat('d', id % 50)) AS dt", "sha2(string(id), 256) AS v"
    )


def _files(folder, dt):
    return len(list(Path(folder).glob(f"dt={dt}/*.parquet")))


def test_hot_partition_is_split_and_small_ones_are_packed(spark, folder):
    with setting(spark, adaptive__advisoryPartitionSizeInBytes="1mb"):
        upsert(_hot_rows(spark), folder, HOT, 1)
        assert _files(folder, "hot") > 3 and _files(folder, "d1") <= 2
        upsert(_hot_rows(spark).withColumn("ts", F.col("ts") + 1), folder, HOT, 2)
    assert _files(folder, "hot") > 3
    stored = snapshot(spark, folder, HOT)
    assert stored.agg(F.count("*"), F.countDistinct("dt", "id"), F.sum("ts"), F.min("_commit_us")).first() == (
        200_000,
        200_000,
        sum(range(1, 200_001)),
        2,
    )


def test_hot_partition_is_split_inside_a_stream(spark, folder):
    _hot_rows(spark).write.parquet(f"{folder}/in")

    def deliver(batch, _epoch):
        upsert(batch, f"{folder}/out", HOT, 1)

    with setting(spark, adaptive__advisoryPartitionSizeInBytes="1mb"):
        stream = spark.readStream.schema(_hot_rows(spark).schema).parquet(f"{folder}/in")
        stream.writeStream.foreachBatch(deliver).trigger(availableNow=True).option(
            "checkpointLocation", f"{folder}/checkpoint"
        ).start().awaitTermination()
    assert _files(f"{folder}/out", "hot") > 3 and _files(f"{folder}/out", "d1") <= 2


def test_hot_key_group_and_customer(spark):
    """A third of all rows share one key, one group and one customer."""
    n = 90_000
    silver = spark.range(0, n, 1, 6).selectExpr(
        "if(id % 3 = 0, 0, id) AS id",
        "make_timestamp_ntz(2024, 1, 1, if(id % 3 = 0, 7, id % 24), 0, 0) AS ts",
        "1.0D AS amount",
        "if(id % 3 = 0, 0, id) AS customer_id",
        "'2024-01-01' AS dt",
        "if(id % 3 = 0, 'HOT', concat('C', id % 10)) AS category_code",
        "true AS is_valid",
    )
    categories = {r.category_code: r.transaction_count for r in gold.by_category(silver, "b").collect()}
    assert categories["HOT"] == n // 3 and sum(categories.values()) == n
    hours = {r.hour: (r.transaction_count, r.unique_customers) for r in gold.by_hour(silver, "b").collect()}
    in_seven = sum(1 for i in range(n) if i % 3 and i % 24 == 7)
    assert hours[7] == (n // 3 + in_seven, 1 + in_seven)
    assert latest_per_key(silver, ["id"], "ts").count() == n - n // 3 + 1


def test_no_query_runs_python_on_rows(spark):
    for name in ("bronze_fixture", "silver_full", "gold_by_hour", "precombine_events", "batch_metadata"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "Python" not in text and "CartesianProduct" not in text


def test_clustered_files_skip_row_groups_by_either_column(spark, folder):
    """Two columns of no common order; a filter on either reads a part of the rows."""
    spec = TableSpec(partition_fields=("dt",), record_key="id", ordering_field="id")
    rows = spark.range(0, 120_000, 1, 4).selectExpr(
        "id", "'d' AS dt", "id * 7919 % 120000 AS x", "sha2(string(id), 256) AS y", "1L AS _commit_us"
    )
    spark.conf.set("parquet.block.size", "65536")
    try:
        bulk_insert(rows, folder, spec, cluster_by=("x", "y"))
    finally:
        spark.conf.unset("parquet.block.size")
    stored = snapshot(spark, folder, spec)
    for condition in ("x BETWEEN 1000 AND 1500", "y BETWEEN '80' AND '81'"):
        part = stored.where(condition).agg(F.count("id"))
        assert part.first()[0] == rows.where(condition).count() > 0
        assert scanned(part) < 60_000
    assert stored.count() == 120_000


def test_files_older_than_the_range_are_not_opened(spark, folder):
    import os
    import time

    spec = TableSpec(partition_fields=("dt",), record_key="id", ordering_field="id")
    frame = spark.createDataFrame([(1, "d")], "id long, dt string")
    now = int(time.time() * 1e6)
    insert(frame, folder, spec, now - 5 * 3600 * 1_000_000)
    (old,) = Path(folder).rglob("*.parquet")
    aged = time.time() - 4 * 3600
    os.utime(old, (aged, aged))
    insert(frame, folder, spec, now)
    fresh = incremental(spark, folder, spec, now - 3600 * 1_000_000, now)
    assert len(fresh.inputFiles()) == 1 and fresh.count() == 1
    assert incremental(spark, folder, spec, 0, now).count() == 2
    # nothing that new: the columns are known all the same
    later = incremental(spark, folder, spec, now + 3 * 3600 * 1_000_000, now + 4 * 3600 * 1_000_000)
    assert later.columns == fresh.columns and later.count() == 0
    with pytest.raises(ValueError, match="ahead of the clock"):
        insert(frame, folder, spec, now + 3600 * 1_000_000)


def test_stored_keys_outside_the_batch_are_skipped(spark, folder):
    """The match reads the row groups whose keys the batch's range meets."""
    from tidemark.operators.merge import stored_versions
    from tidemark.sources.writers import _key_range

    spec = TableSpec(partition_fields=("dt",), record_key="id", ordering_field="id")
    spark.conf.set("parquet.block.size", "65536")
    try:
        bulk_insert(spark.range(0, 200_000, 1, 1).selectExpr("id", "'d' AS dt", "sha2(string(id), 256) AS v"), folder, spec, 1)
    finally:
        spark.conf.unset("parquet.block.size")
    batch = spark.range(500, 700).selectExpr("id", "'d' AS dt", "'new' AS v")
    existing = read_table(spark, folder, spec, also=batch.schema)
    assert scanned(stored_versions(_key_range(existing, (500, 699), spec), batch, spec)) < 50_000
    report = upsert(batch, folder, spec, 2)
    assert (report.rows, report.written) == (200, 200)
    assert snapshot(spark, folder, spec).where("v = 'new'").count() == 200


def test_replaced_rows_come_from_the_one_match(spark, folder):
    """Neither the stored files nor the batch are joined again to tell what is replaced."""
    seen = []

    def rows(first, last, v):
        return spark.range(first, last).selectExpr("id", "'d' AS dt", f"IF(id = 95, 2, {v}) AS ts", f"{v} AS v")

    def look(replaced, _):
        seen.append((scanned(replaced), sorted((r.id, r.v) for r in replaced.collect())))

    upsert(rows(0, 100, 3), folder, TableSpec(), 1)
    for limit, mark in ((1000, 2), (0, 3)):  # partitions listed, and too many to list
        upsert(
            rows(90, 110, 2 + mark), folder, TableSpec(), mark, before_write=look, replaced_columns=("v",),
            max_literal_partitions=limit,
        )
    assert seen == [(0, [(i, 3) for i in range(90, 100)]), (0, [(i, 4) for i in range(90, 110)])]
    upsert(rows(94, 112, 0), folder, TableSpec(), 4, before_write=look, replaced_columns=("v",))  # older but 95
    assert seen[2] == (0, [(95, 5)])
    found = {r.id: r.v for r in snapshot(spark, folder, TableSpec()).collect()}
    assert found == {i: 3 for i in range(90)} | {i: 5 for i in range(90, 110)} | {95: 0, 110: 0, 111: 0}


def test_merge_of_a_large_batch_that_replaces_few_shuffles_no_stored_row(spark, silver_path):
    existing = read_table(spark, silver_path, SILVER_SPEC)
    replaced = existing.where("id = 7").persist()
    replaced.count()
    with setting(spark, autoBroadcastJoinThreshold="20k"):
        text = plan(merge_batch(existing, existing, SILVER_SPEC, COMMIT_TIME, replaced))
    assert exchanges(text) == 0 and "BroadcastHashJoin" in text
