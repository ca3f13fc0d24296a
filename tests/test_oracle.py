"""Every catalogue query against DuckDB on the same tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tidemark.checks.catalogue import QUERIES
from tidemark.checks.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("events", "lineitem"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def _normal(rows):
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in rows), key=repr
    )


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = result.select(*columns).collect()
    listed = ", ".join(f'"{c}"' for c in columns)
    assert len(duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()) == len(columns)
    expected = duck.execute(f"SELECT {listed} FROM ({ORACLE[name]})").fetchall()
    assert ours, "the query returned nothing"
    assert _normal(tuple(r) for r in ours) == _normal(expected)
