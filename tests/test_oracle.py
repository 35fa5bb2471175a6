"""Every registered query against its DuckDB twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_twin_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_twin(spark, duck, name):
    frame = entry_module.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = [tuple(r) for r in frame.select(*columns).collect()]
    result = duck.execute(entry_module.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert sorted(got, key=str) == sorted(want, key=str)
