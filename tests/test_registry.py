"""Every registered query equals its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(entry.oracle_sql())))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    found = table(df.columns, df.collect())
    result = db.sql(entry.oracle_sql()[name])
    assert found == table(result.columns, result.fetchall())
    assert found[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
