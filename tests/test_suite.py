"""Every registered query against its SQL statement on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return float(value) if type(value).__name__ == "Decimal" else value


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, sql, name):
    df = entry_module.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    assert rows
    statement = entry_module.oracle_sql().get(name)
    if statement is None:
        return
    result = sql.execute(statement)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)
    assert rows == expected


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_ad_hoc_sql_leaves_no_views(spark):
    """Its tables are views of the session only while the statement is read."""
    df = entry_module.queries()["ad_hoc_sql"](spark, FOLDER)
    assert not [t.name for t in spark.catalog.listTables() if t.isTemporary and t.name == "customer"]
    assert df.count() > 0
