"""What one task or the driver holds does not grow with the tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from chronofold.operators import select
from chronofold.plans import features
from chronofold.sources import tables
from chronofold.suite import REGISTRY

FOLDER = "/root/testdata/sf0.01"


def test_rows_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(select, "ROWS_IN_TASK", 1000)
    rows = spark.range(0, 20_000, 1, 1).select("id", F.lit(0).alias("same"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    sizes = [r["count"] for r in select.dealt(rows, 20_000, *rows.columns).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) == 20 and max(sizes) < 1500
    assert select.dealt(rows, 1000, "id") is rows


@pytest.mark.parametrize("name", ["ladder_latest", "linked_orders", "partitions_built"])
def test_dealt_rows_give_the_same_answer(spark, monkeypatch, name):
    """Over tasks of a thousand rows and without a broadcast of keys the queries give the rows of their SQL."""
    monkeypatch.setattr(select, "ROWS_IN_TASK", 1000)
    monkeypatch.setattr(tables, "BROADCAST_KEYS", 0)
    con = duckdb.connect()
    for table in ("orders", "customer", "nation"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    wanted = con.execute(REGISTRY[name].sql).fetchall()
    assert sorted(map(repr, (tuple(r) for r in REGISTRY[name].run(spark, FOLDER).collect()))) == sorted(map(repr, wanted))


def test_trees_fit_on_dealt_rows(spark, monkeypatch):
    """A table of one large split is fitted by tasks of a bounded number of rows."""
    monkeypatch.setattr(select, "ROWS_IN_TASK", 500)
    sizes = []
    monkeypatch.setattr(features, "assembled", lambda df, *a, real=features.assembled: sizes.append(df.rdd.getNumPartitions()) or real(df, *a))
    rows = spark.range(0, 5000, 1, 1).select((F.col("id") % 50).cast("double").alias("x"), "id", (F.col("id") % 50 * 2).cast("double").alias("y"))
    _, importances = features.boosted_trees(rows, ["x"], "y", rounds=1)
    assert sizes == [10] and [tuple(r) for r in importances.collect()] == [("x", 1.0)]


def test_many_keys_of_a_batch_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(tables, "BROADCAST_KEYS", 10)
    target = spark.range(1000).withColumn("v", F.lit(1))
    plan = lambda n: tables.merged(target, spark.range(n).withColumn("v", F.lit(2)), ["id"])._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan(10) and "SortMergeJoin" in plan(11) and "BroadcastHashJoin" not in plan(11)


def test_texts_are_read_once_for_two_upserts(spark, monkeypatch):
    """What is upserted twice is a written copy, not the plan over the texts."""
    from chronofold.sources.tables import TableStore

    seen = []
    monkeypatch.setattr(TableStore, "write", lambda self, table, df, mode="append", real=TableStore.write: seen.append(df.inputFiles()) or real(self, table, df, mode))
    got = REGISTRY["registry_counts"].run(spark, "/root/testdata/sf0.001").first()
    assert got.processed == got.grounded + got.ungrounded > 0
    assert len(seen) == 2 and not [f for files in seen for f in files if "documents.parquet" in f]
