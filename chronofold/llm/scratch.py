"""Intermediate tables of an operator, removed as soon as a later table holds what they were for."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from chronofold.session import shared_folder


class Scratch:
    """Tables in the shared folder.  A table that is kept survives lost executors; only tables nothing reads any more are dropped."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """The rows by way of a table: cuts the lineage."""
        self.paths[name] = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(self.paths[name])
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def drop(self, *names: str) -> None:
        """Removes tables, and lets the driver collect garbage, whereupon Spark drops the shuffle files of jobs that are done."""
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        context._jvm.System.gc()
