"""Registry of checked queries: a Spark plan and, where SQL can say it, an independent statement."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.functions.values import micros
from chronofold.session import shared_folder


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: str


REGISTRY: dict[str, Query] = {}


class Tables:
    """Lazy access to the test tables: ``t.orders``, ``t.events``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, name: str) -> str:
        """New folder for what a query writes."""
        return f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"

    @property
    def timed_events(self) -> DataFrame:
        """Events with ``t``, microseconds since the epoch."""
        return self.events.withColumn("t", micros(F.col("ts")))


def query(covers: str, sql: str | None = None):
    """Register a function of :class:`Tables` under its name."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, folder))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        REGISTRY[fn.__name__] = Query(run, sql.strip() if sql else None, covers)
        return fn

    return register
