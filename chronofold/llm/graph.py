"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.scratch import Scratch


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``class``, the smallest node of its component, for every node of an edge.

    Labels fall to the smallest neighbour's and then jump to their label's label until none changes: a component of
    diameter d takes about log d rounds.  Every round is a written table, so the lineage stays short and a lost executor costs
    one round; only the last table stays.  A null node joins nothing.  A node with very many edges is summed in parts before the shuffle.
    """
    tables = Scratch(edges.sparkSession)
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v")
    both = tables.written(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = tables.written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("class")), "labels-0")
    level = 0
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("class").alias("low"))
        low = labels.join(near, "node").select("node", "class", F.least("class", "low").alias("low"))
        roots = labels.select(F.col("node").alias("low"), F.col("class").alias("root"))
        level += 1
        after = tables.written(low.join(roots, "low").select("node", "class", F.least("low", "root").alias("next")), f"labels-{level}")
        changed = after.filter("next != class").limit(1).count()
        labels = after.select("node", F.col("next").alias("class"))
        if not changed:
            tables.drop("edges", *(f"labels-{k}" for k in range(level)))
            return labels


def widened(known: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``class`` after more edges, from the classes so far.

    Edges inside a class add nothing; the others become edges of classes, each once, so that a large class is not walked again.  Nodes that
    were in no class are one of their own."""
    for column in (a, b):
        label = known.select(F.col("node").alias(column), F.col("class").alias(f"_{column}"))
        edges = edges.join(label, column, "left").withColumn(f"_{column}", F.coalesce(f"_{column}", column))
    apart = edges.select(F.col(f"_{a}").alias("a"), F.col(f"_{b}").alias("b")).filter("a != b").distinct()
    more = components(apart)
    moved = known.join(more.select(F.col("node").alias("class"), F.col("class").alias("_to")), "class", "left")
    fresh = more.join(known.select("node"), "node", "left_anti").select("node", "class")
    return moved.select("node", F.coalesce("_to", "class").alias("class")).union(fresh)
