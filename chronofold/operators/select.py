"""Row choice: deduplication, latest record, top rows, limits and splits."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofold.operators.lanes import DEFAULT_MAX_ROWS, Lane


#: Rows that one task sorts or keeps in memory where an operator deals them itself.
ROWS_IN_TASK = 1_000_000


def dealt(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """``rows`` rows dealt by a hash of the columns to tasks of some :data:`ROWS_IN_TASK`; as they are if they fit into one.

    What a task holds then depends neither on the size of files nor on how adaptive execution merges partitions."""
    if rows <= ROWS_IN_TASK:
        return df
    # Spark hashes no maps and no variants.
    hashed = [c for c in columns if not re.search(r"\b(map<|variant)", df.schema[c].dataType.simpleString())]
    return df.repartition(max(-(-rows // ROWS_IN_TASK), df.sparkSession.sparkContext.defaultParallelism), *hashed)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int = 1) -> DataFrame:
    """First ``count`` rows of each key in ``order``, which must be total.

    Spark plans the rank filter as a group limit below the exchange, so each map task forwards at
    most ``count`` rows of a key and a hot key never meets in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= count).drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """First-wins deduplication in ``ordinal`` order."""
    return top_per_key(df, keys, [F.col(ordinal).asc()])


def last_per_key(df: DataFrame, keys: Sequence[str], *ordinals: str) -> DataFrame:
    """Last-wins deduplication in ``ordinals`` order; also 'latest record per key'."""
    return top_per_key(df, keys, [F.col(o).desc_nulls_last() for o in ordinals])


def filled_key(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither null nor empty."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != ""))


def first_valid(df: DataFrame, valid: Column, order: Sequence[Column], count: int) -> DataFrame:
    """At most ``count`` rows that satisfy ``valid``; invalid rows do not use up the count."""
    return df.where(valid).orderBy(*order).limit(count)


def shuffled(df: DataFrame, *keys: str, seed: int = 42) -> DataFrame:
    """Rows in a reproducible pseudo-random order."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys)


def stratified_split(
    df: DataFrame,
    *,
    label: str,
    group: str,
    order: str | None = None,
    seed: int = 42,
    name: str = "split",
    max_rows: int = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Mark each row 'train' or 'test', one fold of ``k`` going to test per label.

    ``k`` is the number of groups of the rarest label, so every label reaches the test side.  Groups
    are numbered per label in hash order (or by the numeric ``order`` column); a label that holds
    most groups is numbered in slices, see :class:`Lane`.  All rows of a group share its side.  A rarest label
    with fewer than two groups cannot be split and raises when the plan runs.
    """
    chosen = [F.col(label), F.col(group)] + ([F.col(order)] if order else [])
    groups = df.select(*chosen).dropDuplicates([label, group])
    position = order or "_hash"
    if order is None:
        groups = groups.withColumn("_hash", F.xxhash64(F.lit(seed), F.col(group)))
    lane = Lane([label], [position, group], max_rows=max_rows)
    numbered = lane.number(groups, "_n")
    folds = groups.groupBy(label).count().agg(F.min("count").alias("_k"))
    folds = folds.select(
        F.when(F.col("_k") >= 2, F.col("_k"))
        .otherwise(F.raise_error(F.lit("the rarest label has fewer than two groups")).cast("long"))
        .alias("_k")
    )
    in_test = (F.col("_n") - 1) % folds.scalar() == 0
    side = F.when(in_test, "test").otherwise("train").alias(name)
    sides = numbered.select(F.col(label).alias("_label"), F.col(group).alias("_group"), side)
    # A null label is a label of its own, a null group a group.
    same = df[label].eqNullSafe(F.col("_label")) & df[group].eqNullSafe(F.col("_group"))
    return df.join(sides, same).drop("_label", "_group")


def smallest_stratum(df: DataFrame, label: str) -> DataFrame:
    """One row: the count of the rarest label."""
    return df.groupBy(label).count().agg(F.min("count").alias("smallest"))


def hash_split(df: DataFrame, *keys: str, fraction: float = 0.2, seed: int = 42, name: str = "split") -> DataFrame:
    """Reproducible train/test mark: ``fraction`` of the hash range of the keys goes to test."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(10_000))
    return df.withColumn(name, F.when(bucket < int(fraction * 10_000), "test").otherwise("train"))
