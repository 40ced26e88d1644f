"""Aggregations that replace pivots and join chains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivoted_counts(
    df: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, Column],
    members: Sequence,
    member: Column | Mapping[str, Column],
) -> DataFrame:
    """Counts per key, one column ``{rule}_{member}`` for every rule and member, zero if none.

    All rules are counted in one conditional aggregation: partial counts are combined before the
    single exchange.  ``member`` may differ per rule (a mapping by rule name).
    """
    who = member if isinstance(member, Mapping) else {name: member for name in rules}
    return df.groupBy(*keys).agg(
        *[
            F.count_if(condition & (who[name] == F.lit(m))).alias(f"{name}_{m}")
            for name, condition in rules.items()
            for m in members
        ]
    )


def pivoted_latest(
    df: DataFrame,
    keys: Sequence[str],
    member: Column,
    members: Sequence,
    values: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """One column ``{value}_{member}``: the value of the member's last row in ``order``.

    The last row is taken whole, so a null in it stays null.
    """
    last = {
        m: F.max_by(F.struct(*values), F.when(member == F.lit(m), F.struct(*order))) for m in members
    }
    wide = df.groupBy(*keys).agg(*[expr.alias(f"_m_{m}") for m, expr in last.items()])
    return wide.select(*keys, *[F.col(f"_m_{m}")[v].alias(f"{v}_{m}") for v in values for m in members])


def last_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each key in ``order``, nulls included; partially aggregated before the exchange."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def reaching(df: DataFrame, keys: Sequence[str], column: str, threshold) -> DataFrame:
    """Keys whose maximum of ``column`` is at least ``threshold``."""
    return df.groupBy(*keys).agg(F.max(column).alias(f"max_{column}")).where(F.col(f"max_{column}") >= threshold)


def most_common(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent non-null value per key, the smallest of ties.

    Counting (key, value) first keeps a hot key spread over its values.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by(value, F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counted.groupBy(*keys).agg(best.alias(value))


def left_join_chain(frames: Sequence[DataFrame], keys: Sequence[str], fill=0) -> DataFrame:
    """Left-join frames on the same keys and fill gaps; for frames that cannot be counted in one
    pass with :func:`pivoted_counts`."""
    return reduce(lambda left, right: left.join(right, [*keys], "left"), frames).na.fill(fill)


def column_counts(df: DataFrame) -> DataFrame:
    """Non-null count of every column, one row."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per distinct value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between the smallest and the largest value, both included; nulls are not counted.

    The bounds come from one aggregate of the column, which the plan takes as a scalar."""
    bounds = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high")).alias("b")).scalar()
    low, width = bounds["low"], bounds["high"] - bounds["low"]
    slot = F.when(width == 0, 1).otherwise(F.least(F.floor((F.col(column) - low) * bins / width) + 1, F.lit(bins)))
    return df.where(F.col(column).isNotNull()).groupBy(slot.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
