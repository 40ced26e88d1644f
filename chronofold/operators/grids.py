"""Required-work grids and what is still missing from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ladder tiers, elite tiers (which only have division I) and divisions.
TIERS = ("IRON", "BRONZE", "SILVER", "GOLD", "PLATINUM", "EMERALD", "DIAMOND")
ELITE_TIERS = ("MASTER", "GRANDMASTER", "CHALLENGER")
DIVISIONS = ("I", "II", "III", "IV")

# Servers by region.
SERVERS = {
    "americas": ("br1", "la1", "la2", "na1"),
    "asia": ("jp1", "kr", "oc1", "sg2", "tw2", "vn2"),
    "europe": ("eun1", "euw1", "me1", "ru", "tr1"),
}


def expand(df: DataFrame, **values: Sequence) -> DataFrame:
    """Every row once per combination of the given value lists.

    The lists are literals, so the rows multiply by a factor known when the plan is written.
    """
    for name, items in values.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(i) for i in items])))
    return df


def rank_cells(spark: SparkSession) -> DataFrame:
    """Every (tier, division) of the ladder."""
    one = spark.range(1)
    regular = expand(one, tier=TIERS, division=DIVISIONS)
    elite = expand(one, tier=ELITE_TIERS, division=DIVISIONS[:1])
    return regular.unionByName(elite).drop("id")


def servers(spark: SparkSession) -> DataFrame:
    """Every server with its region."""
    regions = F.create_map(*[x for r, names in SERVERS.items() for s in names for x in (F.lit(s), F.lit(r))])
    return spark.range(1).select(F.explode(regions).alias("server", "region"))


def rank_grid(spark: SparkSession, days: Sequence[str]) -> DataFrame:
    """Work units of a daily ladder run: day x server x (tier, division)."""
    server_names = [s for names in SERVERS.values() for s in names]
    return expand(rank_cells(spark), day=days, server=server_names)


def missing(required: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Required combinations without a present row."""
    return required.join(present.select(*keys).distinct(), [*keys], "left_anti")


def in_all(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Keys present in every table, from one grouped pass over their union."""
    tagged = None
    for number, table in enumerate(tables):
        part = table.select(*keys, F.lit(1 << number).alias("_seen"))
        tagged = part if tagged is None else tagged.unionByName(part)
    complete = (1 << len(tables)) - 1
    return tagged.groupBy(*keys).agg(F.bit_or("_seen").alias("_seen")).where(F.col("_seen") == complete).drop("_seen")


def leftovers_or_fail(leftover: DataFrame, keys: Sequence[str], limit: int = 20) -> None:
    """Raise with the first few combinations that are still missing; the completeness check at
    the end of a run."""
    some = leftover.select(*keys).orderBy(*keys).limit(limit).collect()
    if some:
        raise ValueError(f"missing combinations, for example: {[tuple(r) for r in some]}")
