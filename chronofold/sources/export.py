"""Publishing tables as Parquet folders with a manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation


@dataclass(frozen=True)
class ExportSpec:
    """A published dataset: its tables with a one-line description each."""

    slug: str
    title: str
    license: str
    tables: Mapping[str, str]
    keys: Mapping[str, str] = field(default_factory=dict)
    split: str = "train"


def export_of(slug: str, title: str, license: str, keys: Mapping[str, str], split: str = "train") -> ExportSpec:
    """Descriptor of tables given with their keys; the descriptions state the keys."""
    tables = {name: f"{name.replace('_', ' ').capitalize()}, keyed by {key}." for name, key in keys.items()}
    return ExportSpec(slug, title, license, tables, keys, split)


ENTITY_EXPORT = export_of(
    "esports_entities", "Names and whom they stand for", "cc-by-sa-3.0",
    {"public_figures": "person_id", "teams": "team_id", "entity_aliases": "alias, entity_id, entity_type"},
)
MATCH_EXPORT = export_of(
    "esports_matches", "Series and their games", "cc-by-sa-3.0", {"games": "game_id", "tournaments": "tournament_id", "matches": "match_id"}
)


def store_splits(df: DataFrame, path: str, by: Sequence[str] = ("split", "region"),
                 rows_per_file: int = 1_000_000, mode: str = "overwrite") -> None:
    """Write all splits and regions in one job, one folder each.

    The rebalance hint lets adaptive execution divide a folder that holds most rows.
    """
    (df.hint("rebalance", *by).write.mode(mode).option("maxRecordsPerFile", rows_per_file)
       .partitionBy(*by).parquet(path))


def split_manifest(df: DataFrame, by: Sequence[str] = ("split", "region")) -> DataFrame:
    """Rows per published configuration, named ``{split}_{region}``."""
    name = F.concat_ws("_", *by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count")).select(
        name.alias("config"), *by, "row_count"
    )


def export_tables(spark: SparkSession, spec: ExportSpec, tables: Mapping[str, DataFrame], out: str) -> DataFrame:
    """Write each table to ``out/{table}`` and return the manifest.

    Row counts are observed while writing, without a second pass.
    """
    rows = []
    for table in spec.tables:
        seen = Observation(f"export_{table}")
        counted = tables[table].observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(f"{out}/{table}")
        rows.append((spec.slug, table, spec.split, f"{table}/*.parquet", int(seen.get["rows"])))
    return spark.createDataFrame(rows, "dataset string, config string, split string, path string, row_count bigint")
