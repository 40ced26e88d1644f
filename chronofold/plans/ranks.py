"""Ladder pages into the player-rank fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.values import epoch_seconds, or_default, safe_ratio
from chronofold.operators.grids import leftovers_or_fail, missing
from chronofold.operators.select import dealt, last_per_key
from chronofold.session import written
from chronofold.sources.landing import flatten_entries
from chronofold.sources.tables import TableSpec, TableStore, struct

# Columns of the fact table.
PLAYER_RANK_COLUMNS = {
    "puuid": "string", "timestamp": "timestamp", "server": "string", "league_id": "string",
    "tier": "string", "division": "string", "rank": "string", "league_points": "integer",
    "games_played": "integer", "wins": "integer", "losses": "integer", "win_rate": "float",
    "fresh_blood": "boolean", "hot_streak": "boolean", "inactive": "boolean", "veteran": "boolean",
}


def player_rank_spec() -> TableSpec:
    """The fact table: one folder per server and day, players together, latest first."""
    return TableSpec(
        schema=struct(PLAYER_RANK_COLUMNS),
        keys=("puuid", "timestamp"),
        partition_by=("server", "timestamp_day"),
        sort_by=(("server", False), ("puuid", False), ("timestamp", True)),
        derived={"timestamp_day": F.to_date("timestamp")},
    )


def ladder_batch(
    regular: DataFrame, elite: DataFrame | None, fetched_at: Column, unit: Sequence[str] = ("day", "server", "tier", "division")
) -> DataFrame:
    """Entries of regular and elite pages, the latest per unit of work and player.

    Elite pages nest their entries; an entry's own fields win over the page's.  Players move
    between pages while the ladder is read, hence the deduplication.
    """
    rows = regular.withColumn("timestamp", fetched_at)
    if elite is not None:
        rows = rows.unionByName(flatten_entries(elite).withColumn("timestamp", fetched_at), allowMissingColumns=True)
    # A player's entries may be many, so they are dealt by all they hold and meet only after each task has kept its latest.
    return last_per_key(dealt(rows, rows.count(), *rows.columns), [*unit, "puuid"], "timestamp", "leagueId", "leaguePoints", "wins", "losses")


def clean_ranks(raw: DataFrame) -> DataFrame:
    """Typed, defaulted and renamed ladder entries.

    ``server`` and ``division`` come from the landing path.
    """
    games = or_default(F.col("wins"), 0) + or_default(F.col("losses"), 0)
    return raw.withColumns(
        {
            "games_played": games,
            "win_rate": safe_ratio(or_default(F.col("wins"), 0), games).cast("float"),
            "timestamp": epoch_seconds(F.col("timestamp")),
            "fresh_blood": or_default(F.col("freshBlood"), False),
            "hot_streak": or_default(F.col("hotStreak"), False),
            "league_id": F.col("leagueId"),
            "league_points": or_default(F.col("leaguePoints"), 0),
        }
    ).withColumn("date", F.to_date("timestamp"))


def in_window(df: DataFrame, start: str, end: str, column: str = "timestamp") -> DataFrame:
    """Rows in the half-open window [start, end)."""
    return df.where((F.col(column) >= F.lit(start).cast("timestamp_ntz")) & (F.col(column) < F.lit(end).cast("timestamp_ntz")))


def clean_partition(store: TableStore, raw: DataFrame, required: DataFrame, server: str, start: str, end: str,
                    table: str = "fact_player_rank") -> None:
    """Clean and upsert what one day and server still lack; raises if a required cell has not landed.

    ``required`` holds the (tier, division) cells of the ladder, ``raw`` the landed entries, of which those of the
    server and of the window [start, end) count.  What has landed is stored before the failure is raised.
    """
    store.create_if_absent(table)
    done = in_window(store.scan(table, server=server), start, end).select("tier", "division").distinct()
    todo = missing(required, done, ["tier", "division"])
    cleaned = clean_ranks(raw.where(F.col("server") == server))
    batch = in_window(cleaned, start, end).join(todo, ["tier", "division"], "left_semi")
    # Written first: the batch is read for the table and for the cells it covers, and the write changes `done`.
    batch = written(batch, "ladder")
    absent = written(missing(todo, batch, ["tier", "division"]), "absent")
    store.write(table, batch, "upsert")
    leftovers_or_fail(absent, ["tier", "division"])
