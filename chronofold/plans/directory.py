"""Wiki snapshots into the directory tables: people, teams, games, tournaments, matches, aliases.

The wiki's name and base address are arguments; nothing else about it is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.text import blank_to_null, comma_list, first_filled, page_url, yes_no
from chronofold.operators.select import filled_key, first_per_key, last_per_key
from chronofold.sources.landing import read_snapshot
from chronofold.sources.tables import TableSpec, TableStore, struct

ORDINAL = "_ordinal"

# Fields of the landed snapshots.  Anything else in the files is ignored on reading.
SNAPSHOT_FIELDS = {
    "players": ("OverviewPage", "ID", "Name", "NameAlphabet", "NativeName", "Country", "NationalityPrimary",
                "Role", "IsRetired"),
    "player_redirects": ("AllName", "OverviewPage"),
    "teams": ("PageName", "Name", "Short", "Location", "Region", "IsDisbanded"),
    "scoreboard_games": ("GameId", "MatchId", "OverviewPage", "Tournament", "Team1", "Team2", "WinTeam",
                         "DateTime UTC", "Patch", "Team1Picks", "Team2Picks", "Team1Bans", "Team2Bans",
                         "Gamelength", "N GameInMatch", "RiotPlatformGameId", "VOD"),
    "tournaments": ("OverviewPage", "Name", "League", "Region", "Split", "Year", "TournamentLevel", "DateStart",
                    "Date"),
    "match_schedule": ("MatchId", "OverviewPage", "Tab", "Team1", "Team2", "Team1Score", "Team2Score", "Winner",
                       "BestOf", "DateTime UTC"),
}

# Columns of the clean tables, required ones first in each declaration.
CLEAN_SPECS = {
    "public_figures": TableSpec(
        struct(
            {"person_id": "string", "canonical_name": "string", "display_name": "string", "source": "string",
             "source_url": "string"},
            {"role": "string", "region": "string", "active_from": "date", "active_to": "date",
             "is_retired": "string"},
            ("person_id", "canonical_name", "display_name", "role", "region", "active_from", "active_to",
             "is_retired", "source", "source_url"),
        ),
        keys=("person_id",),
    ),
    "teams": TableSpec(
        struct(
            {"team_id": "string", "canonical_name": "string", "source": "string", "source_url": "string"},
            {"long_name": "string", "region": "string", "location": "string", "active_from": "date",
             "active_to": "date", "is_disbanded": "string"},
            ("team_id", "canonical_name", "long_name", "region", "location", "active_from", "active_to",
             "is_disbanded", "source", "source_url"),
        ),
        keys=("team_id",),
    ),
    "games": TableSpec(
        struct(
            {"game_id": "string"},
            {"match_id": "string", "tournament": "string", "game_number": "string", "datetime_utc": "string",
             "patch": "string", "team_blue": "string", "team_red": "string", "winner": "string",
             "picks_blue": "list<string>", "picks_red": "list<string>", "bans_blue": "list<string>",
             "bans_red": "list<string>", "gamelength": "string", "riot_game_id": "string", "vod": "string",
             "source_url": "string"},
        ),
        keys=("game_id",),
    ),
    "tournaments": TableSpec(
        struct(
            {"tournament_id": "string"},
            {"name": "string", "league": "string", "region": "string", "split": "string", "year": "string",
             "tier": "string", "date_start": "string", "date_end": "string", "source_url": "string"},
        ),
        keys=("tournament_id",),
    ),
    "matches": TableSpec(
        struct(
            {"match_id": "string"},
            {"tournament": "string", "tab": "string", "team1": "string", "team2": "string",
             "team1_score": "string", "team2_score": "string", "winner": "string", "best_of": "string",
             "datetime_utc": "string", "source_url": "string"},
        ),
        keys=("match_id",),
    ),
    "entity_aliases": TableSpec(
        struct({"alias": "string", "entity_id": "string", "entity_type": "string", "alias_type": "string"}),
        keys=("alias", "entity_id", "entity_type"),
    ),
}


@dataclass(frozen=True)
class Wiki:
    """Where a snapshot came from."""

    name: str
    base_url: str


def snapshot_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in SNAPSHOT_FIELDS[table]])


def build_figures(players: DataFrame, wiki: Wiki) -> DataFrame:
    """One row per person, the first record of each page key."""
    key = F.col("OverviewPage")
    return first_per_key(players, ["OverviewPage"], ORDINAL).select(
        key.alias("person_id"),
        F.coalesce(first_filled(F.col("Name"), F.col("ID")), key).alias("canonical_name"),
        F.coalesce(blank_to_null(F.col("ID")), key).alias("display_name"),
        F.col("Role").alias("role"),
        F.coalesce(blank_to_null(F.col("NationalityPrimary")), F.col("Country")).alias("region"),
        F.lit(None).cast("date").alias("active_from"),
        F.lit(None).cast("date").alias("active_to"),
        yes_no(F.col("IsRetired")).alias("is_retired"),
        F.lit(wiki.name).alias("source"),
        page_url(wiki.base_url, key).alias("source_url"),
    )


def build_teams(teams: DataFrame, wiki: Wiki) -> DataFrame:
    """One row per organisation, the first record of each page key."""
    key = F.col("PageName")
    return first_per_key(teams, ["PageName"], ORDINAL).select(
        key.alias("team_id"),
        F.coalesce(first_filled(F.col("Name"), F.col("Short")), key).alias("canonical_name"),
        F.lit(None).cast("string").alias("long_name"),
        F.col("Region").alias("region"),
        F.col("Location").alias("location"),
        F.lit(None).cast("date").alias("active_from"),
        F.lit(None).cast("date").alias("active_to"),
        yes_no(F.col("IsDisbanded")).alias("is_disbanded"),
        F.lit(wiki.name).alias("source"),
        page_url(wiki.base_url, key).alias("source_url"),
    )


def _tournament_url(wiki: Wiki) -> Column:
    return page_url(wiki.base_url, blank_to_null(F.col("OverviewPage"))).alias("source_url")


def build_games(games: DataFrame, wiki: Wiki) -> DataFrame:
    """One row per game; team 1 is the blue side."""
    return first_per_key(filled_key(games, "GameId"), ["GameId"], ORDINAL).select(
        F.col("GameId").alias("game_id"),
        F.col("MatchId").alias("match_id"),
        F.col("OverviewPage").alias("tournament"),
        F.col("`N GameInMatch`").alias("game_number"),
        F.col("`DateTime UTC`").alias("datetime_utc"),
        F.col("Patch").alias("patch"),
        F.col("Team1").alias("team_blue"),
        F.col("Team2").alias("team_red"),
        F.col("WinTeam").alias("winner"),
        comma_list(F.col("Team1Picks")).alias("picks_blue"),
        comma_list(F.col("Team2Picks")).alias("picks_red"),
        comma_list(F.col("Team1Bans")).alias("bans_blue"),
        comma_list(F.col("Team2Bans")).alias("bans_red"),
        F.col("Gamelength").alias("gamelength"),
        F.col("RiotPlatformGameId").alias("riot_game_id"),
        F.col("VOD").alias("vod"),
        _tournament_url(wiki),
    )


def build_tournaments(tournaments: DataFrame, wiki: Wiki) -> DataFrame:
    return first_per_key(filled_key(tournaments, "OverviewPage"), ["OverviewPage"], ORDINAL).select(
        F.col("OverviewPage").alias("tournament_id"),
        F.col("Name").alias("name"),
        F.col("League").alias("league"),
        F.col("Region").alias("region"),
        F.col("Split").alias("split"),
        F.col("Year").alias("year"),
        F.col("TournamentLevel").alias("tier"),
        F.col("DateStart").alias("date_start"),
        F.col("Date").alias("date_end"),
        _tournament_url(wiki),
    )


def build_matches(matches: DataFrame, wiki: Wiki) -> DataFrame:
    """One row per series."""
    return first_per_key(filled_key(matches, "MatchId"), ["MatchId"], ORDINAL).select(
        F.col("MatchId").alias("match_id"),
        F.col("OverviewPage").alias("tournament"),
        F.col("Tab").alias("tab"),
        F.col("Team1").alias("team1"),
        F.col("Team2").alias("team2"),
        F.col("Team1Score").alias("team1_score"),
        F.col("Team2Score").alias("team2_score"),
        F.col("Winner").alias("winner"),
        F.col("BestOf").alias("best_of"),
        F.col("`DateTime UTC`").alias("datetime_utc"),
        _tournament_url(wiki),
    )


def _alias_rows(df: DataFrame, source: int, entity: Column, entity_type: str, names: list[tuple[Column, str]]) -> DataFrame:
    """One row per usable name.  ``_source, ordinal, _position`` is the order of appearance."""
    options = F.array(*[
        F.struct(name.alias("alias"), F.lit(kind).alias("alias_type"), F.lit(i).alias("_position"))
        for i, (name, kind) in enumerate(names)
    ])
    usable = F.filter(options, lambda o: o["alias"].isNotNull() & (o["alias"] != ""))
    return df.select(
        entity.alias("entity_id"), F.lit(entity_type).alias("entity_type"), F.lit(source).alias("_source"),
        ORDINAL, F.inline(usable),
    )


def person_aliases(players: DataFrame, redirects: DataFrame) -> DataFrame:
    """Names of people: page key, handle, real name, romanisations and redirects."""
    own = _alias_rows(players, 0, F.col("OverviewPage"), "person", [
        (F.col("OverviewPage"), "canonical"), (F.col("ID"), "ign"), (F.col("Name"), "real_name"),
        (F.col("NameAlphabet"), "romanization"), (F.col("NativeName"), "romanization"),
    ])
    other = _alias_rows(filled_key(redirects, "OverviewPage"), 1, F.col("OverviewPage"), "person",
                        [(F.col("AllName"), "other")])
    return own.unionByName(other)


def team_aliases(teams: DataFrame) -> DataFrame:
    """Names of teams: page key, name and a short form that differs from it."""
    differs = F.when(~F.col("Short").eqNullSafe(F.col("Name")), F.col("Short"))
    return _alias_rows(teams, 2, F.col("PageName"), "team", [
        (F.col("PageName"), "canonical"), (F.col("Name"), "short"), (differs, "short"),
    ])


def build_aliases(players: DataFrame, redirects: DataFrame, teams: DataFrame) -> DataFrame:
    """Alias index of people and teams.  Of equal (alias, entity, type) the last one stated wins."""
    stated = person_aliases(players, redirects).unionByName(team_aliases(teams))
    kept = last_per_key(stated, ["alias", "entity_id", "entity_type"], "_source", ORDINAL, "_position")
    return kept.select("alias", "entity_id", "entity_type", "alias_type")


def resolve_alias(names: DataFrame, aliases: DataFrame, figures: DataFrame, teams: DataFrame, *, name: str = "name") -> DataFrame:
    """Every entity a name may stand for, with its canonical name (one-to-many)."""
    entities = figures.select(
        F.lit("person").alias("entity_type"), F.col("person_id").alias("entity_id"), "canonical_name"
    ).unionByName(
        teams.select(F.lit("team").alias("entity_type"), F.col("team_id").alias("entity_id"), "canonical_name")
    )
    hits = names.join(aliases.withColumnRenamed("alias", name), name)
    return hits.join(entities, ["entity_type", "entity_id"])


def catalogue(games: DataFrame, matches: DataFrame, tournaments: DataFrame) -> DataFrame:
    """Games with their series and tournament."""
    series = matches.select("match_id", "tab", "best_of", F.col("winner").alias("series_winner"))
    events = tournaments.select(F.col("tournament_id").alias("tournament"), "name", "league", "split", "year")
    return games.join(series, "match_id").join(events, "tournament")


_SOURCES = {
    "public_figures": ("players",), "teams": ("teams",), "games": ("scoreboard_games",),
    "tournaments": ("tournaments",), "matches": ("match_schedule",),
    "entity_aliases": ("players", "player_redirects", "teams"),
}
_BUILDERS = {
    "public_figures": build_figures, "teams": build_teams, "games": build_games,
    "tournaments": build_tournaments, "matches": build_matches,
}


def week_path(root: str, table: str, week: str) -> str:
    """Folder of a landed weekly snapshot; ``week`` is its first day (yyyy-MM-dd)."""
    year, month, day = week.split("-")
    return f"{root}/{table}/year={int(year)}/month={int(month)}/week_of={year}{month}{day}"


def build_clean(spark: SparkSession, landing: str, store: TableStore, table: str, week: str, wiki: Wiki) -> DataFrame:
    """Rebuild one clean table from a week's snapshots; returns the table."""
    raw = [
        read_snapshot(spark, week_path(landing, source, week), snapshot_schema(source), ORDINAL)
        for source in _SOURCES[table]
    ]
    rows = build_aliases(*raw) if table == "entity_aliases" else _BUILDERS[table](raw[0], wiki)
    store.write(table, rows, "overwrite")
    return store.scan(table)


