"""Queries on directories, aliases and ladders, fed by customers, suppliers and nations."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.text import page_url
from chronofold.operators.counts import most_common
from chronofold.operators.grids import rank_cells
from chronofold.plans.directory import (
    CLEAN_SPECS, SNAPSHOT_FIELDS, Wiki, build_aliases, build_clean, build_figures, build_games, build_matches, build_teams, build_tournaments,
    catalogue, resolve_alias, week_path,
)
from chronofold.plans.grounding import build_candidates, expand_aliases
from chronofold.plans.ranks import clean_partition, clean_ranks, in_window, ladder_batch, player_rank_spec
from chronofold.suite.base import REGISTRY, Tables, query
from chronofold.suite.stores import store_for

WIKI = Wiki("wiki", "https://wiki.example.org/")


def players(t: Tables) -> DataFrame:
    """Customers as person records, several of them per page (the nation's name)."""
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat("n_name", F.lit(" "), "c_mktsegment").alias("OverviewPage"),
        F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_name")).alias("ID"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("Real "), "c_name")).alias("Name"),
        F.when(F.col("c_custkey") % 5 == 0, F.col("c_name")).alias("NameAlphabet"),
        F.lit(None).cast("string").alias("NativeName"),
        F.col("n_name").alias("Country"),
        F.when(F.col("c_custkey") % 2 == 0, F.lower("n_name")).otherwise("").alias("NationalityPrimary"),
        F.col("c_mktsegment").alias("Role"),
        F.when(F.col("c_acctbal") < 0, "1").when(F.col("c_acctbal") < 5000, " Yes ").otherwise("0").alias("IsRetired"),
        F.col("c_custkey").alias("_ordinal"),
    )


_PLAYERS = """
WITH players AS (
  SELECT n_name || ' ' || c_mktsegment AS page, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name END AS id,
    CASE WHEN c_custkey % 3 = 0 THEN 'Real ' || c_name END AS name, CASE WHEN c_custkey % 5 = 0 THEN c_name END AS alphabet,
    n_name AS country, CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) ELSE '' END AS nationality, c_mktsegment AS role,
    c_acctbal < 5000 AS retired, c_custkey AS ordinal
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


@query("P16 H1 H2 H3 W1", _PLAYERS + """
SELECT page AS person_id, coalesce(nullif(name, ''), nullif(id, ''), page) AS canonical_name, coalesce(nullif(id, ''), page) AS display_name,
  role, coalesce(nullif(nationality, ''), country) AS region, CASE WHEN retired THEN 'Yes' ELSE 'No' END AS is_retired,
  'wiki' AS source, 'https://wiki.example.org/' || replace(page, ' ', '_') AS source_url
FROM players QUALIFY row_number() OVER (PARTITION BY page ORDER BY ordinal) = 1
""")
def public_figures(t: Tables) -> DataFrame:
    """First record of every person page."""
    return build_figures(players(t), WIKI).drop("active_from", "active_to")


def team_records(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("PageName"),
        F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).alias("Name"),
        F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise(F.substring("n_name", 1, 3)).alias("Short"),
        F.lit(None).cast("string").alias("Location"), F.col("n_regionkey").cast("string").alias("Region"),
        F.when(F.col("s_acctbal") < 0, "TRUE").otherwise("no").alias("IsDisbanded"), F.col("s_suppkey").alias("_ordinal"),
    )


_TEAMS = """
team_records AS (
  SELECT n_name AS page, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS name,
    CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE substr(n_name, 1, 3) END AS short, n_regionkey::VARCHAR AS region,
    s_acctbal < 0 AS disbanded, s_suppkey AS ordinal
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""


@query("P17 H2 W1", "WITH " + _TEAMS + """
SELECT page AS team_id, coalesce(nullif(name, ''), nullif(short, ''), page) AS canonical_name, region,
  CASE WHEN disbanded THEN 'Yes' ELSE 'No' END AS is_disbanded, 'https://wiki.example.org/' || replace(page, ' ', '_') AS source_url
FROM team_records QUALIFY row_number() OVER (PARTITION BY page ORDER BY ordinal) = 1
""")
def teams(t: Tables) -> DataFrame:
    """First record of every team page."""
    return build_teams(team_records(t), WIKI).select("team_id", "canonical_name", "region", "is_disbanded", "source_url")


def redirects(t: Tables) -> DataFrame:
    return players(t).where("Role = 'BUILDING'").select(
        F.col("ID").alias("AllName"), F.when(F.col("_ordinal") % 7 > 0, F.col("OverviewPage")).alias("OverviewPage"), "_ordinal")


@query("N10 N11 N12 W2 U4", _PLAYERS + ", " + _TEAMS + """
, stated AS (
  SELECT page AS alias, page AS entity_id, 'person' AS entity_type, 'canonical' AS alias_type, 0 AS source, ordinal, 0 AS pos FROM players
  UNION ALL SELECT id, page, 'person', 'ign', 0, ordinal, 1 FROM players
  UNION ALL SELECT name, page, 'person', 'real_name', 0, ordinal, 2 FROM players
  UNION ALL SELECT alphabet, page, 'person', 'romanization', 0, ordinal, 3 FROM players
  UNION ALL SELECT id, CASE WHEN ordinal % 7 > 0 THEN page END, 'person', 'other', 1, ordinal, 0 FROM players WHERE role = 'BUILDING'
  UNION ALL SELECT page, page, 'team', 'canonical', 2, ordinal, 0 FROM team_records
  UNION ALL SELECT name, page, 'team', 'short', 2, ordinal, 1 FROM team_records
  UNION ALL SELECT short, page, 'team', 'short', 2, ordinal, 2 FROM team_records WHERE short IS DISTINCT FROM name)
SELECT alias, entity_id, entity_type, alias_type FROM stated WHERE alias <> '' AND entity_id <> ''
QUALIFY row_number() OVER (PARTITION BY alias, entity_id, entity_type ORDER BY source DESC, ordinal DESC, pos DESC) = 1
""")
def entity_aliases(t: Tables) -> DataFrame:
    """Every name with the entity it stands for, the last statement winning."""
    return build_aliases(players(t), redirects(t), team_records(t))


@query("J20", "WITH " + _PLAYERS.split("WITH", 1)[1] + ", " + _TEAMS + """
, stated AS (
  SELECT page AS alias, page AS entity_id, 'person' AS entity_type FROM players UNION SELECT id, page, 'person' FROM players
  UNION SELECT name, page, 'person' FROM players UNION SELECT alphabet, page, 'person' FROM players
  UNION SELECT id, CASE WHEN ordinal % 7 > 0 THEN page END, 'person' FROM players WHERE role = 'BUILDING'
  UNION SELECT page, page, 'team' FROM team_records UNION SELECT name, page, 'team' FROM team_records UNION SELECT short, page, 'team' FROM team_records),
entities AS (
  SELECT * FROM (SELECT 'person' AS entity_type, page AS entity_id, coalesce(nullif(name, ''), nullif(id, ''), page) AS canonical_name FROM players
    QUALIFY row_number() OVER (PARTITION BY page ORDER BY ordinal) = 1)
  UNION ALL SELECT * FROM (SELECT 'team', page, coalesce(nullif(name, ''), nullif(short, ''), page) FROM team_records
    QUALIFY row_number() OVER (PARTITION BY page ORDER BY ordinal) = 1)),
names AS (SELECT id AS name FROM players WHERE id <> '' UNION SELECT short FROM team_records WHERE short <> '')
SELECT n.name, e.entity_type, e.entity_id, e.canonical_name
FROM names n JOIN stated s ON s.alias = n.name AND s.entity_id <> '' JOIN entities e ON e.entity_type = s.entity_type AND e.entity_id = s.entity_id
""")
def resolved_names(t: Tables) -> DataFrame:
    """Handles and short team names looked up in the alias index and joined to whom they stand for."""
    people, records = players(t), team_records(t)
    names = people.select(F.col("ID").alias("name")).union(records.select("Short")).where("name <> ''").distinct()
    found = resolve_alias(names, build_aliases(people, redirects(t), records), build_figures(people, WIKI), build_teams(records, WIKI))
    return found.select("name", "entity_type", "entity_id", "canonical_name")


def game_records(t: Tables) -> DataFrame:
    o = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    return t.orders.select(
        F.when(o % 10 > 0, text(F.floor(o / 2))).otherwise("").alias("GameId"), text(F.floor(o / 6)).alias("MatchId"),
        F.when(o % 4 > 0, F.concat("o_orderpriority", F.lit("/"), text(F.year("o_orderdate")))).alias("OverviewPage"),
        F.lit("x").alias("Tournament"), F.col("o_orderpriority").alias("Team1"), F.col("o_orderstatus").alias("Team2"),
        F.lit("1").alias("WinTeam"), text(F.to_date("o_orderdate")).alias("DateTime UTC"),
        F.when(o % 5 > 0, F.concat(F.lit("14."), text(o % 3))).alias("Patch"),
        F.concat(text(o), F.lit(",,"), text(o + 1)).alias("Team1Picks"), F.lit("").alias("Team2Picks"),
        F.lit(None).cast("string").alias("Team1Bans"), F.lit("a").alias("Team2Bans"), F.lit("30:00").alias("Gamelength"),
        text(o % 6 + 1).alias("N GameInMatch"), F.lit(None).cast("string").alias("RiotPlatformGameId"),
        F.lit(None).cast("string").alias("VOD"), o.alias("_ordinal"),
    )


_GAMES = """
WITH records AS (
  SELECT CASE WHEN o_orderkey % 10 > 0 THEN (o_orderkey // 2)::VARCHAR ELSE '' END AS game_id, (o_orderkey // 6)::VARCHAR AS match_id,
    CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority || '/' || year(o_orderdate) END AS tournament, o_orderpriority AS team_blue,
    (o_orderkey % 6 + 1)::VARCHAR AS game_number, CASE WHEN o_orderkey % 5 > 0 THEN '14.' || (o_orderkey % 3) END AS patch,
    o_orderkey || '|' || (o_orderkey + 1) AS picks_blue, o_orderkey AS ordinal, o_orderstatus AS team_red
  FROM orders),
games AS (SELECT * FROM records WHERE game_id <> '' QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY ordinal) = 1)
"""


@query("P18 P21 H9", _GAMES + """
SELECT game_id, match_id, tournament, game_number, patch, team_blue, picks_blue, NULL::VARCHAR AS picks_red, NULL::VARCHAR AS bans_blue,
  'a' AS bans_red, 'https://wiki.example.org/' || replace(tournament, ' ', '_') AS source_url FROM games
""")
def games(t: Tables) -> DataFrame:
    """First record of every game with its lists split."""
    built = build_games(game_records(t), WIKI)
    listed = lambda c: F.array_join(c, "|").alias(c)
    return built.select("game_id", "match_id", "tournament", "game_number", "patch", "team_blue", listed("picks_blue"),
                        listed("picks_red"), listed("bans_blue"), listed("bans_red"), "source_url")


def tournament_records(t: Tables) -> DataFrame:
    text = lambda c: c.cast("string")
    return t.orders.select(
        F.concat("o_orderpriority", F.lit("/"), text(F.year("o_orderdate"))).alias("OverviewPage"),
        F.concat(F.lit("Cup "), "o_orderpriority").alias("Name"), F.col("o_orderstatus").alias("League"),
        F.lit("EU").alias("Region"), F.lit(None).cast("string").alias("Split"), text(F.year("o_orderdate")).alias("Year"),
        F.lit("Primary").alias("TournamentLevel"), F.lit(None).cast("string").alias("DateStart"), text(F.to_date("o_orderdate")).alias("Date"),
        F.col("o_orderkey").alias("_ordinal"))


_TOURNAMENTS = """
tournaments AS (
  SELECT o_orderpriority || '/' || year(o_orderdate) AS tournament_id, 'Cup ' || o_orderpriority AS name, o_orderstatus AS league,
    year(o_orderdate)::VARCHAR AS year, 'Primary' AS tier, o_orderdate::DATE::VARCHAR AS date_end
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority || '/' || year(o_orderdate) ORDER BY o_orderkey) = 1)
"""


@query("P19", "WITH " + _TOURNAMENTS + "SELECT * FROM tournaments")
def tournaments(t: Tables) -> DataFrame:
    return build_tournaments(tournament_records(t), WIKI).select("tournament_id", "name", "league", "year", "tier", "date_end")


def match_records(t: Tables) -> DataFrame:
    o = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    return t.orders.select(
        text(F.floor(o / 6)).alias("MatchId"), F.concat("o_orderpriority", F.lit("/"), text(F.year("o_orderdate"))).alias("OverviewPage"),
        F.lit("Week 1").alias("Tab"), F.col("o_orderpriority").alias("Team1"), F.col("o_orderstatus").alias("Team2"),
        F.lit("2").alias("Team1Score"), F.lit("1").alias("Team2Score"), F.lit("1").alias("Winner"), F.lit("3").alias("BestOf"),
        text(F.to_date("o_orderdate")).alias("DateTime UTC"), o.alias("_ordinal"))


_MATCHES = """
matches AS (
  SELECT (o_orderkey // 6)::VARCHAR AS match_id, o_orderpriority || '/' || year(o_orderdate) AS tournament, o_orderpriority AS team1,
    o_orderstatus AS team2, '3' AS best_of, o_orderdate::DATE::VARCHAR AS datetime_utc
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey // 6 ORDER BY o_orderkey) = 1)
"""


@query("P20", "WITH " + _MATCHES + "SELECT * FROM matches")
def matches(t: Tables) -> DataFrame:
    return build_matches(match_records(t), WIKI).select("match_id", "tournament", "team1", "team2", "best_of", "datetime_utc")


@query("J21", _GAMES + ", " + _MATCHES + ", " + _TOURNAMENTS + """
SELECT g.game_id, g.match_id, g.patch, m.best_of, tr.name, tr.league, tr.year
FROM games g JOIN matches m USING (match_id) JOIN tournaments tr ON tr.tournament_id = g.tournament
""")
def games_with_series(t: Tables) -> DataFrame:
    """Games joined to their series and tournament."""
    star = catalogue(build_games(game_records(t), WIKI), build_matches(match_records(t), WIKI), build_tournaments(tournament_records(t), WIKI))
    return star.select("game_id", "match_id", "patch", "best_of", "name", "league", "year")


@query("A5", """
SELECT p_brand, p_type FROM (
  SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS rn FROM part GROUP BY 1, 2) WHERE rn = 1
""")
def commonest_type(t: Tables) -> DataFrame:
    """Most frequent part type per brand, the smallest of ties."""
    return most_common(t.part, ["p_brand"], "p_type")


_TEAM_ALIASES = """
names AS (SELECT o_orderpriority AS canonical, o_orderpriority AS alias FROM orders GROUP BY ALL
  UNION SELECT o_orderpriority, substr(o_orderpriority, 3) FROM orders
  UNION SELECT o_orderstatus, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
  UNION SELECT o_orderstatus, lower(o_orderstatus) FROM orders WHERE o_orderstatus <> 'P')
"""


def team_names(t: Tables) -> DataFrame:
    """Alias rows for the priorities and two of the statuses, standing in for teams."""
    named = lambda df, key, alias: df.select(alias.alias("alias"), key.alias("entity_id"))
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    known = t.orders.where("o_orderstatus <> 'P'")
    rows = named(t.orders, priority, priority).unionByName(named(t.orders, priority, F.expr("substr(o_orderpriority, 3)")))
    rows = rows.unionByName(named(known, status, status)).unionByName(named(known, status, F.lower(status)))
    return rows.distinct().withColumn("entity_type", F.lit("team"))


@query("J13", "WITH " + _MATCHES + ", " + _TEAM_ALIASES + """
SELECT m.match_id, a.alias AS team1, b.alias AS team2 FROM matches m JOIN names a ON a.canonical = m.team1 JOIN names b ON b.canonical = m.team2
""")
def matches_by_alias(t: Tables) -> DataFrame:
    """Matches under every pair of names; matches of an unknown team drop out."""
    return expand_aliases(build_matches(match_records(t), WIKI), team_names(t)).select("match_id", "team1", "team2")


@query("N8 A5 J14 J13", _GAMES + ", " + _MATCHES + ", " + _TEAM_ALIASES + """
, patches AS (SELECT match_id, patch FROM (SELECT match_id, patch, row_number() OVER (PARTITION BY match_id ORDER BY count(*) DESC, patch) AS rn
  FROM games WHERE patch IS NOT NULL GROUP BY 1, 2) WHERE rn = 1)
SELECT m.match_id, a.alias AS team1, b.alias AS team2, p.patch
FROM matches m JOIN names a ON a.canonical = m.team1 JOIN names b ON b.canonical = m.team2 LEFT JOIN patches p USING (match_id)
""")
def candidates(t: Tables) -> DataFrame:
    """Candidates for linking: matches with their commonest patch under all names."""
    built = build_candidates(build_matches(match_records(t), WIKI), build_games(game_records(t), WIKI), team_names(t))
    return built.select("match_id", "team1", "team2", "patch")


@query("H1", """
SELECT p_partkey, 'https://wiki.example.org/' || replace(p_name, ' ', '_') || '/' || replace(p_brand, '#', '%23') AS url FROM part
""")
def page_urls(t: Tables) -> DataFrame:
    """Wiki addresses of page names."""
    return t.part.select("p_partkey", page_url(WIKI.base_url, F.concat_ws("/", "p_name", "p_brand")).alias("url"))


# -- ladders ------------------------------------------------------------------------------------


def ladder_pages(t: Tables, *more: Column) -> DataFrame:
    """Orders as ladder entries of their customers, with more columns of the orders."""
    o = F.col("o_orderkey")
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("puuid"), F.lit("L1").alias("leagueId"), F.col("o_orderstatus").alias("rank"),
        F.when(o % 3 > 0, (o % 100).cast("int")).alias("leaguePoints"), F.when(o % 5 > 0, (o % 40).cast("int")).alias("wins"),
        (o % 7).cast("int").alias("losses"), (o % 2 == 0).alias("freshBlood"), F.when(o % 2 == 0, True).alias("hotStreak"),
        F.lit(False).alias("inactive"), F.lit(False).alias("veteran"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("timestamp"), o.alias("_o"), *more)


_LADDER = """
WITH ladder AS (
  SELECT o_custkey::VARCHAR AS puuid, o_orderstatus AS rank, CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 100)::INTEGER END AS points,
    CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 40)::INTEGER END AS wins, (o_orderkey % 7)::INTEGER AS losses,
    CASE WHEN o_orderkey % 2 = 0 THEN true END AS hot, epoch(o_orderdate)::BIGINT AS ts, o_orderkey
  FROM orders)
"""


@query("W3 N14 U2", """
SELECT puuid, day, server, tier, division, points FROM (
  SELECT o_custkey::VARCHAR AS puuid, o_orderdate::DATE AS day, CASE WHEN o_orderkey % 2 = 0 THEN 'kr' ELSE 'na1' END AS server, o_orderstatus AS tier,
    substr(o_orderpriority, 1, 1) AS division, CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 100)::INTEGER END AS points,
    CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 40)::INTEGER END AS wins, (o_orderkey % 7)::INTEGER AS losses
  FROM orders UNION ALL
  SELECT o_custkey::VARCHAR, o_orderdate::DATE, 'kr', o_orderstatus, '9', (o_orderkey % 100)::INTEGER, NULL, 0 FROM orders)
QUALIFY row_number() OVER (PARTITION BY day, server, tier, division, puuid ORDER BY points DESC NULLS LAST, wins DESC NULLS LAST, losses DESC NULLS LAST) = 1
""")
def ladder_latest(t: Tables) -> DataFrame:
    """Regular and elite pages united, the latest entry per day, server, cell and player."""
    o = F.col("_o")
    pages = ladder_pages(t, F.substring("o_orderpriority", 1, 1).alias("division"))
    pages = pages.withColumns({"day": F.to_date(F.timestamp_seconds("timestamp")), "server": F.when(o % 2 == 0, "kr").otherwise("na1"), "tier": F.col("rank")})
    again = pages.withColumns({
        "division": F.lit("9"), "server": F.lit("kr"), "leaguePoints": (o % 100).cast("int"), "wins": F.lit(None).cast("int"), "losses": F.lit(0)})
    pages = pages.unionByName(again).drop("_o")
    regular = pages.where("rank <> 'P'")
    entry = F.struct(*[F.col(c) for c in pages.columns if c != "leagueId"])
    elite = pages.where("rank = 'P'").select("leagueId", F.array(entry).alias("entries"))
    fetched = F.col("timestamp")
    return ladder_batch(regular, elite, fetched).select("puuid", "day", "server", "tier", "division", F.col("leaguePoints").alias("points"))


@query("P14 H4 H5 H13", _LADDER + """
SELECT puuid, o_orderkey AS _o, coalesce(wins, 0) + losses AS games_played, coalesce(points, 0) AS league_points, coalesce(hot, false) AS hot_streak,
  CASE WHEN coalesce(wins, 0) + losses > 0 THEN floor(coalesce(wins, 0) * 10000.0 / (coalesce(wins, 0) + losses) + 1e-6)::BIGINT ELSE 0 END AS win_rate_bp,
  to_timestamp(ts)::TIMESTAMP::DATE AS date
FROM ladder
""")
def ladder_cleaned(t: Tables) -> DataFrame:
    """Typed and defaulted ladder entries."""
    basis_points = F.floor(F.col("wins_") * F.lit(10000.0) / F.col("games_played") + 1e-6)
    rows = clean_ranks(ladder_pages(t)).withColumn("wins_", F.coalesce("wins", F.lit(0)))
    return rows.select(
        "puuid", "_o", "games_played", "league_points", "hot_streak",
        F.when(F.col("games_played") > 0, basis_points).otherwise(0).cast("long").alias("win_rate_bp"), "date")


@query("P15", _LADDER + """
SELECT puuid, o_orderkey AS _o FROM ladder WHERE to_timestamp(ts)::TIMESTAMP >= TIMESTAMP '1995-01-01' AND to_timestamp(ts)::TIMESTAMP < TIMESTAMP '1995-07-01'
""")
def ladder_window(t: Tables) -> DataFrame:
    """Entries of a half-open window."""
    return in_window(clean_ranks(ladder_pages(t)), "1995-01-01", "1995-07-01").select("puuid", "_o")


@query("N15 S13 S16 J10", """
SELECT server, tier, count(*) AS players, sum(wins)::BIGINT AS wins FROM (
  SELECT DISTINCT c_custkey, 'kr' AS server, ['IRON', 'GOLD', 'DIAMOND'][c_nationkey % 3 + 1] AS tier, c_custkey % 50 AS wins
  FROM customer WHERE c_acctbal > 3000) GROUP BY ALL
""")
def ladder_fact_table(t: Tables) -> DataFrame:
    """Fact table after cleaning a server's day twice; the second run finds nothing left to do."""
    c = F.col("c_custkey")
    pick = lambda values, index: F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)
    raw = t.customer.select(
        c.cast("string").alias("puuid"), F.lit("L1").alias("leagueId"), F.when(F.col("c_acctbal") > 3000, "kr").otherwise("na1").alias("server"),
        pick(("IRON", "GOLD", "DIAMOND"), F.col("c_nationkey") % 3).alias("tier"), F.lit("II").alias("division"), F.lit("II").alias("rank"),
        F.lit(10).alias("leaguePoints"), (c % 50).cast("int").alias("wins"), F.lit(3).alias("losses"), F.lit(True).alias("freshBlood"),
        F.lit(None).cast("boolean").alias("hotStreak"), F.lit(False).alias("inactive"), F.lit(False).alias("veteran"),
        F.lit(1_767_229_200).alias("timestamp"))
    store = store_for(t, {"fact_player_rank": player_rank_spec()})
    for _ in range(2):
        cells = rank_cells(t.spark).where("tier IN ('IRON', 'GOLD', 'DIAMOND') AND division = 'II'")
        clean_partition(store, raw, cells, "kr", "2026-01-01", "2026-01-02")
    return store.scan("fact_player_rank", server="kr").groupBy("server", "tier").agg(
        F.count(F.lit(1)).alias("players"), F.sum("wins").alias("wins"))


# -- weekly jobs ----------------------------------------------------------------------------------


#: Records of a landed file at most; a file is one document that one task reads.
SNAPSHOT_ROWS = 100_000


def land_snapshot(t: Tables, root: str, source: str, rows: DataFrame, week: str) -> None:
    """Records as files in order, two at least, each one JSON array, written batch by batch."""
    files = max(2, -(-rows.count() // SNAPSHOT_ROWS))
    fields = [c for c in SNAPSHOT_FIELDS[source] if c in rows.columns]
    lines = rows.repartitionByRange(files, "_ordinal").sortWithinPartitions("_ordinal").select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields])).alias("value"))

    def as_array(batches):
        before = "["
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"value": (before + batch["value"]).where(batch.index == batch.index[0], "," + batch["value"])})
                before = ","
        yield pd.DataFrame({"value": ["[]" if before == "[" else "]"]})

    lines.mapInPandas(as_array, "value string").write.text(week_path(root, source, week))


@query("N16 S3 S26", f"""
SELECT 'public_figures' AS job, person_id AS id, canonical_name AS name FROM ({REGISTRY['public_figures'].sql})
UNION ALL SELECT 'teams', team_id, canonical_name FROM ({REGISTRY['teams'].sql})
UNION ALL SELECT 'games', game_id, patch FROM ({REGISTRY['games'].sql})
UNION ALL SELECT 'tournaments', tournament_id, name FROM ({REGISTRY['tournaments'].sql})
UNION ALL SELECT 'matches', match_id, tournament FROM ({REGISTRY['matches'].sql})
UNION ALL SELECT 'entity_aliases', entity_id, alias FROM ({REGISTRY['entity_aliases'].sql})
""")
def weekly_jobs(t: Tables) -> DataFrame:
    """The six weekly jobs from landed snapshots of two files or more each."""
    root, week = t.scratch("snapshots"), "2026-02-02"
    records = {
        "players": players, "player_redirects": redirects, "teams": team_records, "scoreboard_games": game_records,
        "tournaments": tournament_records, "match_schedule": match_records,
    }
    for source, make in records.items():
        land_snapshot(t, root, source, make(t), week)
    store = store_for(t, CLEAN_SPECS)
    named = {
        "public_figures": ("person_id", "canonical_name"), "teams": ("team_id", "canonical_name"), "games": ("game_id", "patch"),
        "tournaments": ("tournament_id", "name"), "matches": ("match_id", "tournament"), "entity_aliases": ("entity_id", "alias"),
    }
    rows = [build_clean(t.spark, root, store, job, week, WIKI).select(F.lit(job).alias("job"), F.col(a).alias("id"), F.col(b).alias("name")) for job, (a, b) in named.items()]
    return reduce(DataFrame.unionByName, rows)
