"""Match documents into match and participant rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.text import patch_of
from chronofold.plans import schemas as S
from chronofold.sources.landing import LandingZone

# The ranked queue, and the number of bans of a team.
RANKED_QUEUE = 420
BANS_PER_TEAM = 5


def read_match_infos(zone: LandingZone, table: str = "match_info", **parts) -> DataFrame:
    """``matchId, region, info`` of landed match documents; the region is a path part.

    Reading with the declared schema parses each document once and drops unknown fields.
    """
    rows = zone.scan(table, _with_region(S.MATCH_INFO), "json", pattern="*", **parts)
    return rows.select(F.col("metadata.matchId").alias("matchId"), "region", "info")


def read_timelines(zone: LandingZone, table: str = "match_timeline", **parts) -> DataFrame:
    """``matchId, frames`` of landed timeline documents."""
    rows = zone.scan(table, _with_region(S.TIMELINE), "json", pattern="*", **parts)
    return rows.select(F.col("metadata.matchId").alias("matchId"), F.col("info.frames").alias("frames"))


def _with_region(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("region", T.StringType())])


def eligible(infos: DataFrame) -> DataFrame:
    """Ranked matches that did not end in a remake."""
    early = F.coalesce(F.get(F.col("info.participants"), F.lit(0))["gameEndedInEarlySurrender"], F.lit(False))
    return infos.where((F.col("info.queueId") == RANKED_QUEUE) & ~early)


def not_yet_done(ids: DataFrame, done: DataFrame | None, key: str = "matchId") -> DataFrame:
    """Ids without the matches that are already in every output table."""
    return ids if done is None else ids.join(done.select(key), key, "left_anti")


def teams_by_id(teams: Column) -> Column:
    """Teams array as a map by team id."""
    return F.map_from_entries(F.transform(teams, lambda t: F.struct(t["teamId"].cast("int"), t)))


def winner_of(teams: Column) -> Column:
    """Id of the winning team."""
    return F.get(F.filter(teams, lambda t: t["win"]), F.lit(0))["teamId"]


def match_rows(infos: DataFrame) -> DataFrame:
    """One wide row per match.  ``infos`` has ``matchId``, ``region`` and the ``info`` struct."""
    team = {i: F.try_element_at(F.col("_teams"), F.lit(i)) for i in S.TEAM_IDS}
    wide = {}
    for i in S.TEAM_IDS:
        for feat in S.FEATS:
            wide[f"team_{i}_{feat}"] = F.try_element_at(team[i]["feats"], F.lit(feat))["featState"]
        for name in S.OBJECTIVES:
            objective = F.try_element_at(team[i]["objectives"], F.lit(name))
            wide[f"team_{i}_{name}_first"] = objective["first"]
            wide[f"team_{i}_{name}_kills"] = objective["kills"]
    computed = {
        "matchId": F.col("matchId"),
        "region": F.col("region"),
        "patch": patch_of(F.col("info.gameVersion")),
        "winner_team_id": winner_of(F.col("info.teams")),
        **wide,
    }
    return infos.withColumn("_teams", teams_by_id(F.col("info.teams"))).select(
        *[computed.get(f.name, F.col(f"info.{f.name}")).cast(f.dataType).alias(f.name) for f in S.MATCHES]
    )


def participant_rows(infos: DataFrame) -> DataFrame:
    """One row per participant with draft and rune columns.

    The ban is the one at the participant's position within the own team's list.
    """
    rows = infos.select(
        "matchId",
        teams_by_id(F.col("info.teams")).alias("_teams"),
        F.posexplode("info.participants").alias("_pos", "_p"),
    )
    own_team = F.try_element_at(F.col("_teams"), F.col("_p.teamId").cast("int"))
    ban = F.get(own_team["bans"], F.col("_pos") % BANS_PER_TEAM)
    style = lambda n: F.get(F.col("_p.perks.styles"), F.lit(n))["selections"]
    computed = {
        "matchId": F.col("matchId"),
        "ban": ban["championId"],
        "pickTurn": ban["pickTurn"],
        **{f"rune_primary_{j}": F.get(style(0), F.lit(j))["perk"] for j in range(4)},
        **{f"rune_secondary_{j}": F.get(style(1), F.lit(j))["perk"] for j in range(2)},
        **{
            f"rune_shard_{kind}": F.try_element_at(F.col("_p.perks.statPerks"), F.lit(kind))
            for kind in ("defense", "flex", "offense")
        },
    }
    return rows.select(
        *[computed.get(f.name, F.col(f"_p.{f.name}")).cast(f.dataType).alias(f.name) for f in S.PARTICIPANTS]
    )


def basic_tables(infos: DataFrame, timelines: DataFrame, *, done: DataFrame | None = None, **timeline_options) -> dict[str, DataFrame]:
    """The three basic tables of a batch of landed documents.

    ``infos`` has ``matchId, region, info`` and ``timelines`` has ``matchId, frames``.  Matches
    found in ``done`` are skipped.  Everything but the join of the two document sets is a
    projection, so nothing else is exchanged.
    """
    from chronofold.plans.timeline import timeline_events

    chosen = not_yet_done(eligible(infos), done)
    champions = F.map_from_entries(
        F.transform("info.participants", lambda p: F.struct(p["participantId"].cast("int"), p["championName"]))
    )
    documents = timelines.join(chosen.select("matchId", champions.alias("champions")), "matchId")
    return {
        "matches": match_rows(chosen),
        "participants": participant_rows(chosen),
        "events": timeline_events(documents, champions="champions", **timeline_options),
    }
