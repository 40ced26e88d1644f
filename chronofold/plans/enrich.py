"""Wide events, snapshots and dataset splits on top of the basic tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.operators.counts import pivoted_latest
from chronofold.operators.lanes import Lane, last_known, last_known_at
from chronofold.operators.select import stratified_split
from chronofold.plans.schemas import PLAYERS
from chronofold.sources.landing import head

FRAME_EVENT = "PARTICIPANT_FRAME"

# Columns of a frame that follow a player, and pre-game columns of a participant.
FRAME_COLUMNS = (
    "positionX", "positionY", "currentGold", "totalGold", "xp", "minionsKilled", "jungleMinionsKilled",
    "championStats",
)
FRAME_ONLY_COLUMNS = ("currentGold", "totalGold", "xp", "minionsKilled", "jungleMinionsKilled", "championStats")
PREGAME_COLUMNS = (
    "championId", "summoner1Id", "summoner2Id", "rune_primary_0", "rune_primary_1", "rune_primary_2",
    "rune_primary_3", "rune_secondary_0", "rune_secondary_1", "rune_shard_offense", "rune_shard_flex",
    "rune_shard_defense",
)
MATCH_COLUMNS = ("gameStartTimestamp", "patch", "matchId", "platformId")
ITEM_EVENTS = ("ITEM_PURCHASED", "ITEM_SOLD", "ITEM_DESTROYED", "ITEM_UNDO")

# Snapshot time, and the tolerance that lets the frame of that minute in (ms).
SNAPSHOT_AT = 900_000
SNAPSHOT_TOLERANCE = 10_000

# What a snapshot counts per player.
COUNTED_EVENTS = ("CHAMPION_KILL", "CHAMPION_ASSIST", "BUILDING_KILL", "ELITE_MONSTER_KILL")
TOWERS = ("OUTER_TURRET", "INNER_TURRET", "INHIBITOR_TURRET", "NEXUS_TURRET")
MONSTERS = ("HORDE", "RIFTHERALD")
DRAGONS = ("AIR_DRAGON", "CHEMTECH_DRAGON", "EARTH_DRAGON", "FIRE_DRAGON", "HEXTECH_DRAGON", "WATER_DRAGON")

# Per-player columns of a snapshot.
SNAPSHOT_PREFIXES = (
    "currentGold", "inventoryIds", "inventoryCounts", "jungleMinionsKilled", "level", "minionsKilled",
    "rune_primary_0", "rune_primary_1", "rune_primary_2", "rune_primary_3", "rune_secondary_0",
    "rune_secondary_1", "rune_shard_defense", "rune_shard_flex", "rune_shard_offense", "positionX",
    "positionY", "summoner1Id", "summoner2Id", "totalGold", "xp",
)
SNAPSHOT_COLUMNS = ("gameStartTimestamp", "patch", "timestamp", "platformId")


def with_player_state(events: DataFrame, *, chronological: bool = True, bounded: bool = True) -> DataFrame:
    """Events with the latest frame, inventory and level of all ten players.

    Replaces pivot, fill and as-of join of each state by one running value per player: one exchange
    on the match and, with ``chronological`` event ids, one sort of the still narrow rows.  Frames are
    matched by time and hold for all players at once, so a player missing from the latest frame is
    null; inventories and levels are matched by event id.  A match comes out of one document, hence
    ``bounded``.
    """
    at_frame = F.col("type") == FRAME_EVENT
    on_item, on_level = F.col("type").isin(*ITEM_EVENTS), F.col("type") == "LEVEL_UP"
    mine = lambda p: F.col("participantId") == p
    held = F.struct("inventoryIds", "inventoryCounts")
    by_id = Lane(["matchId"], ["timestamp", "eventId"] if chronological else ["eventId"], bounded=bounded)
    full = by_id.run(
        events,
        **{f"_i{p}": last_known(F.when(on_item & mine(p), held)) for p in PLAYERS},
        **{f"_l{p}": last_known(F.when(on_level & mine(p), F.col("level"))) for p in PLAYERS},
    )
    # Statistics are a value of their own, so that a reader without use for them does not carry them.
    by_time = Lane(["matchId"], ["timestamp", "eventId"], bounded=bounded)
    state = F.struct(F.col("timestamp").alias("at"), *[c for c in FRAME_COLUMNS if c != "championStats"])
    full = by_time.run(
        full,
        _frame_at=last_known_at(F.when(at_frame, F.col("timestamp"))),
        **{f"_f{p}": last_known_at(F.when(at_frame & mine(p), state)) for p in PLAYERS},
        **{f"_s{p}": last_known_at(F.when(at_frame & mine(p), F.struct("championStats"))) for p in PLAYERS},
    )
    current = lambda p, c: F.when(F.col(f"_f{p}.at") == F.col("_frame_at"), F.col(f"_{'s' if c == 'championStats' else 'f'}{p}.{c}"))
    own = [c for c in events.columns if c not in FRAME_ONLY_COLUMNS]
    return full.where(~at_frame).select(
        *own,
        "_frame_at",
        *[current(p, c).alias(f"{c}_{p}") for c in FRAME_COLUMNS for p in PLAYERS],
        *[F.col(f"_i{p}.{c}").alias(f"{c}_{p}") for c in ("inventoryIds", "inventoryCounts") for p in PLAYERS],
        *[F.coalesce(F.col(f"_l{p}"), F.lit(1)).alias(f"level_{p}") for p in PLAYERS],
    )


def with_pregame(wide: DataFrame, participants: DataFrame) -> DataFrame:
    """Pre-game columns of all players, null before the first frame."""
    pregame = pivoted_latest(
        participants, ["matchId"], F.col("participantId"), PLAYERS, PREGAME_COLUMNS, ["participantId"]
    )
    joined = wide.join(pregame, "matchId", "left")
    started = F.col("_frame_at").isNotNull()
    return joined.withColumns(
        {f"{c}_{p}": F.when(started, F.col(f"{c}_{p}")) for c in PREGAME_COLUMNS for p in PLAYERS}
    ).drop("_frame_at")


def enriched_events(
    events: DataFrame,
    participants: DataFrame,
    matches: DataFrame,
    type_vectors: DataFrame | None = None,
    *,
    match_ids: DataFrame | None = None,
    chronological: bool = True,
    bounded: bool = True,
) -> DataFrame:
    """The wide events table.  ``match_ids`` restricts the run to some matches.

    Without ``chronological`` the event ids are in another order than time (derived events numbered last): inventories and levels then follow the ids."""
    if match_ids is not None:
        events = events.join(match_ids.select("matchId"), "matchId", "left_semi")
    wide = with_pregame(with_player_state(events, chronological=chronological, bounded=bounded), participants)
    wide = wide.join(matches.select(*MATCH_COLUMNS), "matchId")
    return wide if type_vectors is None else with_type_vectors(wide, type_vectors)


def with_type_vectors(events: DataFrame, vectors: DataFrame, *, type_column: str = "type") -> DataFrame:
    """Vector of the event type, an empty array for unknown types."""
    known = vectors.select(F.col("type").alias(type_column), F.col("vector").alias("type_embeddings"))
    empty = F.array().cast("array<double>")
    return events.join(known, type_column, "left").withColumn(
        "type_embeddings", F.coalesce("type_embeddings", empty)
    )


def snapshot_rules() -> dict[str, Column]:
    """Conditions counted per player, by column prefix."""
    kind = F.col("type")
    rules = {
        "kills": kind == "CHAMPION_KILL",
        "deaths": kind == "CHAMPION_KILL",
        "assists": kind == "CHAMPION_ASSIST",
    }
    tower = (kind == "BUILDING_KILL") & (F.col("buildingType") == "TOWER_BUILDING")
    rules |= {t: tower & (F.col("towerType") == t) for t in TOWERS}
    monster = kind == "ELITE_MONSTER_KILL"
    rules |= {m: monster & (F.col("monsterType") == m) for m in MONSTERS}
    rules |= {d: monster & (F.col("monsterSubType") == d) for d in DRAGONS}
    return rules


def snapshot_inputs(prefixes: Sequence[str] = SNAPSHOT_PREFIXES) -> list[str]:
    """Columns of the wide events that :func:`snapshot` reads."""
    return [
        "matchId", "eventId", "type", "participantId", "victimId", "monsterType", "monsterSubType", "buildingType",
        "towerType", *SNAPSHOT_COLUMNS, "winningTeam", *[f"{c}_{p}" for p in PLAYERS for c in prefixes],
    ]


def snapshot(
    events: DataFrame, *, at: int = SNAPSHOT_AT, tolerance: int = SNAPSHOT_TOLERANCE, prefixes: Sequence[str] = SNAPSHOT_PREFIXES
) -> DataFrame:
    """State and counts of every match that lasted until ``at``, one row each.

    One aggregation by match takes its length, its next winner, the last row before the cut and the counts of all rules.  Behind the
    windows of the enrichment the rows already lie together by match, so the aggregation adds no exchange.
    """
    order = F.struct("timestamp", "eventId")
    before = F.col("timestamp") <= at + tolerance
    state = [*SNAPSHOT_COLUMNS, "winningTeam", *[f"{c}_{p}" for p in PLAYERS for c in prefixes]]
    rules = snapshot_rules()
    counted = before & F.col("type").isin(*COUNTED_EVENTS)
    counts = {
        f"{name}_{p}": F.count_if(counted & rule & (F.col("victimId" if name == "deaths" else "participantId") == p))
        for name, rule in rules.items() for p in PLAYERS
    }
    found = events.groupBy("matchId").agg(
        F.max("timestamp").alias("_length"),
        F.min_by("winningTeam", F.when(~before & F.col("winningTeam").isNotNull(), order)).alias("_winner"),
        F.max_by(F.struct(*state), F.when(before, order)).alias("_last"),
        *[count.alias(name) for name, count in counts.items()],
    )
    lasting = found.where((F.col("_length") >= at) & F.col("_last").isNotNull())
    return lasting.select(
        "matchId", *[F.col(f"_last.{c}").alias(c) for c in state if c != "winningTeam"],
        F.coalesce("_last.winningTeam", "_winner").alias("winningTeam"), *counts,
    )


def match_snapshots(
    events: DataFrame, participants: DataFrame, matches: DataFrame, *, at: int = SNAPSHOT_AT, tolerance: int = SNAPSHOT_TOLERANCE,
    prefixes: Sequence[str] = SNAPSHOT_PREFIXES,
) -> DataFrame:
    """:func:`snapshot` of the wide events, from the narrow ones: state is aggregated up to the cut, no row is widened and no window runs.

    Events must be numbered in time order.  The newest inventory and level of a player before the cut are the ones at the last row.
    Frames count up to that row's time; those before the cut, one a minute and player, are carried in a list until it is known.
    """
    order = F.struct("timestamp", "eventId")
    at_frame = F.col("type") == FRAME_EVENT
    before, own = F.col("timestamp") <= at + tolerance, ~at_frame
    of_frame = [c for c in prefixes if c in FRAME_COLUMNS]
    frame = F.struct("timestamp", "eventId", "participantId", *of_frame)
    mine = {p: F.col("participantId") == p for p in PLAYERS}
    on_item, on_level = before & F.col("type").isin(*ITEM_EVENTS), before & (F.col("type") == "LEVEL_UP") & F.col("level").isNotNull()
    held = F.struct("inventoryIds", "inventoryCounts")
    counted = before & F.col("type").isin(*COUNTED_EVENTS)
    counts = {
        f"{name}_{p}": F.count_if(counted & rule & (F.col("victimId" if name == "deaths" else "participantId") == p))
        for name, rule in snapshot_rules().items() for p in PLAYERS
    }
    found = events.groupBy("matchId").agg(
        F.max(F.when(own, F.col("timestamp"))).alias("_length"),
        F.max_by(F.struct("timestamp", "winningTeam"), F.when(own & before, order)).alias("_last"),
        F.min_by("winningTeam", F.when(own & ~before & F.col("winningTeam").isNotNull(), order)).alias("_winner"),
        F.collect_list(F.when(before & at_frame, frame)).alias("_frames"),
        *[F.max_by(held, F.when(on_item & mine[p], order)).alias(f"_i{p}") for p in PLAYERS if {"inventoryIds", "inventoryCounts"} & {*prefixes}],
        *[F.max_by("level", F.when(on_level & mine[p], order)).alias(f"_l{p}") for p in PLAYERS if "level" in prefixes],
        *[count.alias(name) for name, count in counts.items()],
    )
    lasting = found.where((F.col("_length") >= at) & F.col("_last").isNotNull())
    seen = F.filter("_frames", lambda f: f["timestamp"] <= F.col("_last.timestamp"))
    lasting = lasting.withColumn("_frames", F.array_sort(seen)).withColumn("_frame_at", F.try_element_at("_frames", F.lit(-1))["timestamp"])
    current = lambda p: F.try_element_at(
        F.filter("_frames", lambda f: (f["timestamp"] == F.col("_frame_at")) & (f["participantId"] == p)), F.lit(-1))
    lasting = lasting.withColumns({f"_f{p}": current(p) for p in PLAYERS if of_frame})

    def state(prefix: str, p: int) -> Column:
        if prefix in FRAME_COLUMNS:
            return F.col(f"_f{p}.{prefix}")
        if prefix == "level":
            return F.coalesce(F.col(f"_l{p}"), F.lit(1))
        return F.col(f"_i{p}.{prefix}") if prefix in ("inventoryIds", "inventoryCounts") else F.col(f"{prefix}_{p}")

    joined = lasting.join(matches.select(*MATCH_COLUMNS), "matchId")
    if {*prefixes} & {*PREGAME_COLUMNS}:
        joined = with_pregame(joined, participants)
    return joined.select(
        "matchId", *[F.col("_last.timestamp").alias(c) if c == "timestamp" else F.col(c) for c in SNAPSHOT_COLUMNS],
        *[state(c, p).alias(f"{c}_{p}") for p in PLAYERS for c in prefixes], F.coalesce("_last.winningTeam", "_winner").alias("winningTeam"), *counts,
    )


def split_matches(matches: DataFrame, *, count: int | None = None) -> DataFrame:
    """Matches marked train or test, stratified by patch and winner."""
    columns = ["matchId", "patch", "winner_team_id", "region"]
    chosen = matches.select(*columns) if count is None else head(matches, columns, ["matchId"], count)
    label = F.concat("patch", F.lit("_"), F.col("winner_team_id").cast("string"))
    return stratified_split(chosen.withColumn("label", label), label="label", group="matchId")


def build_dataset(
    matches: DataFrame, build: Callable[[DataFrame], DataFrame], *, count: int | None = None
) -> DataFrame:
    """Rows of ``build(ids)`` with ``split`` and ``region`` columns, ready for ``store_splits``."""
    ids = split_matches(matches, count=count).select("matchId", "split", "region")
    return build(ids).join(ids, "matchId")
