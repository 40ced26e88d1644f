"""Queries on match and timeline documents that Spark derives from the customer table.

Every customer becomes one JSON match and one JSON timeline whose contents are arithmetic on the key,
so the documents grow with the table and SQL can state the expected rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.operators.grids import in_all
from chronofold.plans.enrich import enriched_events, match_snapshots, split_matches, with_player_state
from chronofold.plans.features import interval_samples, level_of, with_deltas, with_player_terms, xp_gain
from chronofold.plans.matches import (
    basic_tables, eligible, match_rows, not_yet_done, participant_rows, read_match_infos, read_timelines,
)
from chronofold.plans.timeline import timeline_events
from chronofold.sources.landing import LandingZone
from chronofold.suite.base import Tables, query


def _num(value: Column) -> Column:
    return value.cast("int")


def match_documents(t: Tables) -> DataFrame:
    """``matchId, region, info`` read from landed JSON."""
    key = F.col("c_custkey")

    def team(i):
        return F.struct(
            F.lit(i).alias("teamId"),
            ((key % 2 == 0) == F.lit(i == 100)).alias("win"),
            F.transform(F.sequence(F.lit(0), F.lit(4)), lambda n: F.struct(
                _num((key * 7 + n + i) % 160).alias("championId"), (n + 1).alias("pickTurn"))).alias("bans"),
            F.when(key % 3 > 0, F.create_map(F.lit("FIRST_BLOOD"), F.struct(_num(key % 3).alias("featState")))).alias("feats"),
            F.create_map(
                F.lit("baron"), F.struct((key % 4 == 1).alias("first"), _num(key % 4).alias("kills")),
                F.lit("dragon"), F.struct((key % 5 == 1).alias("first"), _num((key + i) % 5).alias("kills")),
            ).alias("objectives"),
        )

    def player(n):
        return F.struct(
            n.alias("participantId"), F.when(n <= 5, 100).otherwise(200).alias("teamId"),
            _num((key + n * 13) % 170).alias("championId"), F.concat(F.lit("Champion"), n.cast("string")).alias("championName"),
            (F.col("c_mktsegment") == "FURNITURE").alias("gameEndedInEarlySurrender"), _num(key % 20).alias("kills"),
            F.struct(
                F.create_map(F.lit("defense"), _num(key % 9), F.lit("flex"), _num(key % 8), F.lit("offense"), _num(key % 7)).alias("statPerks"),
                F.array(*[
                    F.struct(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: F.struct(
                        _num((key + n + j) % 100).alias("perk"))).alias("selections"))
                    for size in (4, 2)
                ]).alias("styles"),
            ).alias("perks"),
        )

    info = F.struct(
        key.alias("gameId"), F.when(F.col("c_acctbal") < 0, 440).otherwise(420).alias("queueId"),
        F.concat(F.lit("14."), (key % 24 + 1).cast("string"), F.lit(".1")).alias("gameVersion"),
        F.lit("NA1").alias("platformId"), (key * 1000).alias("gameStartTimestamp"), _num(key % 3000).alias("gameDuration"),
        F.array(team(100), team(200)).alias("teams"),
        F.transform(F.sequence(F.lit(1), F.lit(10)), player).alias("participants"),
    )
    name = F.concat(F.lit("M_"), key.cast("string"))
    document = F.to_json(F.struct(F.struct(name.alias("matchId")).alias("metadata"), info.alias("info")))
    region = F.element_at(F.array(F.lit("americas"), F.lit("asia"), F.lit("europe")), _num(key % 3) + 1)
    zone = landed(t, "match_info", document, region.alias("region"))
    return read_match_infos(zone)


def timeline_documents(t: Tables) -> DataFrame:
    """``matchId, frames`` read from landed JSON: four one-minute frames with ten players."""
    key = F.col("c_custkey")

    def event(kind, at, **fields):
        names = ("participantId", "killerId", "victimId", "itemId", "level", "teamId", "winningTeam", "actualStartTime",
                 "assistingParticipantIds", "wardType", "monsterType", "monsterSubType", "bounty")
        values = [fields[n].alias(n) if n in fields else F.lit(None).cast(
            "array<int>" if n == "assistingParticipantIds" else "string" if n in ("wardType", "monsterType", "monsterSubType") else "int"
        ).alias(n) for n in names]
        return F.struct(F.lit(kind).alias("type"), _num(at).alias("timestamp"), *values)

    def frame(n):
        at = n * 60_000
        buyer, killer, victim = _num((key + n) % 10) + 1, _num((key + n) % 5) + 1, _num((key + 2 * n) % 5) + 6
        first, second = _num((key + n) % 6) + 1001, _num((key + 2 * n) % 6) + 1001
        players = F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.struct(
            i.cast("string"), F.struct(
                _num(500 + n * 100 + i + key % 50).alias("currentGold"), _num(n * 300 + i * 10 + key % 7).alias("xp"),
                _num(n + 1).alias("level"), F.struct(_num(n * 10 + i).alias("x"), _num(key % 100).alias("y")).alias("position")))))
        events = F.array(
            event("ITEM_PURCHASED", at + 10, participantId=buyer, itemId=first),
            event("ITEM_DESTROYED", at + 20, participantId=buyer, itemId=first),
            event("ITEM_PURCHASED", at + 20, participantId=buyer, itemId=second),
            event("ITEM_PURCHASED", at + 25, participantId=_num(key % 10) + 1, itemId=first),
            event("LEVEL_UP", at + 30, participantId=victim, level=n + 2),
            event("CHAMPION_KILL", at + 15_000 + key % 1000, killerId=killer, victimId=victim, bounty=F.lit(300),
                  assistingParticipantIds=F.sequence(killer, F.least(killer + _num(key % 3), F.lit(5)))),
            event("WARD_KILL", at + 20_000, killerId=killer, wardType=F.when(key % 2 == 0, "CONTROL_WARD").otherwise("YELLOW_TRINKET")),
            event("ITEM_UNDO", at + 30_000, participantId=buyer),
            event("ELITE_MONSTER_KILL", at + 40_000, killerId=killer, monsterType=F.lit("DRAGON"),
                  monsterSubType=F.when(key % 2 == 0, "FIRE_DRAGON").otherwise("AIR_DRAGON")),
            event("OBJECTIVE_BOUNTY_PRESTART", at + 41_000, teamId=F.lit(100), actualStartTime=_num(at + 44_000)),
        )
        ending = F.when(n == 3, F.array(event("GAME_END", at + 59_000, winningTeam=F.when(key % 2 == 0, 100).otherwise(200))))
        return F.struct(_num(at).alias("timestamp"), players.alias("participantFrames"),
                        F.concat(events, F.coalesce(ending, F.slice(events, 1, 0))).alias("events"))

    name = F.concat(F.lit("M_"), key.cast("string"))
    document = F.to_json(F.struct(
        F.struct(name.alias("matchId")).alias("metadata"),
        F.struct(F.transform(F.sequence(F.lit(0), F.lit(3)), frame).alias("frames")).alias("info")))
    return read_timelines(landed(t, "match_timeline", document, F.lit("all").alias("region")))


#: Landing zones of this process, by session, folder and table: the documents are written once.
_LANDED: dict[tuple[str, str, str], LandingZone] = {}
#: Customers whose documents one task writes.
LANDED_ROWS = 2000


def landed(t: Tables, table: str, document: Column, region: Column) -> LandingZone:
    """The documents as JSON lines in a landing zone, one folder per region.

    Customers are narrow and their documents wide, so they are dealt by number before these are made.
    """
    key = (t.spark.sparkContext.applicationId, t.folder, table)
    if key not in _LANDED:
        zone = LandingZone(t.spark, t.scratch("landing"), ["match_info", "match_timeline"])
        tasks = -(-t.customer.count() // LANDED_ROWS)
        lines = t.customer.repartition(max(tasks, 1), "c_custkey").select(document.alias("value"), region)
        lines.write.partitionBy("region").text(zone.table_path(table))
        _LANDED[key] = zone
    return _LANDED[key]


def death_timer(level: Column, minutes: Column) -> Column:
    """Milliseconds out of play, made up for the checks."""
    return _num(level * 1000 + F.floor(minutes) * 100)


def built_events(t: Tables, **options) -> DataFrame:
    return timeline_events(
        timeline_documents(t), positions={"pit": (9866, 4414), "low_spawn": (394, 461), "high_spawn": (14340, 14390)},
        death_timer=death_timer, **options,
    )


@query("P1 P2 P3 P6 P7 S20", """
SELECT 'M_' || c_custkey AS matchId, ['americas', 'asia', 'europe'][c_custkey % 3 + 1] AS region,
  '14.' || (c_custkey % 24 + 1) AS patch, c_custkey AS gameId,
  (CASE WHEN c_custkey % 2 = 0 THEN 100 ELSE 200 END)::SMALLINT AS winner_team_id,
  (CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 3 END)::SMALLINT AS team_100_FIRST_BLOOD,
  NULL::SMALLINT AS team_200_FIRST_TURRET,
  c_custkey % 4 = 1 AS team_100_baron_first, (c_custkey % 4)::SMALLINT AS team_200_baron_kills,
  ((c_custkey + 200) % 5)::SMALLINT AS team_200_dragon_kills, NULL::SMALLINT AS team_100_tower_kills
FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE'
""")
def flattened_matches(t: Tables) -> DataFrame:
    """Eligible matches flattened to wide rows."""
    rows = match_rows(eligible(match_documents(t)))
    return rows.select(
        "matchId", "region", "patch", "gameId", "winner_team_id", "team_100_FIRST_BLOOD", "team_200_FIRST_TURRET",
        "team_100_baron_first", "team_200_baron_kills", "team_200_dragon_kills", "team_100_tower_kills",
    )


@query("P4 P5 P6", """
SELECT 'M_' || c_custkey AS matchId, n::SMALLINT AS participantId, ((c_custkey + n * 13) % 170)::INTEGER AS championId,
  ((c_custkey * 7 + (n - 1) % 5 + CASE WHEN n <= 5 THEN 100 ELSE 200 END) % 160)::INTEGER AS ban,
  ((n - 1) % 5 + 1)::SMALLINT AS pickTurn,
  ((c_custkey + n) % 100)::SMALLINT AS rune_primary_0, ((c_custkey + n + 3) % 100)::SMALLINT AS rune_primary_3,
  ((c_custkey + n + 1) % 100)::SMALLINT AS rune_secondary_1, (c_custkey % 8)::SMALLINT AS rune_shard_flex,
  (c_custkey % 20)::SMALLINT AS kills
FROM customer, range(1, 11) r(n)
""")
def flattened_participants(t: Tables) -> DataFrame:
    """Participants with draft and rune columns."""
    return participant_rows(match_documents(t)).select(
        "matchId", "participantId", "championId", "ban", "pickTurn", "rune_primary_0", "rune_primary_3",
        "rune_secondary_1", "rune_shard_flex", "kills",
    )


# The expected event rows of one customer: source rows, then what follows from them.
_EVENTS = """
WITH f AS (
  SELECT c_custkey AS k, n, n * 60000 AS t0, ((c_custkey + n) % 10 + 1) AS buyer, ((c_custkey + n) % 5 + 1) AS killer,
    ((c_custkey + 2 * n) % 5 + 6) AS victim, ((c_custkey + n) % 6 + 1001) AS item1, ((c_custkey + 2 * n) % 6 + 1001) AS item2
  FROM customer, range(0, 4) r(n)),
src AS (
  SELECT k, t0 AS ts, 'PARTICIPANT_FRAME' AS type, i AS pid, n * 100 + i AS ord, NULL::BIGINT AS victim, NULL::BIGINT AS item, NULL::BIGINT AS level, NULL::BIGINT AS helpers, n * 300 + i * 10 + k % 7 AS xp
    FROM f, range(1, 11) p(i)
  UNION ALL SELECT k, t0 + 10, 'ITEM_PURCHASED', buyer, 1000 + n * 20 + 0, NULL, item1, NULL, NULL, NULL FROM f
  UNION ALL SELECT k, t0 + 20, 'ITEM_DESTROYED', buyer, 1000 + n * 20 + 1, NULL, item1, NULL, NULL, NULL FROM f
  UNION ALL SELECT k, t0 + 20, 'ITEM_PURCHASED', buyer, 1000 + n * 20 + 2, NULL, item2, NULL, NULL, NULL FROM f
  UNION ALL SELECT k, t0 + 25, 'ITEM_PURCHASED', k % 10 + 1, 1000 + n * 20 + 3, NULL, item1, NULL, NULL, NULL FROM f
  UNION ALL SELECT k, t0 + 30, 'LEVEL_UP', victim, 1000 + n * 20 + 4, NULL, NULL, n + 2, NULL, NULL FROM f
  UNION ALL SELECT k, t0 + 15000 + k % 1000, 'CHAMPION_KILL', killer, 1000 + n * 20 + 5, victim, NULL, NULL, least(killer + k % 3, 5) - killer + 1, NULL FROM f
  UNION ALL SELECT k, t0 + 20000, 'WARD_KILL', killer, 1000 + n * 20 + 6, NULL, NULL, NULL, 0, NULL FROM f
  UNION ALL SELECT k, t0 + 30000, 'ITEM_UNDO', buyer, 1000 + n * 20 + 7, NULL, NULL, NULL, NULL, NULL FROM f
  UNION ALL SELECT k, t0 + 40000, 'ELITE_MONSTER_KILL', killer, 1000 + n * 20 + 8, NULL, NULL, NULL, 0, NULL FROM f
  UNION ALL SELECT k, t0 + 41000, 'OBJECTIVE_BOUNTY_PRESTART', NULL, 1000 + n * 20 + 9, NULL, NULL, NULL, NULL, NULL FROM f
  UNION ALL SELECT k, t0 + 59000, 'GAME_END', NULL, 1000 + n * 20 + 10, NULL, NULL, NULL, NULL, NULL FROM f WHERE n = 3),
kills AS (SELECT * FROM src WHERE type = 'CHAMPION_KILL'),
levels AS (
  SELECT s.k, s.ord, l.level, row_number() OVER (PARTITION BY s.k, s.ord ORDER BY abs(l.ts - s.ts), l.ord) AS rn
  FROM kills s LEFT JOIN src l ON l.k = s.k AND l.type = 'LEVEL_UP' AND l.pid = s.victim),
allrows AS (
  SELECT k, ts, 0 AS stage, type AS rank, ord, 0 AS sub, type, pid, victim, NULL::BIGINT AS killer, item, level, helpers, xp FROM src
  UNION ALL
  SELECT s.k, s.ts + coalesce(l.level, 1) * 1000 + floor(s.ts / 60000.0)::BIGINT * 100, 1, 'RESPAWN', s.ord, 1, 'RESPAWN', s.victim, NULL, NULL, NULL, NULL, NULL, NULL
  FROM kills s JOIN levels l ON l.k = s.k AND l.ord = s.ord AND l.rn = 1
  UNION ALL
  SELECT s.k, s.ts, 1, 'CHAMPION_ASSIST', s.ord, 2 + h, 'CHAMPION_ASSIST', s.pid + h, s.victim, NULL, NULL, NULL, s.helpers, NULL
  FROM kills s, range(0, 3) r(h) WHERE h < s.helpers
  UNION ALL
  SELECT k, ts, 1, 'CHAMPION_KILLED', ord, 100, 'CHAMPION_KILLED', victim, victim, pid, NULL, NULL, helpers, NULL FROM kills
  UNION ALL
  SELECT k, ts + 3000, 1, 'OBJECTIVE_BOUNTY_START', ord, 101, 'OBJECTIVE_BOUNTY_START', NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM src WHERE type = 'OBJECTIVE_BOUNTY_PRESTART'),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, stage, rank, ord, sub) - 1 AS id FROM allrows)
"""


@query("E1 E2 E3 E4 E5 E6 E7 E11 P8 P9 P10 T1 U1 W8 X5 S19", _EVENTS + """
SELECT 'M_' || k AS matchId, id::SMALLINT AS eventId, ts::INTEGER AS timestamp, type, pid::SMALLINT AS participantId,
  victim::SMALLINT AS victimId, killer::SMALLINT AS killerId, item::INTEGER AS itemId, helpers::TINYINT AS numberOfAssists,
  xp::INTEGER AS xp,
  (CASE WHEN type LIKE 'ITEM%' THEN CASE WHEN pid <= 5 THEN 394 ELSE 14340 END
        WHEN type = 'PARTICIPANT_FRAME' THEN ts // 6000 + pid END)::INTEGER AS positionX
FROM numbered
""")
def timeline_events_built(t: Tables) -> DataFrame:
    """Events table of all timelines: frames, events and everything derived from them, in order."""
    return built_events(t).select(
        "matchId", "eventId", "timestamp", "type", "participantId", "victimId", "killerId", "itemId", "numberOfAssists",
        "xp", "positionX",
    )


# The same rows with derived events numbered last.
_APPENDED = """
, appended AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY stage, CASE WHEN stage = 0 THEN ts END, CASE WHEN stage = 0 THEN rank END,
    CASE WHEN stage = 0 THEN ord END, parent, sub) - 1 AS aid
  FROM (SELECT a.*, CASE WHEN stage = 1 THEN (SELECT p FROM (SELECT k AS k2, ord AS o2,
      row_number() OVER (PARTITION BY k ORDER BY ts, rank, ord) AS p FROM allrows WHERE stage = 0) q WHERE q.k2 = a.k AND q.o2 = a.ord) END AS parent
    FROM allrows a))
"""


@query("E11 W8", _EVENTS + """
""" + _APPENDED.lstrip() + """
SELECT 'M_' || k AS matchId, aid::SMALLINT AS eventId, type, participantId FROM (SELECT *, pid::SMALLINT AS participantId FROM appended)
""")
def timeline_events_appended(t: Tables) -> DataFrame:
    """The same events numbered with derived ones at the end."""
    return built_events(t, event_id_mode="append").select("matchId", "eventId", "type", "participantId")


_HELD = """
, items AS (
  SELECT k, pid, ts, type, coalesce(item, 0) AS item, id, row_number() OVER (PARTITION BY k, pid ORDER BY id) AS n
  FROM numbered WHERE type LIKE 'ITEM%'),
replay AS (
  SELECT k, pid, 0::BIGINT AS n, NULL::BIGINT AS id, [0, 0, 0, 0, 0, 0]::BIGINT[] AS held, []::STRUCT(kind VARCHAR, tick BIGINT, item BIGINT)[] AS past
  FROM (SELECT DISTINCT k, pid FROM items)
  UNION ALL
  SELECT s.k, s.pid, s.n, s.id,
    CASE
      WHEN s.kind = 'ITEM_PURCHASED' THEN [s.held[i + 1] + (i + 1001 = s.item)::BIGINT for i in range(6)]
      WHEN s.kind IN ('ITEM_SOLD', 'ITEM_DESTROYED') THEN [greatest(0, s.held[i + 1] - (i + 1001 = s.item)::BIGINT) for i in range(6)]
      WHEN s.top.kind = 'ITEM_PURCHASED' THEN [greatest(0, s.held[i + 1] - (i + 1001 = s.top.item)::BIGINT)
          + len([x for x in s.past[len(s.past) - s.run : len(s.past) - 1] if x.item = i + 1001]) for i in range(6)]
      WHEN s.top.kind = 'ITEM_SOLD' THEN [s.held[i + 1] + (i + 1001 = s.top.item)::BIGINT for i in range(6)]
      ELSE s.held END,
    CASE
      WHEN s.kind <> 'ITEM_UNDO' THEN list_append(s.past, {'kind': s.kind, 'tick': s.ts, 'item': s.item})
      WHEN len(s.past) = 0 THEN s.past
      WHEN s.top.kind = 'ITEM_PURCHASED' THEN s.past[1 : len(s.past) - 1 - s.run]
      ELSE s.past[1 : len(s.past) - 1] END
  FROM (
    SELECT e.k, e.pid, e.n, e.id, e.type AS kind, e.ts, e.item, r.held, r.past, r.past[len(r.past)] AS top,
      coalesce(list_position([NOT (x.kind = 'ITEM_DESTROYED' AND x.tick = r.past[len(r.past)].tick)
        for x in list_reverse(r.past[1 : len(r.past) - 1])], true) - 1, len(r.past) - 1) AS run
    FROM replay r JOIN items e ON e.k = r.k AND e.pid = r.pid AND e.n = r.n + 1) s)
"""


@query("E9 E10 X4 H21", _EVENTS.replace("WITH f", "WITH RECURSIVE f") + _HELD + """
SELECT 'M_' || k AS matchId, id::SMALLINT AS eventId, pid::SMALLINT AS participantId,
  coalesce(array_to_string([1001 + i for i in range(6) if held[i + 1] > 0], ','), '') AS ids,
  coalesce(array_to_string([held[i + 1] for i in range(6) if held[i + 1] > 0], ','), '') AS counts, 8 AS slots
FROM replay WHERE n > 0
""")
def inventories_replayed(t: Tables) -> DataFrame:
    """Inventory after every item event, folded inside each document."""
    shown = lambda c: F.array_join(F.filter(c, lambda v: v > 0), ",")
    return built_events(t).where(F.col("inventoryIds").isNotNull()).select(
        "matchId", "eventId", "participantId", shown("inventoryIds").alias("ids"), shown("inventoryCounts").alias("counts"),
        F.greatest(F.size("inventoryIds"), F.size("inventoryCounts")).alias("slots"),
    )


@query("N1 N3 J1 J3 J5 A4 W5 P11 P26", _EVENTS + """
SELECT 'M_' || k AS matchId, id::SMALLINT AS eventId, type,
  last_value(CASE WHEN type = 'PARTICIPANT_FRAME' AND pid = 1 THEN xp END IGNORE NULLS) OVER t AS xp_1,
  last_value(CASE WHEN type = 'PARTICIPANT_FRAME' AND pid = 10 THEN xp END IGNORE NULLS) OVER t AS xp_10,
  coalesce(last_value(CASE WHEN type = 'LEVEL_UP' AND pid = 6 THEN level END IGNORE NULLS) OVER i, 1) AS level_6,
  coalesce(last_value(CASE WHEN type = 'LEVEL_UP' AND pid = 7 THEN level END IGNORE NULLS) OVER i, 1) AS level_7,
  last_value(CASE WHEN type LIKE 'ITEM%' AND pid = 3 THEN id END IGNORE NULLS) OVER i IS NOT NULL AS has_items_3
FROM numbered
WINDOW t AS (PARTITION BY k ORDER BY ts, CASE WHEN type = 'PARTICIPANT_FRAME' THEN 0 ELSE 1 END, id ROWS UNBOUNDED PRECEDING),
  i AS (PARTITION BY k ORDER BY id ROWS UNBOUNDED PRECEDING)
QUALIFY type <> 'PARTICIPANT_FRAME'
""")
def events_with_player_state(t: Tables) -> DataFrame:
    """Events with frames, inventories and levels of the players."""
    return with_player_state(built_events(t)).select(
        "matchId", "eventId", "type", F.col("xp_1").cast("long"), F.col("xp_10").cast("long"),
        F.col("level_6").cast("long"), F.col("level_7").cast("long"), F.col("inventoryIds_3").isNotNull().alias("has_items_3"),
    )


@query("N5 J2 J18 E12 S8", _EVENTS + """
SELECT 'M_' || k AS matchId, id::SMALLINT AS eventId, '14.' || (k % 24 + 1) AS patch, 'NA1' AS platformId, k * 1000 AS gameStartTimestamp,
  (CASE WHEN ts >= 0 THEN (k + 4 * 13) % 170 END)::INTEGER AS championId_4, 0 AS vector_size
FROM numbered WHERE k IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE') AND type <> 'PARTICIPANT_FRAME'
""")
def enriched_events_built(t: Tables) -> DataFrame:
    """The whole enrichment from documents to wide events."""
    tables = basic_tables(match_documents(t), timeline_documents(t), death_timer=death_timer)
    no_vectors = t.spark.createDataFrame([], "type string, vector array<double>")
    wide = enriched_events(tables["events"], tables["participants"], tables["matches"], no_vectors)
    return wide.select(
        "matchId", "eventId", "patch", "platformId", "gameStartTimestamp", "championId_4",
        F.size("type_embeddings").alias("vector_size"),
    )


@query("N5 J2 J18 N2 W5 E11", _EVENTS + _APPENDED.lstrip() + """
, named AS (SELECT a.*, a.pid::SMALLINT AS participantId, CASE WHEN type LIKE '%_KILL' OR type = 'LEVEL_UP' THEN [length(type)::DOUBLE, 0.5] ELSE [] END AS v FROM appended a)
SELECT 'M_' || k AS matchId, aid::SMALLINT AS eventId, type,
  coalesce(last_value(CASE WHEN type = 'LEVEL_UP' AND pid = 6 THEN level END IGNORE NULLS) OVER i, 1)::BIGINT AS level_6,
  coalesce(last_value(CASE WHEN type LIKE 'ITEM%' AND pid = 3 THEN aid END IGNORE NULLS) OVER i, -1)::BIGINT AS items_since_3,
  len(v) AS vector_size, coalesce(v[1], 0) AS vector_first
FROM named WHERE k IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE')
WINDOW i AS (PARTITION BY k ORDER BY aid ROWS UNBOUNDED PRECEDING)
QUALIFY type <> 'PARTICIPANT_FRAME'
""")
def enriched_events_appended(t: Tables) -> DataFrame:
    """Wide events numbered with derived ones last, whose states follow the ids, with vectors of some event types."""
    tables = basic_tables(match_documents(t), timeline_documents(t), death_timer=death_timer)
    numbered = built_events(t, event_id_mode="append")
    known = numbered.select("type").distinct().where(F.col("type").endswith("_KILL") | (F.col("type") == "LEVEL_UP"))
    vectors = known.select("type", F.array(F.length("type").cast("double"), F.lit(0.5)).alias("vector"))
    # The number of the item event stands in for what is held, which other queries check.
    numbered = numbered.withColumn("inventoryIds", F.when(F.col("type").startswith("ITEM"), F.array(F.col("eventId").cast("int"))))
    wide = enriched_events(numbered, tables["participants"], tables["matches"], vectors, chronological=False)
    return wide.select(
        "matchId", "eventId", "type", F.col("level_6").cast("long"), F.coalesce(F.get("inventoryIds_3", F.lit(0)), F.lit(-1)).cast("long").alias("items_since_3"),
        F.size("type_embeddings").alias("vector_size"), F.coalesce(F.get("type_embeddings", F.lit(0)), F.lit(0.0)).alias("vector_first"))


_PLAYERS = range(1, 11)
# Rules that the timelines have events for; the others count nothing.
_SEEN_RULES = {"kills": "type = 'CHAMPION_KILL' AND pid", "deaths": "type = 'CHAMPION_KILL' AND victim", "assists": "type = 'CHAMPION_ASSIST' AND pid"}
_SEEN_RULES["FIRE_DRAGON"] = "type = 'ELITE_MONSTER_KILL' AND k % 2 = 0 AND pid"


@query("N6 J7 J8 J9 A2 A3 P12 P13 W6", _EVENTS + """
, cut AS (SELECT * FROM numbered WHERE ts <= 120000 + 10000 AND k IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE'))
SELECT 'M_' || k AS matchId, max(ts) FILTER (type <> 'PARTICIPANT_FRAME')::INTEGER AS timestamp,
  (CASE WHEN k % 2 = 0 THEN 100 ELSE 200 END)::SMALLINT AS winningTeam, '14.' || (k % 24 + 1) AS patch,
  """ + ", ".join(f"count(*) FILTER ({rule} = {p}) AS {name}_{p}" for name, rule in _SEEN_RULES.items() for p in _PLAYERS) + """, 0::BIGINT AS OUTER_TURRET_9,
  """ + ", ".join(f"max(CASE WHEN type = 'PARTICIPANT_FRAME' AND pid = {p} AND ts = 120000 THEN xp END)::INTEGER AS xp_{p}" for p in _PLAYERS) + """,
  """ + ", ".join(f"(120000 // 6000 + {p})::INTEGER AS positionX_{p}" for p in _PLAYERS) + """,
  """ + ", ".join(f"coalesce(max_by(level, id) FILTER (type = 'LEVEL_UP' AND pid = {p}), 1)::INTEGER AS level_{p}" for p in _PLAYERS) + """,
  """ + ", ".join(f"bool_or(type LIKE 'ITEM%' AND pid = {p}) AS has_items_{p}" for p in _PLAYERS) + """,
  """ + ", ".join(f"((k + {p} * 13) % 170)::INTEGER AS championId_{p}" for p in _PLAYERS) + """
FROM cut GROUP BY k
""")
def match_snapshot(t: Tables) -> DataFrame:
    """Snapshot of every match at two minutes: counts and five kinds of state of all players."""
    tables = basic_tables(match_documents(t), timeline_documents(t), death_timer=death_timer)
    prefixes = ("xp", "positionX", "level", "inventoryIds", "championId")
    found = match_snapshots(tables["events"], tables["participants"], tables["matches"], at=120_000, prefixes=prefixes)
    return found.select(
        "matchId", "timestamp", "winningTeam", "patch", *[f"{name}_{p}" for name in _SEEN_RULES for p in _PLAYERS], "OUTER_TURRET_9",
        *[F.col(f"{c}_{p}").cast("int") for c in ("xp", "positionX", "level", "championId") for p in _PLAYERS],
        *[F.col(f"inventoryIds_{p}").isNotNull().alias(f"has_items_{p}") for p in _PLAYERS],
    )


@query("N17 S9 H6", None)
def match_split(t: Tables) -> DataFrame:
    """Train/test counts of matches by patch and winner."""
    return split_matches(match_rows(eligible(match_documents(t)))).groupBy("label", "split").count()


@query("J11 E12", """
SELECT 'M_' || c_custkey AS matchId FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE' AND c_acctbal <= 5000
""")
def matches_still_to_build(t: Tables) -> DataFrame:
    """Eligible matches that are not yet in every output table (customers with a small balance are new)."""
    documents = match_documents(t)
    built = t.customer.where("c_acctbal > 5000").select(F.concat(F.lit("M_"), F.col("c_custkey").cast("string")).alias("matchId"))
    done = in_all([built, built, built], ["matchId"])
    return not_yet_done(eligible(documents), done).select("matchId")


@query("M3 M4 J19 P24", _EVENTS + """
, relevant AS (SELECT *, sum(CASE WHEN type = 'PARTICIPANT_FRAME' THEN 1 ELSE 0 END)
    OVER (PARTITION BY k, pid ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS interval_id
  FROM numbered WHERE type IN ('PARTICIPANT_FRAME', 'WARD_KILL', 'CHAMPION_KILL', 'CHAMPION_KILLED', 'CHAMPION_ASSIST', 'ELITE_MONSTER_KILL')
    AND (type <> 'WARD_KILL' OR k % 2 = 0)),
counts AS (
  SELECT k, pid, interval_id, min(ts) FILTER (type = 'PARTICIPANT_FRAME') AS t0, count(*) FILTER (type = 'WARD_KILL') AS wards,
    count(*) FILTER (type = 'CHAMPION_KILL') AS kills, count(*) FILTER (type = 'CHAMPION_KILLED') AS deaths,
    count(*) FILTER (type = 'CHAMPION_ASSIST') AS assists, count(*) FILTER (type = 'ELITE_MONSTER_KILL') AS monsters, max(helpers) AS helpers FROM relevant GROUP BY ALL),
frames AS (SELECT k, pid, ts, xp, lead(ts) OVER w AS next_ts, lead(xp) OVER w AS next_xp FROM src
  WHERE type = 'PARTICIPANT_FRAME' WINDOW w AS (PARTITION BY k, pid ORDER BY ts))
SELECT 'M_' || f.k AS matchId, f.pid::SMALLINT AS participantId, f.ts::INTEGER AS previous_timestamp,
  (f.next_ts - f.ts)::INTEGER AS time_delta, (f.next_xp - f.xp)::INTEGER AS xp_delta, wards AS "WARD_KILL", kills AS "CHAMPION_KILL",
  deaths AS "CHAMPION_KILLED", assists AS "CHAMPION_ASSIST", f.xp * kills AS "champion_kill_X_xp",
  ((f.next_ts - f.ts) ^ 2)::DOUBLE AS time_delta_squared, (f.xp ^ 2)::DOUBLE AS previous_xp_squared, f.xp * f.ts AS previous_xp_time_interaction,
  (f.next_ts ^ 2)::DOUBLE AS current_timestamp_squared, f.xp * monsters AS "monster_kill_X_xp", sqrt(f.next_xp - f.xp) AS xp_delta_sqrt,
  CASE WHEN helpers > 0 THEN f.xp * assists / helpers END AS "champion_assist_X_xp",
  f.ts * monsters AS "dragon_X_time", 0::BIGINT AS "baron_X_time",
  (f.pid = 1)::TINYINT AS "participantId_01", (f.pid = 10)::TINYINT AS "participantId_10", (f.pid > 5)::TINYINT AS team, (f.k % 3 = 0)::TINYINT AS region_euw
FROM frames f JOIN counts c ON c.k = f.k AND c.pid = f.pid AND c.t0 = f.ts WHERE next_xp IS NOT NULL
""")
def experience_samples(t: Tables) -> DataFrame:
    """Minute samples of every player with the events between two frames, their nonlinear terms and one-hot columns."""
    counted = interval_samples(built_events(t), monsters=("DRAGON", "BARON_NASHOR"))
    key = F.substring("matchId", 3, 20).cast("long")
    samples = with_player_terms(with_deltas(counted).withColumn("region", F.when(key % 3 == 0, "euw").otherwise("na")), regions=("euw", "na"))
    return samples.select(
        "matchId", "participantId", "previous_timestamp", "time_delta", "xp_delta", "WARD_KILL", "CHAMPION_KILL",
        "CHAMPION_KILLED", "CHAMPION_ASSIST", "champion_kill_X_xp", "time_delta_squared", "previous_xp_squared", "previous_xp_time_interaction",
        "current_timestamp_squared", "monster_kill_X_xp", "xp_delta_sqrt", "champion_assist_X_xp",
        F.col("monster_kill_monsterType_DRAGON_X_previous_timestamp").alias("dragon_X_time"),
        F.col("monster_kill_monsterType_BARON_NASHOR_X_previous_timestamp").alias("baron_X_time"), "participantId_01", "participantId_10", "team", "region_euw",
    )


@query("P25 X1 H20", _EVENTS + """
, levelled AS (SELECT *, """ + ", ".join(
    f"coalesce(last_value(CASE WHEN type = 'LEVEL_UP' AND pid = {p} THEN level END IGNORE NULLS) OVER i, 1) AS level_{p}" for p in range(6, 11)) + """
  FROM numbered WINDOW i AS (PARTITION BY k ORDER BY id ROWS UNBOUNDED PRECEDING))
SELECT 'M_' || k AS matchId, id::SMALLINT AS eventId,
  CASE WHEN type IN ('CHAMPION_KILL', 'CHAMPION_ASSIST') THEN
      [level_6, level_7, level_8, level_9, level_10][victim - 5] * 100.0 / (1 + helpers)
    WHEN type = 'ELITE_MONSTER_KILL' THEN 150.0 WHEN type = 'WARD_KILL' AND k % 2 = 0 THEN 38.0 ELSE 0.0 END::DOUBLE AS xp_gain
FROM levelled WHERE type <> 'PARTICIPANT_FRAME'
""")
def experience_gains(t: Tables) -> DataFrame:
    """Experience every event gives, by the level of the player who fell."""
    amounts = {"ELDER_DRAGON": 300, "DRAGON": 150, "HORDE": 75, "RIFTHERALD": 300, "BARON_NASHOR": 1400, "CONTROL_WARD": 38}
    wide = with_player_state(built_events(t))
    for_kill = level_of(F.col("victimId").cast("int")) * 100 / (1 + F.col("numberOfAssists"))
    return wide.select("matchId", "eventId", xp_gain(amounts, for_kill).alias("xp_gain"))
