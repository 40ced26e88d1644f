"""Golden timelines, worked out by hand."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chronofold.plans import schemas as S
from chronofold.plans import enrich
from chronofold.plans.enrich import match_snapshots, snapshot, with_player_state
from chronofold.plans.timeline import CONSUMABLES, timeline_events


def events_of(spark, frames, **options):
    doc = json.dumps({"metadata": {"matchId": "M"}, "info": {"frames": frames}})
    df = spark.createDataFrame([(doc,)], "j string").select(F.from_json("j", S.TIMELINE).alias("d")).select(
        F.col("d.metadata.matchId").alias("matchId"), F.col("d.info.frames").alias("frames"))
    return timeline_events(df, **options)


def frame(t, events=(), players=(1,), **values):
    each = {str(p): {"xp": t // 1000 + p, "position": {"x": p, "y": t}, **values} for p in players}
    return {"timestamp": t, "participantFrames": each, "events": list(events)}


def item(kind, t, pid, item_id=None):
    return {"type": f"ITEM_{kind}", "timestamp": t, "participantId": pid, "itemId": item_id}


def held(rows):
    """Item counts after each item event."""
    return [{i: c for i, c in zip(r.inventoryIds, r.inventoryCounts) if i} for r in rows if r.inventoryIds]


@pytest.mark.parametrize("events,expected", [
    ([item("PURCHASED", 1, 1, 7), item("PURCHASED", 9, 1, 8), item("DESTROYED", 9, 1, 7), item("UNDO", 20, 1)],
     [{7: 1}, {}, {8: 1}, {7: 1}]),
    ([item("PURCHASED", 1, 1, 7), item("SOLD", 2, 1, 7), item("UNDO", 3, 1)], [{7: 1}, {}, {7: 1}]),
    ([item("SOLD", 2, 1, 7)], [{}]),
    ([item("UNDO", 2, 1), item("PURCHASED", 3, 1, 7)], [{}, {7: 1}]),
    ([item("PURCHASED", 5, 1, 2003), item("DESTROYED", 5, 1, 2003), item("UNDO", 6, 1)], [{2003: 1}, {}, {}]),
    ([item("PURCHASED", 1, 1, 7), item("DESTROYED", 2, 1, 7), item("PURCHASED", 9, 1, 8), item("UNDO", 20, 1)],
     [{7: 1}, {}, {8: 1}, {}]),
])
def test_inventory_cases(spark, events, expected):
    rows = events_of(spark, [frame(0, events)]).orderBy("eventId").collect()
    assert held(rows) == expected


def test_consumables_are_bought_before_they_vanish(spark):
    assert 2003 in CONSUMABLES
    rows = events_of(spark, [frame(0, [item("DESTROYED", 5, 1, 2003), item("PURCHASED", 5, 1, 2003)])]).orderBy("eventId").collect()
    assert [r.type for r in rows][1:] == ["ITEM_PURCHASED", "ITEM_DESTROYED"]


def test_more_than_eight_items_stay_whole(spark):
    rows = events_of(spark, [frame(0, [item("PURCHASED", i, 1, 100 + i) for i in range(1, 11)])]).orderBy("eventId").collect()
    assert len(rows[-1].inventoryIds) == 10 and len(rows[1].inventoryIds) == 8


def test_starter_item_goes_to_the_two_supports(spark):
    given = [item("PURCHASED", 0, 0, 3865)] * 3
    rows = events_of(spark, [frame(0, given)]).where("type LIKE 'ITEM%'").orderBy("eventId").collect()
    assert [r.participantId for r in rows] == [5, 10, 0]
    assert rows[2].inventoryIds is None


def test_starter_item_skips_a_support_who_has_it(spark):
    rows = events_of(spark, [frame(0, [item("PURCHASED", 0, 5, 3865), item("PURCHASED", 0, 0, 3865)])]).where(
        "type LIKE 'ITEM%'").orderBy("eventId").collect()
    assert [r.participantId for r in rows] == [5, 10]


def kill(t=1000, assists=(2, 3)):
    event = {"type": "CHAMPION_KILL", "timestamp": t, "killerId": 1, "victimId": 6, "position": {"x": 9, "y": 9}}
    return event | ({"assistingParticipantIds": list(assists)} if assists is not None else {})


def test_kill_implies_assists_death_and_respawn(spark):
    level = [{"type": "LEVEL_UP", "timestamp": t, "participantId": 6, "level": n} for t, n in ((900, 2), (900, 3), (1500, 4))]
    timer = lambda level, minutes: level * 100
    rows = events_of(spark, [frame(0, [kill(), *level])], death_timer=timer).where("type NOT IN ('LEVEL_UP', 'PARTICIPANT_FRAME')").orderBy("eventId").collect()
    assert [(r.type, r.timestamp, r.participantId, r.killerId, r.numberOfAssists) for r in rows] == [
        ("CHAMPION_KILL", 1000, 1, None, 2), ("CHAMPION_ASSIST", 1000, 2, None, 2), ("CHAMPION_ASSIST", 1000, 3, None, 2),
        ("CHAMPION_KILLED", 1000, 6, 1, 2), ("RESPAWN", 1200, 6, None, None)]


def test_kill_without_assists_counts_zero(spark):
    rows = events_of(spark, [frame(0, [kill(assists=None)])]).where("type = 'CHAMPION_KILL'").collect()
    assert rows[0].numberOfAssists == 0


def test_plate_with_helpers_keeps_its_type(spark):
    plate = {"type": "TURRET_PLATE_DESTROYED", "timestamp": 5, "killerId": 1, "assistingParticipantIds": [2]}
    rows = events_of(spark, [frame(0, [plate])]).where("type LIKE 'TURRET%'").orderBy("eventId").collect()
    assert [(r.participantId, r.numberOfAssists) for r in rows] == [(1, None), (2, None)]


def test_derived_events_can_be_numbered_last(spark):
    later = {"type": "GAME_END", "timestamp": 5000, "winningTeam": 100}
    rows = events_of(spark, [frame(0, [kill(), later])], event_id_mode="append").orderBy("eventId").collect()
    assert [r.type for r in rows] == ["PARTICIPANT_FRAME", "CHAMPION_KILL", "GAME_END", "CHAMPION_ASSIST", "CHAMPION_ASSIST", "CHAMPION_KILLED"]
    with pytest.raises(ValueError):
        events_of(spark, [frame(0)], event_id_mode="other")


def test_special_champion_shops_where_it_stands(spark):
    frames = [frame(0, players=(1, 2)), frame(60_000, [item("PURCHASED", 50_000, 1, 7), item("PURCHASED", 50_000, 2, 7)], players=(1, 2))]
    doc = json.dumps({"metadata": {"matchId": "M"}, "info": {"frames": frames}})
    df = spark.createDataFrame([(doc,)], "j string").select(F.from_json("j", S.TIMELINE).alias("d")).select(
        F.lit("M").alias("matchId"), F.col("d.info.frames").alias("frames"),
        F.create_map(F.lit(1), F.lit("Smith"), F.lit(2), F.lit("Other")).alias("champions"))
    rows = timeline_events(df, champions="champions", special_champion="Smith", positions={"low_spawn": (3, 4)}).where(
        "type LIKE 'ITEM%'").orderBy("participantId").collect()
    assert [(r.positionX, r.positionY) for r in rows] == [(1, 60_000), (3, 4)]


def test_building_events_needs_no_exchange(spark):
    plan = events_of(spark, [frame(0)])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_state_is_per_match_and_a_missing_player_is_null(spark):
    rows = events_of(spark, [frame(0, players=(1, 2)), frame(60_000, [kill(61_000, None)], players=(2,))])
    row = with_player_state(rows).where("type = 'CHAMPION_KILL'").first()
    assert (row.xp_1, row.xp_2, row.level_1) == (None, 62, 1)


def test_short_match_has_no_snapshot_and_no_kills_is_zero(spark):
    columns = {c: F.lit(None).cast("string") for c in ("gameStartTimestamp", "patch", "platformId")}
    long = with_player_state(events_of(spark, [frame(0), frame(900_000, [{"type": "GAME_END", "timestamp": 950_000, "winningTeam": 200},
                                                                         {"type": "WARD_KILL", "timestamp": 800_000, "killerId": 1}])]))
    wide = long.withColumns(columns)
    prefixes = ("xp",)
    row = snapshot(wide, prefixes=prefixes).first()
    assert (row.timestamp, row.winningTeam, row.kills_1, row.xp_1) == (800_000, 200, 0, 1)
    assert snapshot(wide.where("timestamp < 900000"), prefixes=prefixes).count() == 0


def random_match_events(seed, matches=6, n=400):
    """Events of every kind that a snapshot counts or follows, ties in time included."""
    rng = random.Random(seed)
    kinds = ["CHAMPION_KILL", "CHAMPION_ASSIST", "BUILDING_KILL", "ELITE_MONSTER_KILL", "ITEM_PURCHASED", "ITEM_UNDO", "LEVEL_UP", "WARD_KILL", "GAME_END"]
    out = []
    for m in range(matches):
        times = sorted(rng.randrange(0, 60) * 1000 for _ in range(n))
        for i, at in enumerate(times):
            kind = rng.choice(kinds) if rng.random() < 0.7 else "PARTICIPANT_FRAME"
            framed, held = kind == "PARTICIPANT_FRAME", kind.startswith("ITEM")
            pid = rng.choice([None, *range(1, 11)]) if not framed else rng.randrange(1, 11)
            out.append((
                f"M{m}", i, at, kind, pid, rng.choice([None, *range(1, 11)]), rng.choice(["TOWER_BUILDING", "OTHER"]), rng.choice(enrich.TOWERS), rng.choice(enrich.MONSTERS),
                rng.choice([None, *enrich.DRAGONS]), rng.choice([100, 200]) if kind == "GAME_END" else None, rng.choice([None, 2, 3]) if kind == "LEVEL_UP" else None,
                [rng.randrange(9)] if held else None, [1] if held else None, at if framed else 5, i if framed else None))
    return out


@pytest.mark.parametrize("at", [30_000, 57_000, 100_000])
def test_snapshots_without_windows_equal_those_of_wide_events(spark, at):
    schema = ("matchId string, eventId int, timestamp int, type string, participantId int, victimId int, buildingType string, towerType string, monsterType string, "
              "monsterSubType string, winningTeam int, level int, inventoryIds array<int>, inventoryCounts array<int>, positionX int, xp int")
    events = spark.createDataFrame(random_match_events(at), schema).repartition(4)
    events = events.withColumns({c: F.lit(None).cast("int") for c in enrich.FRAME_COLUMNS if c not in ("positionX", "xp")})
    participants = spark.createDataFrame([(f"M{m}", p, m * 20 + p) for m in range(6) for p in range(1, 11)], "matchId string, participantId int, championId int")
    participants = participants.withColumns({c: F.lit(1) for c in enrich.PREGAME_COLUMNS if c != "championId"})
    matches = spark.createDataFrame([(f"M{m}", m, "14.1", "X") for m in range(5)], "matchId string, gameStartTimestamp int, patch string, platformId string")
    prefixes = ("xp", "positionX", "level", "inventoryIds", "inventoryCounts", "championId")
    wide = enrich.enriched_events(events, participants, matches)
    expected = snapshot(wide, at=at, tolerance=1000, prefixes=prefixes)
    got = match_snapshots(events, participants, matches, at=at, tolerance=1000, prefixes=prefixes)
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert (got.count() > 0) == (at < 100_000)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_documents_are_written_by_tasks_of_a_bounded_number_of_customers(spark, monkeypatch):
    """Narrow customers are one file; their wide documents must not come from one task."""
    from chronofold.suite import timelines
    from chronofold.suite.base import Tables

    monkeypatch.setattr(timelines, "_LANDED", {})
    monkeypatch.setattr(timelines, "LANDED_ROWS", 30)
    tables = Tables(spark, "/root/testdata/sf0.001")
    documents = timelines.timeline_documents(tables)
    written = documents.inputFiles()
    assert len(written) >= 4
    assert documents.select("matchId").distinct().count() == documents.count() == tables.customer.count()
