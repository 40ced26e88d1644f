"""Timeline documents into event rows.

A timeline is one row.  Ordering, derived events and item state are computed with array functions
inside that row and exploded at the end, so building the events table needs no exchange at all and
a group is never larger than the document it came from.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.values import map_bump, padded
from chronofold.plans import schemas as S

# Item ids that are used up on purchase; their purchase sorts first on a tick and
# their destruction last.
CONSUMABLES = (2003, 2010, 2031, 2055, 2138, 2139, 2140, 2150, 2151, 2152, 3400, 3513)

# The item handed out at the start, and the players who receive it.
STARTER_ITEM = 3865
STARTER_PLAYERS = (5, 10)

# Fixed value: slots of an inventory list.
INVENTORY_SIZE = 8

PURCHASED, SOLD, DESTROYED, UNDO = "ITEM_PURCHASED", "ITEM_SOLD", "ITEM_DESTROYED", "ITEM_UNDO"

_EVENT = S.RAW_EVENT.simpleString()
_FRAME = S.FRAME.simpleString()
_HISTORY = "array<struct<kind:string,t:int,item:int>>"
_SNAPSHOT = "array<struct<ord:int,held:map<int,int>>>"
_STATE = f"struct<held:map<int,int>,history:{_HISTORY},seen:{_SNAPSHOT}>"
_HELD = "struct<ids:array<int>,counts:array<int>>"


def sort_type(kind: Column, item: Column) -> Column:
    """Second sort key of events on one tick."""
    consumable = F.coalesce(item.isin(*CONSUMABLES), F.lit(False))
    return (
        F.when(consumable & (kind == PURCHASED), "A")
        .when(consumable & (kind == DESTROYED), "Z")
        .otherwise(kind)
    )


def actor_of(event: Column) -> Column:
    """Who an event belongs to: its creator, killer or participant."""
    return F.coalesce(event["creatorId"], event["killerId"], event["participantId"])


def assist_count(event: Column) -> Column:
    """Number of assisting players on kill events, null on others."""
    ids = F.coalesce(event["assistingParticipantIds"], F.array().cast("array<smallint>"))
    return F.when(event["type"].endswith("_KILL"), F.size(ids))


def _row(t, kind, pid, *, item=None, x=None, y=None, team=None, killer=None, assists=None, event=None, frame=None) -> Column:
    """Working struct.  The leading fields are the sort order; ``ord`` is filled in later."""
    none = F.lit(None)
    pick = lambda value, cast: (none if value is None else value).cast(cast)
    return F.struct(
        t.cast("int").alias("t"),
        F.lit(0).alias("stage"),
        sort_type(kind, pick(item, "int")).alias("rank"),
        F.lit(0).alias("ord"),
        F.lit(0).alias("sub"),
        kind.alias("kind"),
        pid.cast("int").alias("pid"),
        pick(item, "int").alias("item"),
        pick(x, "int").alias("x"),
        pick(y, "int").alias("y"),
        pick(team, "int").alias("team"),
        pick(killer, "int").alias("killer"),
        pick(assists, "int").alias("assists"),
        pick(event, _EVENT).alias("event"),
        pick(frame, _FRAME).alias("frame"),
        none.cast(_HELD).alias("inventory"),
    )


def frame_rows(frames: Column) -> Column:
    """One PARTICIPANT_FRAME row per player and frame."""
    def of_frame(f):
        return F.transform(
            F.map_entries(f["participantFrames"]),
            lambda e: _row(
                f["timestamp"], F.lit("PARTICIPANT_FRAME"), e["key"],
                x=e["value"]["position"]["x"], y=e["value"]["position"]["y"], frame=e["value"],
            ),
        )
    return F.flatten(F.transform(frames, of_frame))


def event_rows(frames: Column) -> Column:
    """One row per timeline event, frames in time order."""
    by_time = F.array_sort(F.transform(frames, lambda f: F.struct(f["timestamp"].alias("t"), f["events"].alias("events"))))
    flat = F.flatten(F.transform(by_time, lambda f: f["events"]))
    return F.transform(
        flat,
        lambda e: _row(
            e["timestamp"], e["type"], actor_of(e), item=e["itemId"],
            x=e["position"]["x"], y=e["position"]["y"], team=e["teamId"], assists=assist_count(e), event=e,
        ),
    )


def ordered(rows: Column) -> Column:
    """Rows numbered by source position and sorted by time, sort type and position."""
    return F.sort_array(F.transform(rows, lambda r, i: r.withField("ord", i)))


def nearest_in(rows: Column, t: Column, value: Callable[[Column], Column]) -> Column:
    """Value of the row nearest in time, the earliest in list order of ties."""
    distances = F.transform(
        rows, lambda r, i: F.struct(F.abs(r["t"] - t).alias("d"), i.alias("i"), value(r).alias("v"))
    )
    return F.array_min(distances)["v"]


def with_default_positions(
    rows: Column, positions: Mapping[str, tuple[int, int]], champions: Column | None, special: str | None
) -> Column:
    """Item events move to the owner's spawn, the dragon soul to the pit.

    ``positions`` may name ``pit``, ``low_spawn`` (players 1-5) and ``high_spawn``; an absent name
    gives nulls.  A player of the ``special`` champion shops anywhere, so item events take the
    player's nearest frame.
    """
    def point(name):
        x, y = positions.get(name, (None, None))
        return F.struct(F.lit(x).cast("int").alias("x"), F.lit(y).cast("int").alias("y"))

    def place(r):
        spawn = F.when(F.coalesce(r["pid"], F.lit(0)) <= 5, point("low_spawn")).otherwise(point("high_spawn"))
        if champions is not None and special is not None:
            own = F.filter(rows, lambda o: (o["kind"] == "PARTICIPANT_FRAME") & (o["pid"] == r["pid"]))
            beside = nearest_in(own, r["t"], lambda o: F.struct(o["x"].alias("x"), o["y"].alias("y")))
            is_special = F.coalesce(F.try_element_at(champions, r["pid"]) == special, F.lit(False))
            spawn = F.when(is_special, beside).otherwise(spawn)
        return (
            F.when(r["kind"] == "DRAGON_SOUL_GIVEN", point("pit"))
            .when(r["kind"].startswith("ITEM_"), spawn)
            .otherwise(F.struct(r["x"].alias("x"), r["y"].alias("y")))
        )

    placed = F.transform(rows, lambda r: F.struct(r.alias("r"), place(r).alias("p")))
    return F.transform(placed, lambda s: s["r"].withField("x", s["p"]["x"]).withField("y", s["p"]["y"]))


def starter_owners(rows: Column) -> Column:
    """Map from the position of an unowned starter-item event to the player who gets it.

    The first of the two starter players without the item receives it.
    """
    first, second = STARTER_PLAYERS
    starters = F.filter(
        rows,
        lambda r: (r["t"] == 0) & (r["item"] == STARTER_ITEM) & r["kind"].startswith("ITEM_")
        & r["pid"].isin(0, first, second),
    )
    start = F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.create_map().cast("map<int,int>").alias("to"))

    def give(s, r):
        unowned = r["pid"] == 0
        to = (
            F.when(~unowned, r["pid"]).when(s["a"] == 0, F.lit(first)).when(s["b"] == 0, F.lit(second)).otherwise(0)
        )
        change = F.when(r["kind"] == PURCHASED, 1).when(r["kind"].isin(SOLD, DESTROYED), -1).otherwise(0)
        moved = lambda count, player: F.greatest(F.lit(0), count + F.when(to == player, change).otherwise(0))
        return F.struct(
            moved(s["a"], first).alias("a"),
            moved(s["b"], second).alias("b"),
            F.when(unowned, F.map_concat(s["to"], F.create_map(r["ord"], to))).otherwise(s["to"]).alias("to"),
        ).cast("struct<a:int,b:int,to:map<int,int>>")

    return F.aggregate(starters, start.cast("struct<a:int,b:int,to:map<int,int>>"), give, lambda s: s["to"])


def with_starter_owners(rows: Column, owners: Column) -> Column:
    """Rows with unowned starter items handed to their players."""
    handed = F.transform(
        rows, lambda r: r.withField("pid", F.coalesce(F.try_element_at(owners, r["ord"]), r["pid"]))
    )
    return F.when(F.size(owners) > 0, handed).otherwise(rows)


def replay(items: Column) -> Column:
    """Held items after each item event of one player, in order.

    PURCHASED adds one; SOLD and DESTROYED take one, not below zero.  UNDO takes back the newest
    remembered event: a purchase is removed and what the same tick destroyed just before it comes
    back, a sale is returned, a destruction is only forgotten.  UNDO with nothing to take back does
    nothing.
    """
    def step(s, e):
        size = F.size(s["history"])
        top = F.try_element_at(s["history"], F.lit(-1))
        below = F.reverse(F.slice(s["history"], F.lit(1), F.greatest(size - 1, F.lit(0))))
        stops = F.array_position(
            F.transform(below, lambda h: ~((h["kind"] == DESTROYED) & (h["t"] == top["t"]))), True
        )
        run = F.when(stops > 0, stops - 1).otherwise(F.size(below).cast("long")).cast("int")
        is_undo = e["kind"] == UNDO
        restored = F.aggregate(
            F.slice(below, F.lit(1), run),
            map_bump(s["held"], top["item"], -1),
            lambda held, h: map_bump(held, h["item"], 1),
        )
        held = (
            F.when(e["kind"] == PURCHASED, map_bump(s["held"], e["item"], 1))
            .when(e["kind"].isin(SOLD, DESTROYED), map_bump(s["held"], e["item"], -1))
            .when(is_undo & (top["kind"] == PURCHASED), restored)
            .when(is_undo & (top["kind"] == SOLD), map_bump(s["held"], top["item"], 1))
            .otherwise(s["held"])
        )
        kept = F.when(top["kind"] == PURCHASED, size - 1 - run).otherwise(size - 1)
        remembered = F.struct(e["kind"].alias("kind"), e["t"].alias("t"), e["item"].alias("item"))
        history = (
            F.when(e["kind"].isin(PURCHASED, SOLD, DESTROYED), F.array_append(s["history"], remembered))
            .when(is_undo & (size > 0), F.slice(s["history"], F.lit(1), kept))
            .otherwise(s["history"])
        )
        now = F.struct(e["ord"].alias("ord"), held.alias("held"))
        # Bound as the element of an array: a lambda evaluates an expression anew wherever it is used.
        bound = F.transform(F.array(now), lambda n: F.struct(
            n["held"].alias("held"), history.alias("history"), F.array_append(s["seen"], n).alias("seen")))
        return F.get(bound, F.lit(0)).cast(_STATE)

    start = F.struct(
        F.create_map().alias("held"), F.array().alias("history"), F.array().alias("seen")
    ).cast(_STATE)
    return F.transform(F.aggregate(items, start, step, lambda s: s["seen"]), _shown)


def _shown(seen: Column) -> Column:
    """Held items as lists, by item."""
    ids = F.array_sort(F.map_keys(seen["held"]))
    return F.struct(
        seen["ord"].alias("ord"),
        padded(ids, INVENTORY_SIZE).alias("ids"),
        padded(F.transform(ids, lambda k: F.try_element_at(seen["held"], k)), INVENTORY_SIZE).alias("counts"),
    )


def inventories(rows: Column) -> Column:
    """Map from event position to the owner's inventory after it, for players 1 to 10."""
    items = F.filter(rows, lambda r: r["kind"].startswith("ITEM_"))
    short = F.transform(
        items,
        lambda r: F.struct(
            r["ord"].alias("ord"), r["pid"].alias("pid"), r["kind"].alias("kind"), r["t"].alias("t"),
            F.coalesce(r["item"], F.lit(0)).alias("item"),
        ),
    )
    of_player = F.transform(
        F.array(*[F.lit(p) for p in S.PLAYERS]), lambda p: replay(F.filter(short, lambda r: r["pid"] == p))
    )
    per_player = F.flatten(of_player)
    return F.map_from_entries(
        F.transform(
            per_player,
            lambda s: F.struct(s["ord"], F.struct(s["ids"].alias("ids"), s["counts"].alias("counts"))),
        )
    )


def with_inventories(rows: Column, held: Column) -> Column:
    """Rows with the inventory of their position."""
    carried = F.transform(rows, lambda r: r.withField("inventory", F.try_element_at(held, r["ord"])))
    return F.when(F.size(held) > 0, carried).otherwise(rows)


def level_rows(rows: Column) -> Column:
    """Level-up rows, the side the respawn timer looks levels up in."""
    return F.filter(rows, lambda r: r["kind"] == "LEVEL_UP")


def derived_rows(rows: Column, levels: Column, death_timer: Callable[[Column, Column], Column] | None) -> Column:
    """Events implied by others: respawns, assists, deaths and bounty starts.

    ``death_timer(level, minutes)`` is the time spent dead in milliseconds as an expression; no
    respawn rows are made without it.
    """
    sources = F.filter(
        rows,
        lambda r: (r["kind"].isin("CHAMPION_KILL", "OBJECTIVE_BOUNTY_PRESTART"))
        | r["event"]["assistingParticipantIds"].isNotNull(),
    )

    def derive(r):
        event, is_kill = r["event"], r["kind"] == "CHAMPION_KILL"
        mark = lambda row, sub: row.withField("stage", F.lit(1)).withField("ord", r["ord"]).withField("sub", sub)
        lists = []
        if death_timer is not None:
            own = F.filter(levels, lambda o: o["pid"] == event["victimId"])
            found = nearest_in(own, r["t"], lambda o: o["event"]["level"])
            level = F.coalesce(F.when(F.size(levels) > 0, found), F.lit(1))
            back_at = r["t"] + death_timer(level, r["t"] / F.lit(60000.0))
            respawn = mark(_row(back_at, F.lit("RESPAWN"), event["victimId"]), F.lit(1))
            lists.append(F.when(is_kill, F.array(respawn)))
        assisting = F.coalesce(event["assistingParticipantIds"], F.array().cast("array<smallint>"))
        kind = F.replace(r["kind"], F.lit("KILL"), F.lit("ASSIST"))
        helped = F.transform(
            assisting,
            lambda pid, i: mark(r.withField("kind", kind).withField("rank", kind).withField("pid", pid.cast("int")), i + 2),
        )
        lists.append(helped)
        died = (
            r.withField("kind", F.lit("CHAMPION_KILLED")).withField("rank", F.lit("CHAMPION_KILLED"))
            .withField("pid", event["victimId"].cast("int")).withField("killer", r["pid"])
        )
        lists.append(F.when(is_kill, F.array(mark(died, F.lit(100)))))
        bounty = mark(_row(event["actualStartTime"], F.lit("OBJECTIVE_BOUNTY_START"), F.lit(None), team=r["team"]), F.lit(101))
        lists.append(F.when(r["kind"] == "OBJECTIVE_BOUNTY_PRESTART", F.array(bounty)))
        return F.flatten(F.filter(F.array(*lists), lambda part: part.isNotNull()))

    return F.flatten(F.transform(sources, derive))


def timeline_events(
    timelines: DataFrame,
    *,
    champions: str | None = None,
    special_champion: str | None = None,
    positions: Mapping[str, tuple[int, int]] | None = None,
    death_timer: Callable[[Column, Column], Column] | None = None,
    event_id_mode: str = "chronological",
) -> DataFrame:
    """Events table of timeline documents (``matchId, frames``).

    ``event_id_mode='append'`` numbers derived events after all others instead of in time order.
    """
    if event_id_mode not in ("chronological", "append"):
        raise ValueError(f"unknown event_id_mode: {event_id_mode}")
    known = F.col(champions) if champions else None
    # Each step is its own projection, so it is computed once per document.  The optimizer would
    # inline a step that is used once, even inside a lambda that runs per element; the steps read
    # in a lambda are therefore also read by a size check around it.
    steps = timelines.withColumn("_rows", ordered(F.concat(frame_rows(F.col("frames")), event_rows(F.col("frames")))))
    steps = steps.withColumn("_rows", with_default_positions(F.col("_rows"), positions or {}, known, special_champion))
    steps = steps.withColumn("_owners", starter_owners(F.col("_rows")))
    steps = steps.withColumn("_rows", with_starter_owners(F.col("_rows"), F.col("_owners")))
    steps = steps.withColumn("_held", inventories(F.col("_rows")))
    steps = steps.withColumn("_rows", with_inventories(F.col("_rows"), F.col("_held")))
    steps = steps.withColumn("_levels", level_rows(F.col("_rows")))
    derived = derived_rows(F.col("_rows"), F.col("_levels"), death_timer)
    everything = F.concat(F.col("_rows"), F.transform(derived, _without_inventory))
    if event_id_mode == "chronological":
        everything = F.sort_array(everything)
    exploded = steps.select("matchId", F.posexplode(everything).alias("_id", "_r"))
    return exploded.select(*_event_columns())


def _without_inventory(row: Column) -> Column:
    """Derived rows of item events do not exist; the field is cleared to keep one struct type."""
    return row.withField("inventory", F.lit(None).cast(_HELD))


def _event_columns() -> list[Column]:
    r = F.col("_r")
    computed = {
        "matchId": F.col("matchId"), "eventId": F.col("_id"), "timestamp": r["t"], "type": r["kind"],
        "participantId": r["pid"], "positionX": r["x"], "positionY": r["y"], "teamId": r["team"],
        "killerId": r["killer"], "itemId": r["item"], "numberOfAssists": r["assists"],
        "inventoryIds": r["inventory"]["ids"], "inventoryCounts": r["inventory"]["counts"],
    }
    in_event, in_frame = S.RAW_EVENT.fieldNames(), S.FRAME.fieldNames()
    columns = []
    for f in S.EVENTS:
        if f.name in computed:
            value = computed[f.name]
        else:
            found = [r["event"][f.name]] if f.name in in_event else []
            found += [r["frame"][f.name]] if f.name in in_frame else []
            value = F.coalesce(*found)
        columns.append(value.cast(f.dataType).alias(f.name))
    return columns
