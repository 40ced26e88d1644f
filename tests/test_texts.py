"""Scalar expressions, linking rules and streams."""

import datetime as dt
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from chronofold.functions import text as X
from chronofold.functions import values as V
from chronofold.plans.grounding import _met_in_row, events_of_hints, expand_aliases, gazetteer_references, hint_candidates, link
from chronofold.streaming.flows import replayed_items, require_current
from tests.test_ordered import item_rows, plain_replay


def value(spark, column, text=None):
    return spark.createDataFrame([(text,)], "c string").select(column.alias("v")).first().v


@pytest.mark.parametrize("name", ["A B", "é/ü", "a%b&c+d*e~f'g!h@i(j)"])
def test_page_url_quotes_like_rfc_3986(spark, name):
    assert value(spark, X.page_url("u:", F.col("c")), name) == "u:" + quote(name.replace(" ", "_"))


@pytest.mark.parametrize("uri,body,hint", [
    ("/a/patch-26.06.txt", "", "26.06"), ("/a/26.06", "", None), ("/a/x.json", "on 14.3 we", "14.3"),
    ("/a/x.json", "v1234.5 no", None), ("/a/x", "z" * 1999 + " 14.3", None), ("/a/Patch_25.1.md", "14.3", "25.1"),
])
def test_patch_hint(spark, uri, body, hint):
    df = spark.createDataFrame([(uri, body)], "u string, b string")
    assert df.select(X.patch_hint(F.col("u"), F.col("b")).alias("v")).first().v == hint


@pytest.mark.parametrize("numeral,number", [("I", 1), ("XIV", 14), ("MCMXCIV", 1994), ("X?I", 11), ("", 0)])
def test_roman(spark, numeral, number):
    assert value(spark, X.roman_to_int(F.col("c")), numeral) == number


@pytest.mark.parametrize("reply,slots", [
    ('x {"teams": [" A ", ""], "event": "", "game_number": 2} y', (["A"], None, 2)),
    ('{"teams": [], "game_number": "two"}', ([], None, None)), ("nothing", None), ('{"teams": [', None), ("{bad}", None),
])
def test_reply_slots(spark, reply, slots):
    got = value(spark, X.reply_slots(F.col("c")), reply)
    assert (got and (got.teams, got.event, got.game_number)) == slots


def test_small_expressions(spark):
    assert value(spark, X.comma_list(F.col("c")), "a,,b") == ["a", "b"]
    assert value(spark, X.comma_list(F.col("c")), "") is None
    assert value(spark, X.yes_no(F.col("c")), " TRUE ") == "Yes" and value(spark, X.yes_no(F.col("c"))) == "No"
    assert value(spark, X.joined("_", F.lit("a"), F.col("c"))) is None
    assert value(spark, V.padded(F.array(F.lit(1)), 3)) == [1, 0, 0]
    assert value(spark, V.lenient_timestamp(F.col("c")), "2025-08-31 18:42:00Z") == dt.datetime(2025, 8, 31, 18, 42)
    assert value(spark, V.lenient_timestamp(F.col("c")), "soon") is None
    assert value(spark, V.compact_date(F.col("c")), "20251301") is None
    day = F.lit("2026-02-01").cast("date")  # a Sunday
    assert value(spark, V.sunday_of(day)) == dt.date(2026, 2, 1) and value(spark, V.monday_of(day)) == dt.date(2026, 1, 26)
    assert value(spark, V.partition_parts(day)["week_of"]) == "20260201"
    assert value(spark, V.safe_ratio(F.lit(3), F.lit(0))) == 0.0


def linked(spark, documents, candidates):
    docs = spark.createDataFrame(documents, "id long, at string, teams array<string>, event string").withColumn("at", F.col("at").cast("timestamp"))
    cand = spark.createDataFrame(candidates, "match_id string, team1 string, team2 string, datetime_utc string, tournament string, patch string")
    results = []
    for limit in (1_000_000, 2):
        found = link(docs, cand, key="id", published="at", teams="teams", event="event", max_rows=limit)
        results.append({r.id: r.match_id for r in found.collect()})
    assert results[0] == results[1]
    return results[0]


def test_link_rules(spark):
    candidates = [
        ("old", "A", "B", "2026-01-01 00:00:00", "Spring Cup", None), ("mid", "b", " a ", "2026-01-20 00:00:00", "League", None),
        ("new", "A", "B", "2026-02-01 00:00:00", "Spring Cup", None), ("tie", "A", "B", "2026-02-01 00:00:00", "League", None),
        ("bad", "A", "B", "someday", "League", None), ("self", "C", "C", "2026-01-20", "League", None),
    ]
    documents = [
        (1, "2026-01-31 00:00:00", ["B", "A"], None),          # both window edges: old is 30 days before, new one day after
        (2, "2026-01-31 00:00:01", ["A", "b"], "spring"),      # old fell out, the event prefers new
        (3, "2026-01-21 00:00:00", ["A", "B"], "spring"),      # event beats the nearer match
        (4, "2026-01-21 00:00:00", ["A", "B"], "winter"),      # a hint that fits nothing is ignored
        (5, "2026-01-21 00:00:00", ["A"], None), (6, "2026-01-21 00:00:00", ["A", " a"], None),
        (7, "2026-01-21 00:00:00", ["A", "B", "C"], None), (8, "2026-03-05 00:00:00", ["A", "B"], None),
        (9, "2026-01-20 00:00:00", ["C", "c"], None), (10, None, ["A", "B"], None),
    ]
    got = linked(spark, documents, candidates)
    assert got == {1: "new", 2: "new", 3: "old", 4: "mid", 5: None, 6: None, 7: None, 8: None, 9: None, 10: None}


def test_ambiguous_alias_multiplies_and_unknown_drops(spark):
    matches = spark.createDataFrame([("m", "T", "U"), ("n", "T", "?")], "match_id string, team1 string, team2 string")
    aliases = spark.createDataFrame(
        [("T", "T", "team"), ("T", "V", "team"), ("tee", "T", "team"), ("U", "U", "team"), ("T", "p", "person")],
        "alias string, entity_id string, entity_type string")
    rows = sorted((r.match_id, r.team1, r.team2) for r in expand_aliases(matches, aliases).collect())
    assert rows == [("m", "T", "U"), ("m", "T", "U"), ("m", "tee", "U")]


def test_gazetteer_multi_word_names(spark):
    docs = spark.createDataFrame([(1, "KC beat Team  Liquid, kc!"), (2, "nothing")], "id long, body string")
    names = spark.createDataFrame([("KC", "k"), ("Karmine Corp", "k"), ("Team Liquid", "l")], "alias string, entity_id string")
    got = {r.id: r.teams for r in gazetteer_references(docs, names, key="id", text="body").collect()}
    assert got == {1: ["kc", "team liquid"]}


def test_current_window_guard():
    day = dt.date
    require_current(day(2026, 2, 3), day(2026, 2, 1), day(2026, 2, 8))
    with pytest.raises(ValueError, match="no history"):
        require_current(day(2026, 2, 8), day(2026, 2, 1), day(2026, 2, 8))


def test_stream_replay_carries_state_across_batches(spark, tmp_path):
    rows = sorted(item_rows(9, 200), key=lambda r: r[1])
    # Three files in time order, no tick divided between two of them.
    bounds = [(0, 50), (50, 100), (100, 1000)]
    schema = "k string, t long, kind string, item long, id long, at timestamp"
    for i, (low, high) in enumerate(bounds):
        part = [(*r, dt.datetime(2026, 1, 1) + dt.timedelta(seconds=r[1])) for r in rows if low <= r[1] < high]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        replayed_items(stream.withColumn("over", F.lit(False)), str(tmp_path / "out"), str(tmp_path / "check"),
                       owner=["k"], tick="t", kind="kind", item="item", ordinal="id", ended="over").awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    log, _ = plain_replay(rows)
    assert sorted((r.k, r.id, r.step, r.item, r.held) for r in got) == sorted(log)


def test_stream_replay_forgets_an_ended_owner(spark, tmp_path):
    schema = "k string, t long, kind string, item long, id long, over boolean"
    for rows in ([("a", 1, "ITEM_PURCHASED", 7, 1, None), ("b", 1, "ITEM_PURCHASED", 7, 2, None)], [("a", 2, "GAME_END", None, 3, True)],
                 [("a", 3, "ITEM_UNDO", None, 4, None), ("b", 3, "ITEM_UNDO", None, 5, None), ("a", 4, "ITEM_PURCHASED", 7, 6, None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        replayed_items(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"),
                       owner=["k"], tick="t", kind="kind", item="item", ordinal="id", ended="over").awaitTermination()
    got = sorted((r.k, r.id, r.item, r.held) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", 1, 7, 1), ("a", 6, 7, 1), ("b", 2, 7, 1), ("b", 5, 7, 0)]


def test_stream_replay_closes_an_idle_owner(spark, tmp_path):
    """An owner's state goes once the watermark is past its idle time; another one's that stays busy is kept, and nothing of it is read."""
    schema = "k string, t long, kind string, item long, id long, over boolean, at timestamp"
    moment = lambda hour: dt.datetime(2026, 1, 1, hour)
    batches = [
        [("a", 1, "ITEM_PURCHASED", 7, 1, None, moment(1)), ("b", 1, "ITEM_PURCHASED", 7, 2, None, moment(1))],
        [("b", 2, "ITEM_PURCHASED", 8, 3, None, moment(9))],
        [("b", 3, "ITEM_PURCHASED", None, 4, None, moment(10))],
        [("a", 4, "ITEM_UNDO", None, 5, None, moment(10)), ("b", 4, "ITEM_UNDO", None, 6, None, moment(11)), ("b", 4, "ITEM_UNDO", None, 7, None, moment(11))],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        replayed_items(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"), owner=["k"], tick="t",
                       kind="kind", item="item", ordinal="id", ended="over", event_time="at", idle=dt.timedelta(hours=5)).awaitTermination()
    got = sorted(((r.k, r.id, r.item, r.held) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)
    # a's purchase can no longer be taken back; b's last two can.
    assert got == sorted([("a", 1, 7, 1), ("b", 2, 7, 1), ("b", 3, 8, 1), ("b", 4, None, 1), ("b", 6, None, 0), ("b", 7, 8, 0)], key=str)


@pytest.mark.parametrize("terms_in_row", [0, 100])
def test_names_in_texts(spark, terms_in_row):
    """Runs of words that are names are found, by both ways, and in rows only they come out."""
    texts = [(1, "The Red Lions beat Blue; the red lions again. Blue"), (2, "lions red"), (3, None), (4, ""), (5, "  Blue  "), (None, "red-lions"), (6, "Red Lions Academy")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "id long, text string, alias string")
    names = spark.createDataFrame([("Red Lions", "a"), ("red  lions", "a"), ("BLUE", "b"), ("Red Lions Academy", "c"), ("--", "d"), (None, "e")], "alias string, entity_id string")
    out = gazetteer_references(docs, names, key="id", text="text", terms_in_row=terms_in_row)
    assert {(r.id, tuple(r.teams)) for r in out.collect()} == {
        (1, ("red lions", "blue")), (5, ("blue",)), (None, ("red lions",)), (6, ("red lions", "red lions academy"))}
    assert out.columns == ["id", "teams", "event", "game_number"]
    none = gazetteer_references(docs, names.limit(0), key="id", text="text")
    assert none.count() == len(texts) and none.where("size(teams) > 0").count() == 0


def test_only_names_come_out_of_rows(spark):
    words = spark.range(1000).select("id", F.array(*[F.concat(F.lit(w), (F.col("id") % 7).cast("string")) for w in "abcdefgh"]).alias("_words"))
    met = _met_in_row(words, "id", ["a3 b3", "c5", "zz", "h1 a1", "g2 h2 i2"]).collect()
    assert {(r.id % 7, r._at, r._term) for r in met} == {(3, 1, "a3 b3"), (5, 3, "c5")}
    assert len(met) == sum(1 for i in range(1000) if i % 7 in (3, 5))


def test_hints_and_events_do_not_meet_as_a_product(spark):
    hints = spark.range(1000).select(F.concat(F.lit("cup "), F.format_string("%04d", "id")).alias("_hint"))
    events = spark.range(1000).select(F.concat(F.lit("great cup "), F.format_string("%04d", "id"), F.lit(" final")).alias("_event"))
    met = hint_candidates(hints, events)
    assert 1000 <= met.count() < 100_000
    assert events_of_hints(hints, events).count() == 1000


def test_hints_of_any_length(spark):
    hints, events = ["a", "xy", "ab", "cup", "", "worlds 20", "éa", "zzz", None], ["a cup", "worlds 2024 xyz", "", "éab", "cu", None]
    got = events_of_hints(*(spark.createDataFrame([(x,) for x in rows], f"{name} string") for rows, name in ((hints, "_hint"), (events, "_event"))))
    assert {tuple(r) for r in got.collect()} == {(h, e) for h in hints if h for e in events if e and h in e}


def test_first_within_shares_calls_among_keys(spark, tmp_path, monkeypatch):
    """Keys of one bucket keep their own state; null keys and whole numbers beyond doubles come out as they went in."""
    from chronofold.streaming import flows

    schema = "user long, id long, at timestamp"
    day = lambda n: dt.datetime(2026, 1, 1) + dt.timedelta(days=n)
    big = 2**60 + 1
    monkeypatch.setattr(flows, "FIRST_BUCKETS", 1)
    batches = [
        [(u, big + u, day(20)) for u in range(50)] + [(None, None, day(20)), (None, big, day(21)), (7, 1, None)],
        [(u, u, day(25)) for u in range(50)] + [(None, 3, day(31)), (3, 4, day(9))],
        [(5, 6, day(40)), (6, 7, day(20))],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        marked = flows.first_within(stream, ["user"], "at", dt.timedelta(days=10), order=["id"])
        flows.late_and_first(marked, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = {(r.user, r.id, str(r.late)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(u, big + u, "false") for u in range(50)} | {
        (None, None, "false"), (None, 3, "false"), (3, 4, "true"), (5, 6, "false"), (6, 7, "true")}


def test_stream_replay_shares_calls_among_owners(spark, tmp_path, monkeypatch):
    """Owners of one bucket keep their own state over blocks of remembered events; null owners, ticks and large numbers come out as they went in."""
    from chronofold.streaming import flows

    monkeypatch.setattr(flows, "OWNER_BUCKETS", 1)
    monkeypatch.setattr(flows, "REMEMBERED_BLOCK", 2)
    big = (1 << 60) + 1
    schema = "k long, t long, kind string, item long, id long, over boolean"
    buy = lambda k, t, i: (k, t, "ITEM_PURCHASED", big + i, big + i, None)
    batches = [
        [buy(k, t, 10 * t + n) for n, k in enumerate((big, big + 1, None)) for t in range(7)] + [(3, None, "ITEM_DESTROYED", 5, None, None)],
        [(big, 8, "ITEM_UNDO", None, 100 + n, None) for n in range(6)] + [(None, 8, "ITEM_UNDO", None, 200, None), buy(3, 8, 90)],
        [(big, 9, "ITEM_UNDO", None, 300 + n, None) for n in range(3)] + [(None, 9, "ITEM_UNDO", None, 400 + n, None) for n in range(2)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        flows.replayed_items(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"),
                             owner=["k"], tick="t", kind="kind", item="item", ordinal="id", ended="over").awaitTermination()
    got = {(r.k, r.t, r.id, r.item, r.held) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    bought = {(k, t, big + 10 * t + n, big + 10 * t + n, 1) for n, k in enumerate((big, big + 1, None)) for t in range(7)}
    back = {(big, 8, 100 + n, big + 10 * (6 - n), 0) for n in range(6)} | {(big, 9, 300, big, 0)}
    back |= {(None, 8, 200, big + 62, 0), (None, 9, 400, big + 52, 0), (None, 9, 401, big + 42, 0)}
    assert got == bought | back | {(3, None, None, 5, 0), (3, 8, big + 90, big + 90, 1)}
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(got)
