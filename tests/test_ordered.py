"""Lanes, as-of joins and replay against brute force, with and without heavy keys."""

import random

import pytest
from pyspark.sql import functions as F

from chronofold.operators.asof import asof_join, nearest_join
from chronofold.operators.counts import histogram
from chronofold.operators.lanes import (
    SLICE, Lane, following, known_after, last_known, last_known_at, next_known, preceding, running_min, running_sum,
)
from chronofold.operators.replay import final_items, item_changes
from chronofold.operators.select import stratified_split, top_per_key
from chronofold.plans.timeline import DESTROYED, PURCHASED, SOLD, UNDO

#: One limit that no key reaches and one that makes the hot key heavy.
LIMITS = [10_000, 25]


def skewed_rows(seed=1, n=400):
    """Rows (key, time, id, value); key 'hot' holds more than half of them, times repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(6)}"
        rows.append((key, rng.randrange(250), i, rng.choice([None, rng.randrange(100)])))
    return rows


@pytest.mark.parametrize("limit", LIMITS)
def test_scan_steps(spark, limit):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k string, t long, id long, v long").repartition(5)
    lane = Lane(["k"], ["t", "id"], max_rows=limit)
    got = lane.run(
        df,
        total=running_sum(F.coalesce("v", F.lit(0))), low=running_min(F.col("v")), last=last_known(F.col("v")),
        peers=last_known_at(F.col("v")), nxt=next_known(F.col("v")), after=known_after(F.col("v")),
        lead=following(F.col("id")), lag=preceding(F.col("id")),
    ).collect()
    assert len(got) == len(rows)
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    for g in got:
        group = groups[g.k]
        at = next(i for i, r in enumerate(group) if r[2] == g.id)
        values = [r[3] for r in group]
        known = lambda part: [v for v in part if v is not None]
        peers = [r[3] for r in group if r[1] <= g.t]
        assert g.total == sum(v or 0 for v in values[: at + 1])
        assert g.low == (min(known(values[: at + 1])) if known(values[: at + 1]) else None)
        assert g.last == (known(values[: at + 1]) or [None])[-1]
        assert g.peers == (known(peers) or [None])[-1]
        assert g.nxt == (known(values[at:]) or [None])[0]
        assert g.after == (known(values[at + 1:]) or [None])[0]
        assert (g.lead.id if g.lead else None) == (group[at + 1][2] if at + 1 < len(group) else None)
        assert (g.lag.id if g.lag else None) == (group[at - 1][2] if at else None)


def test_bursts_are_cut_again(spark):
    """Nearly all rows of the key fall into a thousandth of its time span."""
    rows = [("hot", 1_000_000 * (i % 50 == 0) + i, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, t long, id long")
    lane = Lane(["k"], ["t", "id"], max_rows=50)
    sizes = [r["count"] for r in lane.slice(df).groupBy(SLICE).count().collect()]
    assert max(sizes) <= 50
    numbered = {r.id: r.n for r in lane.number(df, "n").collect()}
    ordered = sorted(rows, key=lambda r: (r[1], r[2]))
    assert all(numbered[r[2]] == i + 1 for i, r in enumerate(ordered))


@pytest.mark.parametrize("limit", LIMITS)
def test_asof_and_nearest(spark, limit):
    left = spark.createDataFrame([r[:3] for r in skewed_rows(2)], "k string, t long, id long")
    right_rows = skewed_rows(3)
    right = spark.createDataFrame(right_rows, "k string, t long, rid long, v long")
    back = asof_join(left, right, by=["k"], on="t", payload=["rid", "v"], tie=["rid"], max_rows=limit, matched_at="at").collect()
    near = nearest_join(left, right, by=["k"], on="t", payload=["rid", "v"], tie=["rid"], max_rows=limit).collect()
    assert len(back) == len(near) == left.count()
    for row in back:
        fits = [r for r in right_rows if r[0] == row.k and r[1] <= row.t]
        best = max(fits, key=lambda r: (r[1], r[2]), default=None)
        assert (row.rid, row.v, row.at) == ((best[2], best[3], best[1]) if best else (None, None, None))
        assert row.at is None or row.at <= row.t
    for row in near:
        fits = [r for r in right_rows if r[0] == row.k]
        best = min(fits, key=lambda r: (abs(r[1] - row.t), r[1], r[2]), default=None)
        assert (row.rid, row.v) == ((best[2], best[3]) if best else (None, None))


def test_asof_needs_whole_rows(spark):
    """A null in the matched row is not replaced by an older row's value."""
    left = spark.createDataFrame([("a", 5)], "k string, t long")
    right = spark.createDataFrame([("a", 1, 7), ("a", 3, None)], "k string, t long, v long")
    assert asof_join(left, right, by=["k"], on="t", payload=["v"]).first().v is None


def test_lane_rejects_text_order(spark):
    with pytest.raises(TypeError):
        Lane(["k"], ["s"]).slice(spark.createDataFrame([("a", "b")], "k string, s string"))


def item_rows(seed, n=500):
    rng = random.Random(seed)
    kinds = [PURCHASED, PURCHASED, SOLD, DESTROYED, DESTROYED, UNDO, UNDO]
    return [("hot" if rng.random() < 0.6 else f"p{rng.randrange(4)}", rng.randrange(150), rng.choice(kinds),
             rng.choice([1, 2, 3, 2003]), i) for i in range(n)]


def plain_replay(rows):
    """Each owner's events as entries that can be taken back, newest first: (sign, item, items used up by a purchase)."""
    rank = lambda r: ("A" if r[2] == PURCHASED else "Z" if r[2] == DESTROYED else r[2]) if r[3] == 2003 else r[2]
    held, log = {}, []
    for owner in sorted({r[0] for r in rows}):
        entries, own = [], held.setdefault(owner, {})
        for _, tick, kind, item, ordinal in sorted((r for r in rows if r[0] == owner), key=lambda r: (r[1], rank(r), r[4])):
            changes = []
            if kind == PURCHASED:
                used = []
                while entries and entries[-1][3] == ("used up", tick):
                    used.append(entries.pop()[1])
                entries.append((1, item, used, None))
                changes = [(item, 1)]
            elif kind in (SOLD, DESTROYED):
                entries.append((-1, item, [], ("used up" if kind == DESTROYED else "sold", tick)))
                changes = [(item, -1)]
            elif entries:
                sign, gone, used, why = entries.pop()
                if sign > 0:
                    changes = [(gone, -1), *[(i, 1) for i in used]]
                elif why[0] == "sold":
                    changes = [(gone, 1)]
            for step, (what, by) in enumerate(changes):
                own[what] = max(0, own.get(what, 0) + by)
                log.append((owner, ordinal, step, what, own[what]))
    return log, {(k, i): c for k, own in held.items() for i, c in own.items() if c}


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("seed", [5, 6])
def test_item_changes_equal_plain_replay(spark, limit, seed):
    rows = item_rows(seed)
    df = spark.createDataFrame(rows, "k string, t long, kind string, item long, id long").repartition(4)
    args = dict(by=["k"], tick="t", item="item", ordinal="id")
    changes = item_changes(df, kind="kind", max_rows=limit, **args)
    log, held = plain_replay(rows)
    # A tick's destroyed items come back in either order; compare the counts reached per event and item.
    last = lambda entries: {(k, i, item): c for k, i, _, item, c in sorted(entries, key=lambda e: e[2])}
    got = [(r.k, r.id, r.step, r.item, r.held) for r in changes.collect()]
    assert len(got) == len(log)
    assert last(got) == last(log)
    assert {(r.k, r.item): r.held for r in final_items(changes, **args).collect()} == held


@pytest.mark.parametrize("limit", LIMITS)
def test_split_is_exhaustive_and_stratified(spark, limit):
    df = spark.range(300).select("id", F.when(F.col("id") < 200, "big").when(F.col("id") < 295, "mid").otherwise("rare").alias("label"))
    rows = stratified_split(df, label="label", group="id", max_rows=limit).collect()
    assert len(rows) == 300 and len({r.id for r in rows}) == 300
    counts = {}
    for r in rows:
        counts[r.label, r.split] = counts.get((r.label, r.split), 0) + 1
    assert counts == {("big", "test"): 40, ("big", "train"): 160, ("mid", "test"): 19, ("mid", "train"): 76,
                      ("rare", "test"): 1, ("rare", "train"): 4}


def test_split_needs_two_of_each_label(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, label string")
    with pytest.raises(Exception, match="fewer than two"):
        stratified_split(df, label="label", group="id").collect()


def test_rank_filter_is_limited_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = top_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_asof_plan_has_one_exchange_of_the_rows_and_no_pairs(spark):
    left = spark.range(100).select((F.col("id") % 5).alias("k"), F.col("id").alias("t"))
    right = left.withColumn("v", F.col("t"))
    joined = asof_join(left, right, by=["k"], on="t", payload=["v"], bounded=True)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("limit", LIMITS)
def test_lane_keeps_rows_without_position_or_key(spark, limit):
    rng = random.Random(2)
    rows = [(rng.choice(["a", None, None]), rng.choice([None, *range(40)]), i, rng.choice([None, i])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t long, id long, v long").repartition(3)
    lane = Lane(["k"], ["t", "id"], max_rows=limit)
    got = {r.id: (r.n, r.v_last, r.v_next) for r in lane.run(
        df, n=running_sum(F.lit(1)), v_last=last_known(F.col("v")), v_next=next_known(F.col("v"))).collect()}
    for key in ("a", None):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for i, r in enumerate(own):
            before = [x[3] for x in own[: i + 1] if x[3] is not None]
            after = [x[3] for x in own[i:] if x[3] is not None]
            assert got[r[2]] == (i + 1, before[-1] if before else None, after[0] if after else None)


@pytest.mark.parametrize("limit", LIMITS)
def test_joins_in_time_match_no_nulls(spark, limit):
    left = spark.createDataFrame([("a", 5, 1), (None, 5, 2), ("a", None, 3)], "k string, t long, id long")
    right = spark.createDataFrame([("a", 4, 10), (None, 4, 20), ("a", None, 30)], "k string, t long, v long")
    for join in (asof_join, nearest_join):
        got = {r.id: r.v for r in join(left, right, by=["k"], on="t", payload=["v"], max_rows=limit).collect()}
        assert got == {1: 10, 2: None, 3: None}


def test_split_keeps_null_labels(spark):
    df = spark.range(60).select("id", F.when(F.col("id") < 40, "x").alias("label"))
    rows = stratified_split(df, label="label", group="id").collect()
    assert len(rows) == 60 and {r.split for r in rows if r.label is None} == {"train", "test"}


def test_histogram_counts_every_value(spark):
    df = spark.createDataFrame([(v,) for v in (-5.0, 0.0, 1.0, 94.9, 95.0, None)], "v double")
    assert {r.bin: r.rows for r in histogram(df, "v", 10).collect()} == {1: 3, 10: 2}
    assert {r.bin: r.rows for r in histogram(df.where("v = 1"), "v", 10).collect()} == {1: 1}
