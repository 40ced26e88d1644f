"""The Jaccard join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronofold.llm import metric
from chronofold.llm.scratch import Scratch

from .cases import SCHEMA, WORD, empty, frame, sentence

UPPER = {c: c + 32 for c in range(65, 91)}


def plain(rows):
    """(id, set size, smallest linked id) of every row; ids may be null."""
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(UPPER))
        sets.append(frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                label[root(i)] = root(j)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            lowest[root(i)] = min(lowest.get(root(i), doc), doc)
    return sorted(((doc, len(s), lowest.get(root(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def answers(df):
    got = metric.joined(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, got.collect()), key=str)


def test_odd_rows(spark):
    df = frame(spark, repeated=True, null_id=True)
    extra = [(7, "a text of its own " * 8, None, None, None, None, None, None, None, None, None), (7, "quite another text " * 9, None, None, None, None, None, None, None, None, None)]
    df = df.union(spark.createDataFrame(extra, SCHEMA))
    assert answers(df) == plain([(r["doc_id"], r["text"]) for r in df.collect()])
    assert answers(empty(spark)) == []
    assert answers(df.filter("text is null")) == plain([(r["doc_id"], None) for r in df.filter("text is null").collect()])


def varied(rng, words, share):
    """A copy with about a share of its words changed."""
    return [f"n{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


def families(seed):
    """Copies at all distances around the limit, chains of copies, a hub with spokes, and texts that share a passage."""
    rng, out = random.Random(seed), []
    for share in (0.005, 0.01, 0.02, 0.03, 0.04, 0.06):
        base = sentence(rng, 150).split()
        out += [varied(rng, base, share) for _ in range(14)]
    step = sentence(rng, 200).split()
    for _ in range(20):
        step = varied(rng, step, 0.02)
        out.append(step)
    hub = sentence(rng, 120).split()
    out.append(hub)
    for _ in range(40):
        spoke = list(hub)
        spoke[rng.randrange(120)] = f"s{rng.randrange(10**9)}"
        spoke[rng.randrange(120)] = f"s{rng.randrange(10**9)}"
        out.append(spoke)
    shared = sentence(rng, 90).split()
    out += [shared + sentence(rng, rng.randrange(5, 60)).split() for _ in range(25)]
    out += [shared[:k] for k in range(60, 90)]
    rng.shuffle(out)
    return [(i, " ".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize(("leaf", "pivots", "share"), [(metric.LEAF, metric.PIVOTS, metric.SHARE_SHINGLES), (6, 3, 500)])
def test_all_links_of_families(spark, monkeypatch, leaf, pivots, share):
    rows = families(leaf)
    monkeypatch.setattr(metric, "BLOCK", 16)
    monkeypatch.setattr(metric, "SAMPLED", 2)
    monkeypatch.setattr(metric.classes, "__defaults__", (metric.DEFAULT, leaf, pivots, share, None))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert answers(df) == plain(rows)


def test_one_region_of_everything(spark):
    """Regions handed in by hand: divisions and blocks alone find all links."""
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(12):
        base = rng.choice(10**6, 100, replace=False)
        for _ in range(10):
            own = base.copy()
            some = rng.random(100) < rng.choice([0.005, 0.01, 0.02, 0.1])
            own[some] = rng.integers(10**6, 10**9, some.sum())
            sets.append(" ".join(map(str, own)))
    tables = Scratch(spark)
    bodies = spark.createDataFrame(list(enumerate(sets)), "nid long, text string")
    members = spark.range(len(sets)).select(F.lit(0).cast("long").alias("region"), F.col("id").alias("nid"), F.lit(97).cast("long").alias("n"))
    got = metric.classes(members, bodies, tables, leaf=5, pivots=4, share=2000).collect()
    label = dict((r["node"], r["class"]) for r in got)
    whole = [r[2] for r in sorted(plain(list(enumerate(sets))))]
    groups = {}
    for i, c in enumerate(whole):
        groups.setdefault(c, set()).add(i)
    mine = {}
    for i in range(len(sets)):
        mine.setdefault(label.get(i, i), set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_linked_sets_share_a_rare_shingle():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        a = np.unique(rng.integers(1, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.r_[a[rng.random(len(a)) < 0.95], rng.integers(1, 1 << 62, int(rng.integers(0, 8))).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 85 * (len(a) + len(b) - both):
            continue
        last = rng.permutation(a)[: int(rng.integers(0, len(a) + 1))]
        ends, rare, short = metric.prefixes(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]), last)
        parts = [(set(rare[i:j].tolist()), set(rare[i:j][short[i:j]].tolist())) for i, j in zip(ends, ends[1:], strict=False)]
        small, large = sorted(((len(s), k) for k, s in enumerate((a, b))))
        assert parts[small[1]][1] & parts[large[1]][0]


def test_windows_hold_all_links():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(40):
        base = rng.choice(400, 60, replace=False)
        sets += [np.unique(np.r_[base[: int(rng.integers(50, 61))], rng.integers(400, 500, 3)]).astype(np.uint64) for _ in range(4)]
    pivots = metric.Pivots(sets[:20:3])
    seen = [metric.window(pivots.common(s), pivots.sizes, len(s), 85) for s in sets]
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                assert (seen[i][1] & seen[j][1]).any()


def test_no_link_leaves_a_region():
    rng = np.random.default_rng(8)
    sets = []
    for _ in range(30):
        base = rng.integers(1, 1 << 62, int(rng.integers(1, 900))).astype(np.uint64)
        sets.append(np.unique(base))
        sets.append(np.unique(np.r_[base[rng.random(len(base)) < 0.93], rng.integers(1, 1 << 62, 2).astype(np.uint64)]))
        sets.append(np.unique(rng.integers(1, 1 << 62, int(rng.integers(1, 900))).astype(np.uint64)))
    sizes = np.array([len(s) for s in sets])
    kept = metric.neighbours(metric.sketches(np.concatenate(sets), np.r_[0, np.cumsum(sizes)]), sizes)
    for i, a in enumerate(sets):
        both = [len(np.intersect1d(a, b)) for b in sets]
        assert kept[i] or not any(100 * c >= 85 * (len(a) + len(b) - c) for j, (b, c) in enumerate(zip(sets, both, strict=True)) if j != i)
    assert kept.sum() < 75
