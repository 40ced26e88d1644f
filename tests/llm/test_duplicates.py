"""Near-duplicates, byte strings and phrases, each against brute force."""

from __future__ import annotations

import hashlib
import io
import random
from collections import Counter

import numpy as np
import pytest

from chronofold.llm import dart, metric, passages, phrases, suffix
from chronofold.llm import sets as sets_module
from chronofold.llm.graph import components
from tests.llm import cases


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(3000, i) for i in range(3001, 3100)]
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["node"]: r["class"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in {x for e in edges if e[0] != e[1] for x in e}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    a, b = rng.integers(1, 9, 400).astype(float), rng.integers(1, 9, 400).astype(float)
    owner = np.repeat([0, 1], 400)
    k = 4000
    sig = dart.signatures(np.concatenate((keys, keys)), np.concatenate((a, b)), owner, 3, k)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03
    assert (sig[2] == np.iinfo(np.uint64).max).all()
    small = dart.signatures(keys[:1], np.ones(1), np.zeros(1, int), 1, 96)
    assert len(set(small[0].tolist())) == 96  # one element fills every coordinate


def _shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def _classes(rows):
    parent = {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {r[0]: _shingles(r[1]) for r in rows}
    for i, (a, ta, *_) in enumerate(rows):
        for b, tb, *_ in rows[:i]:
            x, y = sets[a], sets[b]
            if (ta or "") == (tb or "") or x and y and len(x & y) >= 0.8 * len(x | y):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {r[0]: root(r[0]) for r in rows}


@pytest.mark.parametrize("per_task", [1000, 2])
def test_near_duplicates(spark, monkeypatch, per_task):
    monkeypatch.setattr(dart, "MEMBERS_PER_TASK", per_task)
    df = cases.frame(spark, repeated=True, null_id=True)
    out = dart.near_duplicates(df)
    assert out.count() == df.count()
    assert {r["doc_id"]: r["class_id"] for r in out.collect() if r["doc_id"] is not None} == _classes(cases.rows())
    assert all(r["class_id"] is None for r in out.filter("doc_id is null").collect())
    assert dart.near_duplicates(cases.empty(spark)).count() == 0


def test_a_chain_of_edits_is_one_class(spark):
    rng = random.Random(9)
    w = cases.sentence(rng, 200).split()
    rows = []
    for i in range(60):
        w = list(w)
        w[rng.randrange(len(w))] = f"new{i}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: r["class_id"] for r in dart.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _classes(rows)


def _bytes_kept(rows, window):
    blobs = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[j : j + window] for _, b in blobs for j in range(len(b) - window + 1))
    for i, b in blobs:
        stay = np.ones(len(b), bool)
        for j in range(len(b) - window + 1):
            if seen[b[j : j + window]] > 1:
                stay[j : j + window] = False
        gone = ~stay
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        yield i, (len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[stay].tobytes()).hexdigest())


def test_a_star_around_a_middle_id(spark, monkeypatch):
    """Copies of one text, each changed elsewhere, are similar to it but not to each other; so are those of a second family in the same buckets."""
    monkeypatch.setattr(metric, "BLOCK", 20)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(240):
        words, (a, b) = list(base), rng.sample(range(5, 95), 2)
        words[a], words[b] = f"a{i}", f"b{i}"
        if i != 120 and abs(a - b) < 5:
            words[(a + 40) % 90 + 5] = f"c{i}"
        rows.append((i, " ".join(base if i == 120 else words)))
    got = {r["doc_id"]: r["class_id"] for r in dart.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [_shingles(t) for _, t in rows]
    assert all(len(sets[0] & s) < 0.8 * len(sets[0] | s) for s in (sets[239], sets[238]))
    assert got == _classes(rows)
    assert len(set(got.values())) < 40


def test_texts_of_one_id_are_nodes_of_their_own(spark):
    rng = random.Random(9)
    a, b = ([f"{c}{rng.randrange(10**6)}" for _ in range(100)] for c in "ab")
    near = lambda w: [*w[:50], "changed", *w[51:]]
    rows = [(7, " ".join(a)), (7, " ".join(b)), (9, " ".join(near(a))), (10, " ".join(near(b))), (None, " ".join(b)), (None, "alone"), (3, " ".join(a))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"]) for r in dart.near_duplicates(df).collect()), key=str)
    assert got == sorted([(7, 3), (7, 7), (9, 3), (10, 7), (None, None), (None, None), (3, 3)], key=str)
    kept = {(r["doc_id"], r["text"]) for r in dart.one_of_each(df).collect()}
    assert kept == {(3, " ".join(a)), (7, " ".join(b)), (None, "alone")}
    assert dart.one_of_each(df.union(df)).count() == 3 and dart.one_of_each(df).columns == df.columns


def test_pages_of_a_template_do_not_meet(spark, monkeypatch):
    """Pages that share most of their words but stay under the limit cost one row each, not a row per pair."""
    monkeypatch.setattr(metric, "SAMPLED", 4)
    rng = random.Random(10)
    template = [f"t{i}" for i in range(170)]
    pages = spark.createDataFrame([(i, " ".join(template + [f"u{rng.randrange(10**9)}" for _ in range(26)])) for i in range(600)], "nid long, text string")
    kind = metric.Shingling(5, False, 80)
    measured = metric._measured(pages, metric.frequent(pages, kind), kind).cache()
    assert metric.regions(measured, 80).count() == 0
    assert dart.near_duplicates(pages.withColumnRenamed("nid", "doc_id")).select("class_id").distinct().count() == 600


def test_linked_sets(monkeypatch):
    monkeypatch.setattr(sets_module, "_COLUMNS", 7)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(40) < 0.07, rng.integers(0, 1 << 63, 40, dtype=np.uint64), base)) for _ in range(30)] + [base[:3], np.zeros(0, np.uint64)]
    want = list(range(len(sets)))
    for _ in want:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                both = len(np.intersect1d(a, b))
                if both and both >= 0.8 * (len(a) + len(b) - both):
                    want[i] = min(want[i], want[j])
    assert 1 < len(set(want)) < len(sets)
    assert sets_module.linked(sets[:-1], 0.8).tolist() == want[:-1]


@pytest.mark.parametrize("hot", [2000, 1])
def test_repeated_byte_strings(spark, monkeypatch, hot):
    monkeypatch.setattr(passages, "HOT_ANCHOR", hot)
    df = cases.frame(spark)
    got = cases.by_id(suffix.without_repeats(df))
    for doc_id, want in _bytes_kept(cases.rows(), 400):
        r = got[doc_id]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want
    assert len(got) == df.count() and suffix.without_repeats(cases.empty(spark)).count() == 0


def test_edges_of_a_passage_in_many_texts(spark, monkeypatch):
    monkeypatch.setattr(passages, "HOT_ANCHOR", 5)
    largest, resolve = spark.sparkContext.accumulator(0), suffix.repeated_in_segments

    def counted(keys, pieces, ids):
        largest.add(int(np.unique(keys, return_counts=True)[1].max() > 5))
        return resolve(keys, pieces, ids)

    monkeypatch.setattr(suffix, "repeated_in_segments", counted)
    rng = random.Random(6)
    own = lambda: "".join(rng.choice("abcdefgh ") for _ in range(300))
    passage = own() + own()
    rows = [(i, own() + "xy"[i % 2] * (i % 3) + passage + "pq"[i % 2] + own()) for i in range(30)]
    got = {r["doc_id"]: r for r in suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, want in _bytes_kept(rows, 400):
        r = got[doc_id]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want
    assert largest.value == 0  # no key of more than five different segments reached one task


def test_only_segments_of_hot_anchors_are_looked_up(spark, monkeypatch):
    """Once one key is crowded, the segments of all other anchors still travel once for their sum, not again for the list of crowded keys."""
    monkeypatch.setattr(passages, "HOT_ANCHOR", 5)
    plans, tables, write = {}, {}, passages.Scratch.written

    def written(self, df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        out = write(self, df, name)
        tables[name] = [r["loose"] for r in out.select("loose").collect()] if name == "segments" else out.count()
        return out

    monkeypatch.setattr(passages.Scratch, "written", written)
    rng = random.Random(16)
    own = lambda n=300: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = own(600)
    rows = [(i, own() + passage + own()) for i in range(30)]
    for i in range(30, 90, 2):  # passages of two texts each
        both = own(700)
        rows += [(i, own() + both + own()), (i + 1, own() + both + own())]
    got = {r["doc_id"]: r for r in suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, want in _bytes_kept(rows, 400):
        r = got[doc_id]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want
    assert tables["crowded"] > 0 and "LeftAnti" not in plans["answers"] and "LeftSemi" not in plans["answers"]
    assert 0 < tables["looked_up"] <= sum(tables["segments"]) < len(tables["segments"])


def test_anchors_that_recur_in_a_text_are_looked_up(spark, monkeypatch):
    """Few texts may hold more segments of one key than the limit."""
    monkeypatch.setattr(passages, "HOT_ANCHOR", 5)
    rng = random.Random(17)
    own = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    core = own(380)
    rows = [(i, "".join(own(60) + core + own(60) for _ in range(8))) for i in range(3)] + [(3, core + own(100)), (4, own(90) + core)]
    rows += [(5, own(50) + rows[0][1][30:900]), (6, rows[1][1][500:1400] + own(20))]
    got = {r["doc_id"]: r for r in suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, want in _bytes_kept(rows, 400):
        r = got[doc_id]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want


def test_repeated_rows_lose_everything(spark):
    rows = cases.rows()
    df = cases.frame(spark, repeated=True, null_id=True)
    out = suffix.without_repeats(df).collect()
    assert len(out) == df.count()
    twice = {r[0] for r in rows[:5]}
    for r in out:
        if r["doc_id"] in twice and r["n_bytes"] >= 400:
            assert r["n_removed"] == r["n_bytes"] and r["n_spans"] == 1


def test_columns_against_sorted_suffixes():
    rng = random.Random(8)
    for length in (1, 3, 6):
        documents = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(6, 20))) for _ in range(40)]
        align = np.array([rng.randrange(4) for _ in documents])
        group = np.sort(np.array([rng.randrange(3) for _ in documents]))
        transforms = io.BytesIO()
        hits = suffix.repeated_starts(group, documents, align, length, transforms)
        seen = Counter((group[i], align[i] + j, d[j : j + length]) for i, d in enumerate(documents) for j in range(len(d) - length + 1))
        want = np.zeros_like(hits)
        for i, d in enumerate(documents):
            for j in range(len(d) - length + 1):
                want[i, align[i] + j] = seen[group[i], align[i] + j, d[j : j + length]] > 1
        assert (hits == want).all()
        # Each column's transform holds the symbols before the suffixes of the next column in their order.
        width = hits.shape[1]
        columns = np.frombuffer(transforms.getvalue(), np.uint16).reshape(width, len(documents))
        for n, column in enumerate(range(width - 1, -1, -1)):
            tails = [(group[i], *[documents[i][c - align[i]] if 0 <= c - align[i] < len(documents[i]) else 256 for c in range(column + 1, width)]) for i in range(len(documents))]
            order = sorted(range(len(documents)), key=lambda i: tails[i])
            want_symbols = [documents[i][column - align[i]] if 0 <= column - align[i] < len(documents[i]) else 256 for i in order]
            assert columns[n].tolist() == want_symbols or sorted(columns[n].tolist()) == sorted(want_symbols) and len(set(tails)) < len(tails)


def _words_kept(rows, window=13):
    split = {i: (t or "").encode().split() for i, t, *_ in rows}
    first = {}
    for i in sorted(split):
        for j in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][j : j + window]), i)
    for i, w in split.items():
        stay = [True] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < i:
                stay[j : j + window] = [False] * window
        yield i, w, stay


@pytest.mark.parametrize("hot", [2000, 1])
def test_phrases(spark, monkeypatch, hot):
    monkeypatch.setattr(passages, "HOT_ANCHOR", hot)
    df = cases.frame(spark, repeated=True)
    out = phrases.without_passages(df)
    assert out.count() == df.count() and phrases.without_passages(cases.empty(spark)).count() == 0
    got = cases.by_id(out)
    trimmed = {r["doc_id"]: r for r in phrases.trimmed(df).collect()}
    texts = {r[0]: r[1] for r in cases.rows()}
    for doc_id, w, stay in _words_kept(cases.rows()):
        kept = [x for x, s in zip(w, stay) if s]
        r = got[doc_id]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
        if w and not kept:
            assert doc_id not in trimmed
        else:
            t = trimmed[doc_id]
            assert (t["text"] or "").encode().split() == kept and t["n_chars"] == len(t["text"] or "")
            if all(stay):
                assert t["text"] == texts[doc_id]
    assert phrases.trimmed(df).columns == df.columns


@pytest.mark.parametrize("hot", [2000, 1])
def test_white_space_does_not_keep_a_passage(spark, monkeypatch, hot):
    monkeypatch.setattr(passages, "HOT_ANCHOR", hot)
    passage = [f"p{i}" for i in range(20)]
    rows = [(i, f"own{i} " + gap.join(passage) + f" end{i}") for i, gap in enumerate(["  ", "\n", "\t", " ", " \n"])]
    got = {r["doc_id"]: r["n_removed"] for r in phrases.without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 20, 2: 20, 3: 20, 4: 20}


@pytest.mark.parametrize("doc_id", [None, 7])
def test_texts_of_one_id_keep_their_own_runs(spark, doc_id):
    rng = random.Random(4)
    passage, other = (" ".join(f"{c}{rng.random()}" for _ in range(120)) for c in "px")
    rows = [(1, "one " + passage), (doc_id, "two " + passage), (doc_id, other)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cut = {r["n_words"]: r["n_removed"] for r in phrases.without_passages(df).filter("doc_id is null or doc_id = 7").collect()}
    assert cut == {121: 120, 120: 0}
    gone = {r["n_bytes"]: r["n_removed"] for r in suffix.without_repeats(df).filter("doc_id is null or doc_id = 7").collect()}
    assert gone[len(other)] == 0 and gone[len(passage) + 4] >= len(passage)
    assert [r["text"] for r in phrases.trimmed(df.withColumnRenamed("doc_id", "id"), "id").filter("id is null or id = 7").collect() if r["text"][0] == "x"] == [other]


def test_null_ids_come_last(spark):
    out = phrases.without_passages(cases.frame(spark, null_id=True)).filter("doc_id is null").collect()
    # One of them repeats an earlier text, the other repeats only itself.
    assert sorted((r["n_removed"] > 0) for r in out) == [False, True]
