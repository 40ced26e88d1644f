"""Ranked search and whitening against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from chronofold.llm import lexical, whiten

from .cases import SCHEMA, empty, frame, texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain(docs, items, top=10):
    """Scores of all documents, item by item."""
    bags = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total = sum(1 for s in sizes if s), sum(sizes)
    holders = Counter(w for _, b in bags for w in b)
    asked = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(TERM.findall((text or "").translate(UPPER)))
    out = []
    for item, terms in asked.items():
        scores = []
        for (doc, bag), size in zip(bags, sizes, strict=True):
            m = 25 + 75 * size * n // max(total, 1)
            score = sum(
                r * math.floor(1000 * math.log((2 * n + 2) / (2 * holders[w] + 1))) * (10**9 * bag[w] // (1000 * bag[w] + 8 * m)) for w, r in terms.items() if w in bag
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, k + 1, None if none else doc, -s) for k, (s, none, doc) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def asked(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long, term string, rank int, score long, times long")


def test_ranking_equals_all_scores(spark):
    docs = frame(spark, repeated=True, null_id=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    some = [t for t in texts() if t]
    items = [(1, some[0]), (2, "changed tail HEAD one One"), (3, None), (4, "nothing0here"), (5, ""), (None, some[3]), (6, some[5] + " " + some[5]), (6, "word two"), (7, "one"), (7, "one"), (8, "日本語のテキスト")]
    df = asked(spark, [(i, t, 0, "x", 1, 2, 3) for i, t in items])
    expected = plain(rows, items)
    for block_terms in (lexical.BLOCK_TERMS, 20):
        got = lexical.ranked(docs, df, block_terms=block_terms)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == expected


def test_ranking_of_empty_tables(spark):
    one = asked(spark, [(1, "word", 0, "x", 1, 2, 3)])
    assert lexical.ranked(empty(spark), one).count() == 0
    assert lexical.ranked(frame(spark), one.limit(0)).count() == 0


def test_scores_are_settled_without_reading_all():
    rng = np.random.default_rng(5)
    for trial in range(200):
        size = int(rng.integers(1, 3000))
        lists, full = [], np.zeros(size, np.int64)
        for _ in range(int(rng.integers(1, 8))):
            docs = rng.permutation(size)[: int(rng.integers(1, size + 1))]
            gain = rng.integers(1, 5 if trial % 2 else 10**6, len(docs)) * (1 if trial % 3 else 10)
            order = np.lexsort((docs, -gain))
            lists.append((docs[order], gain[order]))
            full[docs] += gain
        best, score, _ = lexical.settled(lists, size)
        expected = np.lexsort((np.arange(size), -full))[:10]
        expected = expected[full[expected] > 0]
        assert best.tolist() == expected.tolist() and score.tolist() == full[expected].tolist()
    peak = np.array([10**6] * 10 + [1] * 100_000)
    lists = [(np.arange(len(peak)), peak)] * 3
    _, score, entries = lexical.settled(lists, len(peak))
    assert score.tolist() == [3 * 10**6] * 10 and entries <= 3 * 2 * lexical.FIRST_READ


def test_terms_are_compared_by_their_bytes():
    import pyarrow as pa

    known = lexical.Vocabulary(["one", "two", "é"])
    known.hashes[:] = known.hashes[0]  # every hash the same
    data, starts, ends, _, hashes = lexical._terms(pa.array(["ONE two three é"]))
    hit, number = known.found(data, starts, ends, np.full(len(hashes), known.hashes[0]))
    assert all(["one", "two", "three", "é"][h] == ["one", "two", "é"][n] for h, n in zip(hit, number, strict=True))


def plain_whitening(vectors):
    x = np.floor(np.array(vectors, float) * 256)
    fit = np.unique(x, axis=0)
    cov = np.cov(fit.T, bias=True).reshape(x.shape[1], x.shape[1])
    values, basis = np.linalg.eigh(cov)
    return x, fit, values[::-1], basis[:, ::-1]


@pytest.mark.parametrize(("rows", "d"), [(300, 16), (40, 64), (500, 3), (30, 1)])
def test_whitening_equals_eigenvectors(spark, rows, d):
    rng = np.random.default_rng(rows)
    vectors = (rng.standard_normal((rows, d)) * np.linspace(1, 3, d) + 0.5).tolist()
    vectors += vectors[:7]
    schema = "vec_id long, embedding array<double>, label int, x string, n long, component int"
    df = spark.createDataFrame([(i, v, 1, "x", 1, 1) for i, v in enumerate(vectors)], schema).repartition(20)
    got = whiten.whitened(df).toPandas()
    x, fit, values, basis = plain_whitening(vectors)
    k = min(4, d)
    assert len(got) == k * len(vectors) and (got["n"] == len(fit)).all() and (got["identity_error"] < 1e-9).all()
    for c in range(k):
        own = got[got["component"] == c + 1].sort_values("vec_id")
        expected = (x - fit.mean(0)) @ basis[:, c] / np.sqrt(values[c])
        assert min(np.abs(own["whitened"] - expected).max(), np.abs(own["whitened"] + expected).max()) < 1e-8
        assert np.allclose(own["explained"], values[c] / values.sum(), rtol=1e-9)
        assert own["deviation"].tolist() == [int(v) for v in ((len(fit) * x - fit.sum(0)) ** 2).sum(1)]


def test_whitening_of_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 1), (2, None, 1), (3, [1.0, None], 1), (4, [nan, 1.0], None), (5, [inf, 1.0], 1), (6, [], 1), (7, [1.0, 2.0, 3.0], 1), (None, [2.0, 4.0], 1), (1, [1.0, 2.0], 1), (8, [3.0, 6.0], 2)]
    got = whiten.whitened(spark.createDataFrame(rows, schema).repartition(3)).toPandas()
    assert sorted(got["vec_id"].astype("Int64").astype(str)) == ["1"] * 4 + ["8"] * 2 + ["<NA>"] * 2
    assert (got["n"] == 3).all() and got["whitened"].isna().tolist() == (got["component"] == 2).tolist()
    assert np.allclose(got[got["component"] == 1]["explained"], 1) and (got[got["component"] == 2]["explained"] == 0).all()
    same = whiten.whitened(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], schema)).collect()
    assert len(same) == 4 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 and r["n"] == 1 for r in same)
    huge = whiten.whitened(spark.createDataFrame([(1, [3e38, 1.0], 1), (2, [-3e38, 2.0], 1), (3, [0.0, 2.5], 1)], schema)).collect()
    assert len(huge) == 6 and all(r["deviation"] is None for r in huge if r["vec_id"] != 3)
    assert whiten.whitened(spark.createDataFrame([], schema)).count() == 0
    assert whiten.whitened(spark.createDataFrame([(1, None, 1)], schema)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_singular_values_of_hard_matrices():
    rng = np.random.default_rng(2)
    cases = [rng.standard_normal((48, 48)) * np.logspace(0, -9, 48), np.eye(12), np.zeros((5, 5)), np.diag([3.0, 3.0, 1.0, 0.0]), np.ones((6, 6))]
    cases.append(np.kron(np.eye(8), np.array([[2.0, 1.0], [1.0, 2.0]])))
    for a in cases:
        values, basis, total = whiten.leading(np.linalg.qr(a, mode="r"), 4)
        true = np.linalg.svd(a, compute_uv=False) ** 2
        assert np.allclose(values, true[: len(values)], rtol=1e-12, atol=1e-25) and np.isclose(total, true.sum())
        assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-10)
        assert np.allclose(np.linalg.norm(a @ basis, axis=0) ** 2, values, rtol=1e-9, atol=1e-25)
