"""Main text and URL verdicts."""

from __future__ import annotations

import html as entities
import itertools
import random
import re

from chronofold.llm import html, urls
from chronofold.llm.scratch import Scratch

PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><script>var a='</p>';</script></head><body><header>Site</header><div class='cookie-notice'>We use cookies</div>"
    "<nav><ul><li><a href=/a>a</a></ul></nav><article><h1>Head</h1><p>Some <a href=x>linked</a> &amp; text&nbsp;here,  quite\nlong so that it counts.<p>Second<br>third"
    "<form><p>mail</p></form><aside class=sidebar><p>side</p></aside><script>x()</script><section id='comments'><p>A reader comment that goes on for a long, long time.</p></section></article>"
    "<div class=ad>buy</div><footer>foot</footer></body></html>"
)


def test_hand_made_page(spark):
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    model = html.train(pages)
    assert model.text(PAGE) == "Head\nSome linked & text here, quite long so that it counts.\nSecond\nthird"
    assert model.text("") == ""
    assert isinstance(model.text("<<<>>><p"), str)
    out = html.extracted(pages, model).toPandas().merge(pages.toPandas(), on="page_id")

    def article(page):
        inside = re.sub("<!--.*?-->", "", page, flags=re.S).split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        lines = (" ".join(entities.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br|div)\b[^>]*>", inside))
        return "\n".join(x for x in lines if x)

    assert (out["text"] == out["html"].map(article)).mean() > 0.99
    assert (out["n_chars"] == out["text"].str.len()).all()


def test_odd_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars long"
    rows = [(1, "u", None, "x", 1), (None, None, PAGE, "x", 1), (2, "u", "", None, None), (2, "u", "", None, None), (3, "u", "plain", None, None), (4, "u", "<p>" * 400 + "deep", None, None), (5, "u", "<script>", None, None)]
    df = spark.createDataFrame(rows, schema)
    got = html.extracted(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(rows)
    assert all(r["text"] == "" for r in got.filter("page_id <= 2").collect())
    assert html.extracted(spark.createDataFrame([], schema)).count() == 0


def test_nested_raw_elements():
    model = html.Model.learned({})
    page = "<article><p>One</p><svg><g><svg a='>'><text>x</text></svg><text>leak</text></g></svg><p>Two</p><template><template>y</template>leak</template><svg/><p>Three</p></svg></article>"
    assert model.text(page) == "One\nTwo\nThree"
    assert model.text("<article><p>One</p><svg><svg></svg> open to the end") == "One"


def test_training_takes_pages_with_an_article(spark, monkeypatch):
    monkeypatch.setattr(html, "SAMPLE_PAGES", 30)
    rows = [(i, f"u{i}", "<div><p>nothing to learn</p></div>") for i in range(2000)] + [(i, f"v{i}", f"<body><article class=a{i % 3}b><p>text</p></article><footer>f</footer></body>") for i in range(25)]
    model = html.train(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert any(w.startswith("name:") and w not in html.Model.learned({}).weights for w in model.weights)
    assert html.train(spark.createDataFrame(rows[:50], "page_id long, url string, html string")).weights == html.Model.learned({}).weights


def test_messages_give_exact_marginals():
    tree = html.parse("<div><p>a</p><p>b <a>c</a></p></div><ul><li>d</ul>")
    model = html.Model({"#other": ((0.8, 0.2), (0.3, 0.7)), "p": ((0.6, 0.4), (0.1, 0.9))}, {"links:few": 0.7, "links:most": -0.4})
    n = len(tree.tags)
    got = model.marginals(tree)
    import itertools
    import math

    shown = html.features(tree)
    share = min(1.0, html.TEXTS_WEIGHED / max(1, sum(any(f.startswith("size:") for f in fs) for fs in shown)))
    weight = [math.exp(share * sum(model.weights.get(f, 0) for f in fs)) for fs in shown]
    total, yes = 0.0, [0.0] * n
    for states in itertools.product((0, 1), repeat=n - 1):
        s = (0, *states)
        p = math.prod(model.links.get(tree.tags[i], model.links["#other"])[s[tree.parents[i]]][s[i]] * (weight[i] if s[i] else 1) for i in range(1, n))
        total += p
        for i in range(n):
            yes[i] += p * s[i]
    assert all(abs(a - b / total) < 1e-9 for a, b in zip(got, yes))


def _page(i, url):
    return (i, url, "h", "v")


def test_url_rules_and_mined_rules(spark):
    given = {
        "http://a.COM/x": ("a.com", "/x", "com/", "allow"), "https://www.Example.com/en/1?q=/es/": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"), "https://example.com/en": ("example.com", "/en", "com/", "allow"),
        "http://x.net/es/1#f": ("x.net", "/es/1", "net/es/", "block"), "http://notnet/es/": ("notnet", "/es/", None, "allow"), "nonsense": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "http://": ("", "", None, "allow"), "http://net/fr/": ("net", "/fr/", "net/fr/", "block"), "x://y.org?a=://b/c": ("y.org", "", None, "allow"), "http://É.com": ("É.com", "", None, "allow"),
    }
    pages = [_page(i, u) for i, u in enumerate(given)] + [_page(0, "http://a.COM/x")]
    pages += [_page(100 + i, f"http://{'spam' if i % 2 else 'good'}{'' if i % 2 else i}.org/p/{i}") for i in range(80)]
    labels = [(100 + i, 0 if i % 2 else 1, 0) for i in range(60)] + [(100, 1, None), (None, 0, 1)]
    df, marks = spark.createDataFrame(pages, "page_id long, url string, host string, verdict string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = urls.judged(df, marks)
    assert out.count() == len(pages)
    rows = {r["page_id"]: r for r in out.collect()}
    for i, want in enumerate(given.values()):
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"], rows[i]["verdict"]) == want
    assert all(rows[100 + i]["verdict"] == ("block" if i % 2 else "allow") for i in range(80))
    assert {r["verdict"] for r in urls.judged(df.filter("page_id >= 100"), marks.limit(0)).collect()} == {"allow"}
    assert urls.judged(df.limit(0), marks).count() == 0


def test_rules_match_by_all_their_tokens(spark):
    rules = spark.createDataFrame([(["a", "b"], 0.9), (["c"], 0.9), (["a", "d"], 1.0)], "items array<string>, confidence double")
    pages = spark.createDataFrame([("1", ["a", "b", "x"]), ("2", ["a", "x"]), ("3", ["c"]), ("4", []), ("5", ["d", "a"]), ("1", ["a", "b", "x"])], "url string, tokens array<string>")
    same = spark.createDataFrame([(c, c) for c in "abcdx"] + [("e", "c")], "token string, class string")
    pages = pages.union(spark.createDataFrame([("6", ["e"]), (None, ["c"])], pages.schema))
    assert sorted(r["url"] for r in urls.blocked_urls(pages, rules, same).collect()) == ["1", "3", "5", "6"]


def test_mined_rules_equal_those_of_all_combinations(spark):
    """Two hundred small tables side by side, with tokens of their own each, so that no combination crosses them."""
    rng = random.Random(11)
    rows, expected = [], {}
    for table in range(200):
        names = [f"{table}:{c}" for c in "abcdef"]
        kind = {c: rng.random() for c in names}
        own = []
        for _ in range(rng.randrange(20, 90)):
            tokens = [c for c in names if rng.random() < 0.45]
            if rng.random() < 0.7 and names[0] in tokens:
                tokens = sorted({*tokens, names[1]})
            score = max((kind[c] for c in tokens), default=0.0)
            own.append((tokens, "block" if rng.random() < (0.95 if score > 0.8 and len(tokens) > 1 else 0.4) else "allow"))
        rows += own
        told = {}
        for size in range(1, len(names) + 1):
            for items in itertools.combinations(names, size):
                held = [v for t, v in own if {*items} <= {*t}]
                if len(held) >= urls.LEAST_ROWS and held.count("block") >= urls.LEAST_CONFIDENCE * len(held) and not any({*p} < {*items} for p in told):
                    told[items] = held.count("block") / len(held)
        expected |= told
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string").repartition(5)
    rules, classes = urls.mined_rules(labelled, Scratch(spark))
    members = {}
    for r in classes.collect():
        members.setdefault(r["class"], []).append(r["token"])
    got = {tuple(sorted(x)): r["confidence"] for r in rules.collect() for x in itertools.product(*(members[c] for c in r["items"]))}
    assert got.keys() == expected.keys() and len(got) > 100 and any(len(k) > 1 for k in got)
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_long_shared_paths_are_mined_at_once(spark):
    path = "/".join(f"part{chr(97 + i)}x{i}y" for i in range(30))
    pages = [(i, f"http://h{i % 2}.org/{path}/{'bad' if i % 3 else 'fine'}", "h", "v") for i in range(90)]
    labels = [(i, int(not i % 3), 0) for i in range(90)]
    df, marks = spark.createDataFrame(pages, "page_id long, url string, host string, verdict string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert {(r["page_id"] % 3 > 0, r["verdict"]) for r in urls.judged(df, marks).collect()} == {(True, "block"), (False, "allow")}
