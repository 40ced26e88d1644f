"""Main text of web pages: a tree-structured graphical model over the document's elements.

Every element is content or not.  Potentials between parent and child depend on the child's tag, potentials of an element on
its class names and on its own text.  Messages go up from the leaves and down from the root (sum-product), which gives each
element's exact marginal; text whose element is content is kept.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import arrow, mapped, slices

#: About so many pages are learned from, chosen by a hash of address and page.
SAMPLE_PAGES = 2000
#: Most features that the model keeps, the most frequent ones.
MOST_FEATURES = 20_000
#: No link between states is rarer than this, however many labelled pages lack it, but for tags that never hold content.
LEAST_SHARE = 0.01
#: The evidence of all texts of a page counts as that of so many.
TEXTS_WEIGHED = 4.0
_PARTS = 8

# Names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
NESTED = frozenset("svg template".split())
INLINE = frozenset("a abbr b bdi bdo cite code data dfn em font i kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDARY = frozenset("ul ol dl table article section div body td th form nav aside".split())
# What tags and class names usually hold, as a prior for those that no labelled page has.
LIKELY_TAGS = frozenset("article main".split())
UNLIKELY_TAGS = frozenset("nav header footer aside form script style textarea title noscript template iframe svg button select input head dialog menu".split())
LIKELY_NAMES = frozenset("article articlebody content entry main post postbody story text".split())
UNLIKELY_NAMES = frozenset(
    "ad ads adv advert advertisement alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer form "
    "header login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo related replies reply respond "
    "search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget".split()
)

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?|[^<]+|<", re.S)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Tree:
    """Elements in page order: tag, parent and class words; texts in page order: (element, text, whether a block starts before)."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    names: list[tuple[str, ...]] = field(default_factory=list)
    texts: list[tuple[int, str, bool]] = field(default_factory=list)


def _after_raw(page: str, at: int, tag: str) -> int:
    """Where a raw element ends: at its end tag, for a drawing or a template the one of the outermost; at the end of the page without one."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>" if tag in NESTED else rf"<(/){re.escape(tag)}\s*>", re.I).finditer(page, at):
        if m[1]:
            depth -= 1
        elif not m[0].endswith("/>"):
            depth += 1
        if not depth:
            return m.end()
    return len(page)


def parse(page: str) -> Tree:
    """The element tree of a page, forgiving missing end tags."""
    tree, stack, fresh, raw = Tree(["#root"], [-1], [()]), [0], True, None
    tags = tree.tags
    at, end = 0, len(page)
    while at < end:
        if raw:
            at, raw = _after_raw(page, at, raw), None
            stack.pop()
            continue
        m = _PIECE.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            text = m[0]
            if text[0] != "<" or text == "<":
                tree.texts.append((stack[-1], entities.unescape(text), fresh))
                fresh = False
            elif text.startswith("<![CDATA["):
                tree.texts.append((stack[-1], text[9:].removesuffix("]]>"), fresh))
                fresh = False
            continue
        tag = tag.lower()
        fresh = fresh or not (tag in INLINE or tag in RAW)
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if tags[stack[depth]] == tag:
                    del stack[depth:]
                    break
                if tag in INLINE and tags[stack[depth]] not in INLINE:
                    break
            continue
        for closed in ({"p"} if tag in CLOSES_P else set()) | SIBLINGS.get(tag, set()):
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = tags[stack[depth]]
                if open_tag == closed:
                    del stack[depth:]
                    break
                if open_tag in BOUNDARY and not (closed in ("td", "th", "tr") and open_tag in ("td", "th")):
                    break
        if tag in VOID:
            continue
        words = [w for a in _NAMED.findall(m[3]) for w in _WORD.findall((a[0] or a[1] or a[2]).lower())] if m[3] else ()
        stack.append(len(tags))
        tags.append(tag)
        tree.parents.append(stack[-2])
        tree.names.append(tuple(words))
        if m[3].endswith("/"):
            stack.pop()
        elif tag in RAW:
            raw = tag
    return tree


def features(tree: Tree) -> list[list[str]]:
    """What each element shows of itself: class words, and how much own text it has outside and inside of links."""
    out = [[f"name:{w}" for w in set(names)] for names in tree.names]
    own, linked = [0] * len(tree.tags), [0] * len(tree.tags)
    for element, text, _ in tree.texts:
        size = len(text.strip())
        block = element
        while tree.tags[block] in INLINE:
            linked[block] += size
            if tree.tags[block] == "a":
                linked[tree.parents[block]] += size
            block = tree.parents[block]
        own[block] += size
    for i, size in enumerate(own):
        if size:
            out[i].append(f"size:{min(8, size.bit_length() // 2)}")
            out[i].append("links:most" if 2 * linked[i] > size and linked[i] else "links:few")
    return out


def labels(tree: Tree) -> list[int] | None:
    """What labelled pages tell: inside their article is content, landmarks in it are not.  None for a page without an article."""
    if not LIKELY_TAGS & set(tree.tags):
        return None
    state = [0] * len(tree.tags)
    for i in range(1, len(tree.tags)):
        up = state[tree.parents[i]]
        named = bool(UNLIKELY_NAMES & set(tree.names[i]))
        state[i] = 0 if tree.tags[i] in UNLIKELY_TAGS or named else 1 if tree.tags[i] in LIKELY_TAGS else up
    return state


@dataclass(frozen=True)
class Model:
    """``links[tag][parent][child]`` potentials and ``weights[feature]``, the log-ratio of content to other."""

    links: dict[str, tuple[tuple[float, float], tuple[float, float]]]
    weights: dict[str, float]

    @staticmethod
    def learned(counts: dict[tuple[str, int, int], int]) -> Model:
        """From how often (what, parent state, state) was seen, on top of the priors."""
        tags: dict[str, list[list[float]]] = {}
        seen: dict[str, list[float]] = {}
        totals: dict[str, list[float]] = {}
        for tag in LIKELY_TAGS | UNLIKELY_TAGS | {"#other"}:
            tags[tag] = _prior(tag)
        for (what, up, state), n in sorted(counts.items()):
            if what.startswith("tag:"):
                tags.setdefault(what[4:], _prior(what[4:]))[up][state] += n
            else:
                kind = what.split(":")[0]
                seen.setdefault(what, [0.0, 0.0])[state] += n
                totals.setdefault(kind, [0.0, 0.0])[state] += n
        # Beyond so many sightings a link gets no surer, else pages unlike the labelled ones could not be read.
        links = {t: tuple(_shares(row, 1e-4 if t in UNLIKELY_TAGS else LEAST_SHARE) for row in rows) for t, rows in tags.items()}
        weights = {f"name:{n}": 4.0 for n in LIKELY_NAMES} | {f"name:{n}": -12.0 for n in UNLIKELY_NAMES}
        for what, (no, yes) in seen.items():
            none, all_ = totals[what.split(":")[0]]
            limit = 4.0 if what.startswith("name:") else 1.5
            ratio = math.log((yes + 1) / (all_ + 2)) - math.log((no + 1) / (none + 2))
            if what not in weights:
                weights[what] = max(-limit, min(limit, ratio))
        return Model(links, weights)

    def marginals(self, tree: Tree) -> list[float]:
        """For every element the probability of content: messages to the root, then back to the leaves."""
        n = len(tree.tags)
        other = self.links["#other"]
        shown = features(tree)
        # Texts of one page are alike; together they weigh as much as a few, so that names and tags are not outvoted.
        share = min(1.0, TEXTS_WEIGHED / max(1, sum(any(f.startswith("size:") for f in fs) for fs in shown)))
        scores = (sum(self.weights.get(f, 0.0) * (1.0 if f.startswith("name:") else share) for f in fs) for fs in shown)
        likely = [math.exp(max(-14.0, min(14.0, s))) for s in scores]
        no, yes = [1.0] * n, likely[:]  # evidence below and at each element
        yes[0] = 0.0  # the root is no content
        up = [(1.0, 1.0)] * n
        links = [self.links.get(t, other) for t in tree.tags]
        for i in range(n - 1, 0, -1):
            (a, b), (c, d) = links[i]
            m0, m1 = a * no[i] + b * yes[i], c * no[i] + d * yes[i]
            total = m0 + m1
            up[i] = (m0 / total, m1 / total)
            p = tree.parents[i]
            no[p], yes[p] = no[p] * up[i][0], yes[p] * up[i][1]
            if no[p] + yes[p] < 1e-200:
                no[p], yes[p] = no[p] * 1e200, yes[p] * 1e200
        down = [(1.0, 0.0)] * n
        out = [0.0] * n
        for i in range(1, n):
            p = tree.parents[i]
            # What the parent believes without this child's own message.
            q0, q1 = down[p][0] * no[p] / up[i][0], down[p][1] * yes[p] / up[i][1]
            (a, b), (c, d) = links[i]
            d0, d1 = q0 * a + q1 * c, q0 * b + q1 * d
            total = d0 + d1 or 1.0
            down[i] = (d0 / total, d1 / total)
            b0, b1 = down[i][0] * no[i], down[i][1] * yes[i]
            out[i] = b1 / (b0 + b1) if b0 + b1 else 0.0
        return out

    def text(self, page: str) -> str:
        """Blocks of content in page order, one a line."""
        tree = parse(page)
        keep = [m >= 0.5 for m in self.marginals(tree)]
        blocks: list[list[str]] = []
        open_block = True
        for element, text, fresh in tree.texts:
            open_block = open_block or fresh
            if keep[element]:
                if open_block:
                    blocks.append([])
                    open_block = False
                blocks[-1].append(text)
        lines = (" ".join("".join(b).split()) for b in blocks)
        return "\n".join(x for x in lines if x)


def _prior(tag: str) -> list[list[float]]:
    """Counts that a tag starts with, by parent and own state."""
    if tag in LIKELY_TAGS:
        return [[1.0, 99.0], [1.0, 99.0]]
    if tag in UNLIKELY_TAGS:
        return [[99.0, 0.1], [99.0, 0.1]]
    return [[49.0, 1.0], [1.0, 49.0]]


def _shares(row: list[float], least: float) -> tuple[float, ...]:
    return tuple(min(1 - least, max(least, x / sum(row))) for x in row)


def train(pages: DataFrame, url: str = "url", page: str = "html", most_features: int = MOST_FEATURES) -> Model:
    """Counts over a sample of about :data:`SAMPLE_PAGES` of the pages that have an article; summed by Spark, only sums reach the driver.

    At most ``most_features`` counts are kept, the largest ones: what a tag or class name tells beyond them stays with the prior."""
    rows = pages.select(pages[page].cast("string").alias("text"), F.xxhash64(pages[url], pages[page]).alias("pick"))
    rows = rows.filter(F.col("text").rlike(f"(?i)<({'|'.join(sorted(LIKELY_TAGS))})[\\s/>]"))
    total = rows.count()
    share = int(min(1.0, SAMPLE_PAGES / max(1, total)) * (1 << 20))
    sample = rows.filter(F.pmod("pick", F.lit(1 << 20)) < share).repartition(_PARTS, "pick").select("text")
    kinds = {"what": pa.string(), "up": pa.int32(), "state": pa.int32(), "n": pa.int64()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[tuple[str, int, int]] = Counter()
        for batch in batches:
            for page_text in batch.column("text").to_pylist():
                tree = parse(page_text)
                state = labels(tree)
                if state is not None:
                    for i, shown in enumerate(features(tree)):
                        if i:
                            sums.update((what, state[tree.parents[i]], state[i]) for what in (f"tag:{tree.tags[i]}", *shown))
        if sums:
            keys = list(sums)
            yield arrow({"what": [k[0] for k in keys], "up": [k[1] for k in keys], "state": [k[2] for k in keys], "n": list(sums.values())}, kinds)

    summed = mapped(sample, count, "what string, up int, state int, n long").groupBy("what", "up", "state").agg(F.sum("n").alias("n"))
    top = summed.orderBy(F.desc("n"), "what", "up", "state").limit(most_features).collect()
    return Model.learned({(r["what"], r["up"], r["state"]): r["n"] for r in top})


def extracted(pages: DataFrame, model: Model | None = None, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row.

    A null or empty page has an empty text.  Without a labelled page the priors alone decide.  Repeated rows are repeated, null ids and addresses
    stay null; other columns are ignored.  Pages never move between tasks.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or train(pages, url, page))
    rows = pages.select(pages[page_id].cast("long").alias("page_id"), pages[url].cast("string").alias("url"), F.coalesce(pages[page].cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [shared.value.text(p) for p in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return mapped(rows, run, "page_id long, url string, text string, n_chars long")
