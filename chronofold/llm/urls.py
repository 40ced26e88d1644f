"""URL verdicts: host and path rules first, then association rules mined from labelled URLs by FP-growth."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.scratch import Scratch

#: An association rule counts from so many labelled URLs on, whatever their number, and from this confidence on.
LEAST_ROWS, LEAST_CONFIDENCE = 20, 0.8
BLOCK, ALLOW = "block", "allow"
_VERDICT = "verdict="


@dataclass(frozen=True)
class Rule:
    """A host, with all its subdomains, and how paths start."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query, as its contract gives them.
RULES = (
    Rule("com", "/", ALLOW), Rule("example.com", "/en/", BLOCK), Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK), Rule("net", "/fr/", BLOCK),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without a host mark."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as (text, verdict); null if none does.  Of equal length the first in the list wins."""
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in reversed(sorted(rules, key=lambda r: -len(r.text))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: the labels of its host and the parts of its path; numbers are one token."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("host:"), x))
    parts = F.transform(
        F.filter(F.split(F.lower(path), r"[/._-]+"), lambda x: x != ""),
        lambda x: F.concat(F.lit("path:"), F.when(x.rlike(r"^\d+$"), F.lit("#")).otherwise(x)),
    )
    return F.array_distinct(F.concat(labels, parts))


def token_classes(labelled: DataFrame) -> DataFrame:
    """``token``, ``class``: tokens that the same labelled rows (``tokens``, ``verdict``) have are one class, named by the first of them.

    Tokens that always occur together tell the same; as one item they do not multiply the combinations.  Rows are told by two exclusive sums of their hashes."""
    rows = labelled.select("tokens", F.monotonically_increasing_id().alias("row"))
    rows = rows.select(F.explode("tokens").alias("token"), F.xxhash64("row").alias("a"), F.xxhash64("row", F.lit(1)).alias("b"))
    marks = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    first = marks.groupBy("n", "a", "b").agg(F.min("token").alias("class"))
    return marks.filter(F.col("n") >= LEAST_ROWS).join(first, ["n", "a", "b"]).select("token", "class")


def mined_rules(labelled: DataFrame, tables: Scratch) -> tuple[DataFrame, DataFrame] | None:
    """Rules that tell :data:`BLOCK` (``items``, ``confidence``) and the classes (``token``, ``class``) that their items name; None without labels.

    From ``tokens`` and ``verdict``.  A rule holds for rows that have a token of each of its classes.  Single classes are counted; those that are confident alone, and
    those with too few bad rows for any rule, do not enter the baskets of FP-growth.  A combination with a part that is confident already adds nothing
    and is dropped.
    """
    n = labelled.count()
    if not n:
        return None
    labelled = tables.written(labelled.select("tokens", "verdict"), "labelled")
    classes = tables.written(token_classes(labelled), "token-classes")
    bad = F.col("verdict") == BLOCK
    rows = labelled.select(F.monotonically_increasing_id().alias("row"), "tokens", bad.alias("bad"))
    exploded = rows.select("row", "bad", F.explode("tokens").alias("token")).join(classes, "token").select("row", "bad", "class").distinct()
    exploded = tables.written(exploded, "class-rows")
    single = exploded.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"))
    confident = F.col("bad") >= LEAST_CONFIDENCE * F.col("n")
    alone = single.filter(confident).select(F.array("class").alias("items"), (F.col("bad") / F.col("n")).alias("confidence"))
    open_classes = single.filter(~confident & (F.col("bad") >= LEAST_CONFIDENCE * LEAST_ROWS)).select("class")
    baskets = exploded.join(open_classes, "class").groupBy("row", "bad").agg(F.collect_set("class").alias("items"))
    baskets = tables.written(baskets.select(F.concat("items", F.array(F.concat(F.lit(_VERDICT), F.when(F.col("bad"), BLOCK).otherwise(ALLOW)))).alias("items")), "baskets")
    size = baskets.count()
    if not size:
        return alone, classes
    model = FPGrowth(itemsCol="items", minSupport=max(0.0, min(1.0, (LEAST_CONFIDENCE * LEAST_ROWS - 0.5) / size)), minConfidence=LEAST_CONFIDENCE).fit(baskets)
    told = model.associationRules.filter((F.col("consequent")[0] == _VERDICT + BLOCK) & (F.round(F.col("support") * size / F.col("confidence")) >= LEAST_ROWS))
    told = alone.union(told.select(F.array_sort("antecedent").alias("items"), "confidence"))
    told = tables.written(told, "told")
    parts = told.select(F.col("items").alias("part"), F.col("part")[0].alias("token"))
    wider = told.select("items", F.explode("items").alias("token")).join(parts, "token").filter(
        (F.size("part") < F.size("items")) & (F.size(F.array_except("part", "items")) == 0)
    )
    return told.join(wider.select("items").distinct(), "items", "left_anti"), classes


def blocked_urls(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct ``url`` whose ``tokens`` hold a token of every class of a rule; a null url holds none.

    The index has each rule under one class, the one that fewest URLs have; a URL looks up its own classes and then checks the rest.
    """
    postings = rules.select("items", F.explode("items").alias("class"))
    used = classes.join(postings.select("class").distinct(), "class")
    found = urls.filter("url is not null").select("url", F.explode("tokens").alias("token")).join(used, "token").select("url", "class").distinct()
    holders = found.groupBy("class").agg(F.count(F.lit(1)).alias("uses"))
    index = postings.join(holders, "class").groupBy("items").agg(F.min_by("class", F.struct("uses", "class")).alias("class"))
    own = found.groupBy("url").agg(F.collect_set("class").alias("own"))
    met = own.select("url", "own", F.explode("own").alias("class")).join(index, "class")
    return met.filter(F.size(F.array_except("items", "own")) == 0).select("url").distinct()


def judged(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` of every row.

    Pages whose id has a label of low quality or toxicity teach what to block, other labelled pages what to allow; an id with several labels counts as
    bad if one is.  A URL that no rule fits is blocked if a mined rule fits, else allowed.  A null URL, or one without ``://``, has an empty host and
    path, no rule and no token.  Repeated rows get the same verdict; without labels nothing is mined; other columns are ignored.
    """
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].cast("string").alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    bad = F.max(F.coalesce((labels["quality"] == 0) | (labels["toxic"] == 1), F.lit(False)))
    marks = labels.filter(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].alias("page_id")).agg(F.when(bad, BLOCK).otherwise(ALLOW).alias("verdict"))
    tokens = tokens_of(F.col("host"), F.col("path"))
    tables = Scratch(pages.sparkSession)
    mined = mined_rules(rows.join(marks, "page_id").select(tokens.alias("tokens"), "verdict"), tables)
    told = rows.withColumn("told", rule_of(F.col("host"), F.col("path"), rules))
    if mined is None:
        out = told.withColumn("hit", F.lit(False))
    else:
        hits = blocked_urls(rows.select("url", tokens.alias("tokens")), *mined)
        # Rows without a URL have no part in the join, where they would be one key.
        out = told.filter("url is not null").join(hits.withColumn("hit", F.lit(True)), "url", "left")
        out = out.unionByName(told.filter("url is null").withColumn("hit", F.lit(False)))
    verdict = F.coalesce(F.col("told.verdict"), F.when(F.coalesce("hit", F.lit(False)), BLOCK).otherwise(ALLOW))
    return out.select("page_id", "host", "path", F.col("told.text").alias("rule"), verdict.alias("verdict"))
