"""Queries on documents: hashes, hints, extraction, linking and the registry."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.functions.text import first_filled, joined, patch_hint, reply_slots, roman_to_int, sha256, yes_no
from chronofold.functions.values import (
    compact_date, epoch_millis, lenient_timestamp, map_bump, micros, seconds_apart, year_month,
)
from chronofold.plans.grounding import (
    REGISTRY, gazetteer_references, generated_references, ground_documents, link, read_once, registry_metrics, registry_rows,
    transcript_content,
)
from chronofold.session import written
from chronofold.suite.base import Tables, query
from chronofold.suite.stores import store_for


@query("H15", "SELECT doc_id, sha256(text) AS hash, length(text) AS chars FROM documents")
def document_hashes(t: Tables) -> DataFrame:
    """SHA-256 and length of whole texts."""
    return t.documents.select("doc_id", sha256(F.col("text")).alias("hash"), F.length("text").cast("long").alias("chars"))


_URI = "'/data/' || source || CASE WHEN lang = 'en' THEN '/Patch_14.' || doc_id % 30 ELSE '/notes' END || '.json'"


@query("H8 Q10", f"""
SELECT doc_id, coalesce(
  nullif(regexp_extract(regexp_replace(regexp_extract({_URI}, '([^/]*)/*$', 1), '\\.[^.]*$', ''), '(?i)\\b(patch[- _]?)?(\\d{{2,2}}\\.\\d{{1,2}})\\b', 2), ''),
  nullif(regexp_extract(substr(text, 1, 2000), '(?i)\\b(patch[- _]?)?(\\d{{2,2}}\\.\\d{{1,2}})\\b', 2), '')) AS hint
FROM documents
""")
def patch_hints(t: Tables) -> DataFrame:
    """Patch from the file name, else from the head of the text."""
    folder = F.concat(F.lit("/data/"), "source")
    name = F.when(F.col("lang") == "en", F.concat(F.lit("/Patch_14."), (F.col("doc_id") % 30).cast("string"))).otherwise("/notes")
    return t.documents.select("doc_id", patch_hint(F.concat(folder, name, F.lit(".json")), F.col("text")).alias("hint"))


@query("H10", """
SELECT doc_id, CASE WHEN lang = 'de' THEN NULL ELSE lang || '|' || source END AS teams,
  CASE WHEN lang IN ('fr', 'en') THEN 'Cup' END AS event,
  CASE WHEN lang = 'en' THEN (doc_id % 5)::INTEGER END AS game_number
FROM documents
""")
def parsed_replies(t: Tables) -> DataFrame:
    """Slots of JSON objects inside prose, well-formed and not."""
    teams = F.concat(F.lit('{"teams": [" '), "lang", F.lit(' ", "'), "source", F.lit('", " "], "event": '))
    number = (F.col("doc_id") % 5).cast("string")
    reply = (
        F.when(F.col("lang") == "en", F.concat(F.lit("Sure!\n"), teams, F.lit('"Cup", "game_number": '), number, F.lit("} Done.")))
        .when(F.col("lang") == "fr", F.concat(teams, F.lit('"Cup", "game_number": "two"}')))
        .when(F.col("lang") == "de", F.concat(teams, F.lit('"Cup", ')))
        .otherwise(F.concat(teams, F.lit('""}')))
    )
    slots = t.documents.select("doc_id", reply_slots(reply).alias("s"))
    return slots.select("doc_id", F.array_join("s.teams", "|").alias("teams"), "s.event", "s.game_number")


@query("H11 H12 H13 H19", """
SELECT o_orderkey, epoch_us(o_orderdate) AS lenient, CASE WHEN o_orderstatus = 'F' THEN epoch_us(o_orderdate::DATE::TIMESTAMP) END AS compact,
  strftime(o_orderdate, '%Y%m') AS month, epoch_us(o_orderdate) // 1000 AS millis, abs(epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1995-06-17')) / 1e6 AS apart
FROM orders
""")
def parsed_dates(t: Tables) -> DataFrame:
    """Dates read from ISO-like and compact text; unreadable text is null."""
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.when(F.col("o_orderstatus") == "O", "Z").otherwise(""))
    compact = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyyMMdd")).otherwise("1995-13")
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return t.orders.select(
        "o_orderkey", micros(lenient_timestamp(iso)).alias("lenient"), micros(compact_date(compact)).alias("compact"),
        year_month(F.col("o_orderdate")).alias("month"), F.unix_millis(epoch_millis(millis).cast("timestamp")).alias("millis"),
        seconds_apart(F.col("o_orderdate"), F.lit("1995-06-17").cast("timestamp_ntz")).alias("apart"))


@query("H18", """
SELECT p_partkey, [1, 2, 3, 4, 9, 14, 40, 90, 400, 1994][p_size % 10 + 1]::INTEGER AS value FROM part
""")
def roman_values(t: Tables) -> DataFrame:
    numerals = ["I", "II", "III", "IV", "IX", "XIV", "XL", "XC", "CD", "MCMXCIV"]
    numeral = F.element_at(F.array(*[F.lit(n) for n in numerals]), F.col("p_size") % 10 + 1)
    return t.part.select("p_partkey", roman_to_int(numeral).alias("value"))


@query("H2 H3 H6 H17", """
SELECT doc_id, CASE WHEN quality = 1 THEN 'Yes' ELSE 'No' END AS good, coalesce(nullif(lang, 'en'), source) AS shown,
  CASE WHEN toxic IS NOT NULL THEN lang || '_' || toxic END AS label, contains(lower(text), 'the') AS has_the,
  starts_with(trim(text), 'The') AS starts_the, replace(source, 'src', 's') AS short
FROM documents LEFT JOIN labels USING (doc_id)
""")
def text_flags(t: Tables) -> DataFrame:
    """Flags, defaults, null-keeping concatenation and simple text predicates."""
    d = t.documents.join(t.labels, "doc_id", "left")
    other = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    return d.select(
        "doc_id", yes_no(F.col("quality").cast("string")).alias("good"), first_filled(other, F.col("source")).alias("shown"),
        joined("_", F.col("lang"), F.col("toxic").cast("string")).alias("label"),
        F.contains(F.lower("text"), F.lit("the")).alias("has_the"), F.startswith(F.trim("text"), F.lit("The")).alias("starts_the"),
        F.replace("source", F.lit("src"), F.lit("s")).alias("short"))


@query("H21", """
SELECT event_id, (json_extract_string(props, '$.k')::INTEGER % 3 + 1)::INTEGER AS up, greatest(0, (json_extract_string(props, '$.k')::INTEGER % 3) - 1)::INTEGER AS down
FROM events
""")
def counters_in_maps(t: Tables) -> DataFrame:
    """Counters in a map moved up and down, stopping at zero."""
    n = F.get_json_object("props", "$.k").cast("int") % 3
    held = F.create_map(F.lit("x"), n)
    value = lambda m: F.coalesce(F.try_element_at(m, F.lit("x")), F.lit(0))
    return t.events.select("event_id", value(map_bump(held, F.lit("x"), 1)).alias("up"), value(map_bump(held, F.lit("x"), -1)).alias("down"))


@query("P23", """
SELECT doc_id, CASE WHEN lang = 'es' THEN source ELSE replace(text, chr(10), ' ') END AS content FROM documents
""")
def assembled_contents(t: Tables) -> DataFrame:
    """Segment texts joined, or the title where there are none."""
    return t.documents.select("doc_id", transcript_content(line_segments(), F.col("source")).alias("content"))


def line_segments():
    """Lines of a text as segments; none for Spanish texts."""
    lines = F.transform(F.split("text", "\n", -1), lambda s: F.struct(s.alias("text")))
    return F.when(F.col("lang") != "es", lines)


@query("X2 J17", """
WITH items AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
names AS (SELECT term, min(item_id) AS entity FROM (
  SELECT item_id, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS term FROM items) GROUP BY 1),
words AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
pairs AS (SELECT doc_id, unnest([{'at': i, 'term': w[i] || ' ' || w[i + 1]} for i in range(1, len(w))]) AS p FROM words),
hits AS (SELECT doc_id, n.entity, min({'at': p.at, 'term': p.term}) AS first FROM pairs JOIN names n ON n.term = p.term GROUP BY ALL)
SELECT doc_id, string_agg(first.term, '|' ORDER BY first.at) AS teams, count(*) AS found FROM hits GROUP BY doc_id
""")
def names_found(t: Tables) -> DataFrame:
    """Word pairs of the whole benchmark items, as names of the first item that has them, looked up in whole texts."""
    from chronofold.plans.grounding import words_of

    words = t.benchmark.select("item_id", words_of(F.col("text")).alias("w")).where("size(w) > 1")
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))
    names = words.select("item_id", F.explode(pairs).alias("alias")).groupBy("alias").agg(F.min("item_id").alias("entity_id"))
    found = gazetteer_references(t.documents, names, key="doc_id", text="text", head_chars=None)
    return found.select("doc_id", F.array_join("teams", "|").alias("teams"), F.size("teams").cast("long").alias("found"))


class FirstWords:
    """Stand-in generator: names the first two words of the text."""

    def generate(self, system: str, user: str, max_new_tokens: int = 128) -> str:
        return "Answer: " + json.dumps({"teams": user.split(" ")[:2], "event": None, "game_number": len(user) % 3})


@query("X2 X3 H10", """
SELECT conv_id * 1000 + turn AS id, list_filter([trim(x) for x in string_split(substr(text, 1, 800), ' ')[1:2]], lambda x: x <> '')[1] AS first_team,
  (length(substr(text, 1, 800)) % 3)::INTEGER AS game_number FROM conversations
""")
def generated_slots(t: Tables) -> DataFrame:
    """Slots from an injected text generator, one instance per partition."""
    texts = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    slots = generated_references(texts, FirstWords, key="id", text="text")
    return slots.select("id", F.get("teams", F.lit(0)).alias("first_team"), "game_number")


_LINK = """
WITH o AS (
  SELECT o_orderkey AS k, o_orderstatus AS status, epoch_us(o_orderdate) AS ts, n_name AS a, o_orderpriority AS b, c_mktsegment AS seg,
    lower(substr(c_mktsegment, 2, 4)) AS hint, c_mktsegment || ' ' || year(o_orderdate) AS event
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
pairs AS (
  SELECT d.k, c.k AS m, c.event, contains(lower(c.event), d.hint) AS on_event, abs(d.ts - c.ts) AS gap, c.k || chr(31) || c.a || chr(31) || c.b AS rank
  FROM o d JOIN o c ON d.a = c.a AND d.b = c.b AND c.ts BETWEEN d.ts - 30 * 86400000000 AND d.ts + 86400000000
  WHERE d.status <> 'F' AND c.status = 'F'),
best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY k ORDER BY on_event DESC, gap, rank) = 1)
SELECT o.k AS doc, best.m AS match_id, best.event AS tournament FROM o LEFT JOIN best ON best.k = o.k WHERE o.status <> 'F'
"""


@query("J15 J16 J17 W9", _LINK)
def linked_orders(t: Tables) -> DataFrame:
    """Open orders linked to the closed order of the same nation and priority nearest in time, the hinted segment first."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    documents = rows.where("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("doc"), F.col("o_orderdate").alias("published"), F.array("o_orderpriority", "n_name").alias("teams"),
        F.expr("substr(c_mktsegment, 2, 4)").alias("event"))
    known = rows.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("match_id"), F.col("n_name").alias("team1"), F.col("o_orderpriority").alias("team2"),
        F.col("o_orderdate").alias("datetime_utc"), F.concat("c_mktsegment", F.lit(" "), F.year("o_orderdate").cast("string")).alias("tournament"))
    found = link(documents, known, key="doc", published="published", teams="teams", event="event", keep=("match_id", "tournament"))
    return found.select("doc", "match_id", "tournament")


def transcripts(t: Tables) -> DataFrame:
    """Documents as transcripts whose title names two teams: the language and the source."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 300).cast("int"))
    return t.documents.select(
        F.col("doc_id").cast("string").alias("source_id"), F.concat(F.lit("https://v.example.org/"), "source").alias("origin_uri"),
        F.lit("video").alias("platform"), F.col("source").alias("author_name"),
        F.concat(F.lit("Team "), "lang", F.lit(" vs Team "), "source").alias("title"),
        F.date_format(day, "yyyyMMdd").alias("published_at"), line_segments().alias("segments"))


def transcript_candidates(t: Tables) -> DataFrame:
    """Labelled documents as matches between their language and their source."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") * 7 % 300).cast("int"))
    return t.documents.join(t.labels, "doc_id").select(
        F.concat(F.lit("m"), F.col("doc_id").cast("string")).alias("match_id"), F.concat(F.lit("Team "), "source").alias("team1"),
        F.concat(F.lit("team "), "lang").alias("team2"), day.cast("string").alias("datetime_utc"), F.lit("cup").alias("tournament"),
        F.when(F.col("quality") == 1, "14.1").alias("patch"))


def grounded(t: Tables) -> DataFrame:
    names = t.documents.select(F.explode(F.array("lang", "source")).alias("n")).distinct().select(
        F.concat(F.lit("Team "), "n").alias("alias"), F.col("n").alias("entity_id"))
    extract = lambda texts: gazetteer_references(texts, names, key="source_id", text="grounding_text")
    return ground_documents(transcripts(t), transcript_candidates(t), extract, ingested_at=F.lit("now"))


_GROUNDED = """
WITH docs AS (SELECT doc_id, lang, source, DATE '2024-01-01' + (doc_id % 300)::INTEGER AS day,
    CASE WHEN lang = 'es' THEN 'Team ' || lang || ' vs Team ' || source ELSE replace(text, chr(10), ' ') END AS content FROM documents),
cand AS (SELECT 'm' || doc_id AS match_id, lang, source, DATE '2024-01-01' + (doc_id * 7 % 300)::INTEGER AS day,
    CASE WHEN quality = 1 THEN '14.1' END AS patch FROM documents JOIN labels USING (doc_id)),
best AS (SELECT d.doc_id, c.match_id, c.patch FROM docs d JOIN cand c ON c.lang = d.lang AND c.source = d.source
    AND c.day BETWEEN d.day - 30 AND d.day + 1
  QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY abs(c.day - d.day), c.match_id || chr(31) || 'Team ' || c.source) = 1),
registry AS (
  SELECT doc_id::VARCHAR AS source_id, 'transcript' AS source_type, strftime(day, '%Y%m%d') AS published_at, sha256(content) AS raw_hash,
    'B' AS reliability_tier, 'high' AS privacy_risk_level, CASE WHEN match_id IS NULL THEN 'ungrounded' ELSE 'grounded' END AS processing_status,
    match_id, patch, CASE WHEN match_id IS NULL THEN nullif(regexp_extract(substr(content, 1, 2000), '(?i)\\b(patch[- _]?)?(\\d{2,2}\\.\\d{1,2})\\b', 2), '') END AS patch_hint
  FROM docs LEFT JOIN best USING (doc_id))
"""


@query("N9 P22 P23 X2 J15 H15", _GROUNDED + "SELECT * FROM registry")
def grounded_documents(t: Tables) -> DataFrame:
    """Documents registered and linked to the match their title names."""
    return grounded(t).select(
        "source_id", "source_type", "published_at", "raw_hash", "reliability_tier", "privacy_risk_level", "processing_status",
        "match_id", "patch", "patch_hint")


@query("N9 S13 A9", _GROUNDED + """
SELECT count(*) AS processed, count(*) FILTER (processing_status = 'grounded') AS grounded,
  count(*) FILTER (processing_status = 'ungrounded') AS ungrounded FROM registry
""")
def registry_counts(t: Tables) -> DataFrame:
    """Registry upserted twice and its run metrics."""
    store = store_for(t, {"source_registry": REGISTRY})
    # Written, so that the texts are read and linked once for both upserts.
    rows = written(grounded(t), "registry")
    store.write("source_registry", rows, "upsert")
    store.write("source_registry", rows, "upsert")
    return registry_metrics(store.scan("source_registry"))


@query("P22 J18", """
SELECT page_id::VARCHAR AS source_id, ['guide', 'transcript', 'article', 'forum'][page_id % 4 + 1] AS source_type, sha256(html) AS raw_hash,
  ['B', 'B', 'C', 'D'][page_id % 4 + 1] AS reliability_tier, ['low', 'high', 'medium', 'high'][page_id % 4 + 1] AS privacy_risk_level,
  CASE WHEN page_id % 3 = 0 THEN 'grounded' ELSE 'ungrounded' END AS processing_status
FROM pages
""")
def registered_pages(t: Tables) -> DataFrame:
    """Registry rows of every source type."""
    kinds = F.array(*[F.lit(k) for k in ("guide", "transcript", "article", "forum")])
    none = F.lit(None).cast("string")
    pages = t.pages.select(
        F.col("page_id").alias("source_id"), F.col("url").alias("origin_uri"), none.alias("platform"), none.alias("author_name"),
        none.alias("title"), none.alias("published_at"), F.when(F.col("page_id") % 3 == 0, "m").alias("match_id"), none.alias("patch"), "html",
        F.element_at(kinds, (F.col("page_id") % 4 + 1).cast("int")).alias("kind"))
    rows = registry_rows(read_once(pages, "html"), source_type=F.col("kind"), ingested_at=F.lit("now"))
    return rows.select("source_id", "source_type", "raw_hash", "reliability_tier", "privacy_risk_level", "processing_status")
