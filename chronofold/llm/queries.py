"""The registered queries of this package, each an operator applied to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chronofold.llm import bpe, dart, html, langid, lexical, metric, packing, phrases, quality, simhash, suffix, urls, whiten

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: Words of every text, one row per word with its place.
_WORDS = r"""
words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)"""

#: Classes of texts that are equal or share four fifths of their 5-word shingles.
_NEAR = "WITH RECURSIVE" + _WORDS + """,
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT p.a, p.b FROM pairs p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b WHERE 5 * p.n >= 4 * (x.n + y.n - p.n)
  UNION SELECT min(doc_id) OVER (PARTITION BY coalesce(text, '')), doc_id FROM documents),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT r.node, l.b FROM reached r JOIN both_ways l ON l.a = r.other)
SELECT node AS doc_id, min(other) AS class_id FROM reached GROUP BY node
"""

#: Words outside all 13-word windows that a smaller document has.
_PHRASES = "WITH" + _WORDS + """,
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)),
firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM windows JOIN firsts USING (s) WHERE first < doc_id),
each_word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM words),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS t FROM each_word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

#: Components of documents that share 85 hundredths of their 4-word shingles.
_LINKED = "WITH RECURSIVE" + _WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + """,
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT p.a, p.b FROM pairs p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT r.node, l.b FROM reached r JOIN both_ways l ON l.a = r.other)
SELECT node AS doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(other) AS component_id FROM reached LEFT JOIN sizes ON sizes.doc_id = node GROUP BY node
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The ten best documents of every item, from all documents that hold one of its terms.
_RANKED = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
lengths AS (SELECT doc_id, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
size AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths),
asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
postings AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM postings, size GROUP BY term, docs),
scores AS (
  SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), size GROUP BY ALL),
places AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM places WHERE place <= 10
""".replace("LOWERED", _LOWERED)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    """Puts a function of (spark, folder) into the registry."""

    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@registered("op1_simhash_block_tables")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return simhash.fingerprinted(table(spark, folder, "documents"))


@registered("op2_columnwise_suffix_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the byte strings that occur more than once."""
    return suffix.without_repeats(table(spark, folder, "documents"))


@registered("op3_divergence_rules")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Plain counts and the verdict of the divergence rules for every document."""
    docs = table(spark, folder, "documents")
    out = quality.judged(docs, quality.learn_references(docs), ("doc_id",))
    return out.withColumn("doc_id", out["doc_id"].cast("long"))


@registered("op4_best_fit_packing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's token pieces and their places in sequences."""
    return packing.packed(table(spark, folder, "documents"), TOKENIZER)


@registered("op5_tree_model_extraction")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return html.extracted(table(spark, folder, "pages"))


@registered("op6_dart_minhash", _NEAR)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return dart.near_duplicates(table(spark, folder, "documents"))


@registered("op7_naive_bayes_language")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document."""
    return langid.identified(table(spark, folder, "documents"))


@registered("op8_bpe_segment_tree")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids and their decoding of every document, as digests."""
    return bpe.encode_documents(table(spark, folder, "documents"), TOKENIZER)


@registered("op9_repeated_phrase_automata", _PHRASES)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages that a document of a smaller id has."""
    return phrases.without_passages(table(spark, folder, "documents"))


@registered("op10_association_rule_urls")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, fitting rule and verdict of every page."""
    return urls.judged(table(spark, folder, "pages"), table(spark, folder, "labels"))


@registered("op11_nra_search", _RANKED)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@registered("op12_jaccard_voronoi_join", _LINKED)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document among those that share most of their 4-word shingles."""
    return metric.joined(table(spark, folder, "documents"))


@registered("op13_bidiagonal_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """The four leading whitened components of every embedding."""
    return whiten.whitened(table(spark, folder, "embeddings"))
