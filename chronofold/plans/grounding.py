"""Documents linked to the match they discuss, and the source registry."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.text import blank_to_null, patch_hint, reply_slots, sha256
from chronofold.functions.values import compact_date, iso_now, lenient_timestamp, micros
from chronofold.operators.asof import neighbours
from chronofold.operators.counts import most_common
from chronofold.operators.lanes import DEFAULT_MAX_ROWS
from chronofold.operators.select import dealt, top_per_key
from chronofold.session import written
from chronofold.sources.tables import TableSpec, struct

# How far before and after a document its match may lie, in days, and how much of a
# document is searched for team names.
DAYS_BEFORE = 30
DAYS_AFTER = 1
HEAD_CHARS = 800

# Reliability tier and privacy risk by source type.
SOURCE_PROPERTIES = {
    "guide": ("B", "low"),
    "transcript": ("B", "high"),
    "article": ("C", "medium"),
    "forum": ("D", "high"),
}

# Columns of the registry.
REGISTRY = TableSpec(
    struct(
        {"source_id": "string"},
        {name: "string" for name in (
            "origin_uri", "source_type", "platform", "author_name", "title", "published_at", "ingested_at",
            "raw_hash", "reliability_tier", "privacy_risk_level", "processing_status", "match_id", "patch",
            "patch_hint",
        )},
    ),
    keys=("source_id",),
    buckets=16,
)

_DAY = 86_400_000_000
SEPARATOR = "\u001f"


# -- candidates ---------------------------------------------------------------------------------


def expand_aliases(matches: DataFrame, aliases: DataFrame, team1: str = "team1", team2: str = "team2") -> DataFrame:
    """One row per match and pair of names its teams are known by.

    Matches with an unknown team drop out, an ambiguous name multiplies rows.  No join is hinted:
    the alias side is broadcast only while its measured size is under the session threshold.
    """
    teams = aliases.where(F.col("entity_type") == "team").select("alias", "entity_id").distinct()
    resolved = matches
    for column, entity in ((team1, "_e1"), (team2, "_e2")):
        resolved = resolved.join(
            teams.select(F.col("alias").alias(column), F.col("entity_id").alias(entity)), column
        ).drop(column)
    for column, entity in ((team1, "_e1"), (team2, "_e2")):
        resolved = resolved.join(
            teams.select(F.col("entity_id").alias(entity), F.col("alias").alias(column)), entity
        ).drop(entity)
    return resolved


def build_candidates(matches: DataFrame, games: DataFrame, aliases: DataFrame) -> DataFrame:
    """Matches with the most common patch of their games, expanded to all team names."""
    patches = most_common(games, ["match_id"], "patch")
    return expand_aliases(matches.join(patches, "match_id", "left"), aliases)


# -- linking ------------------------------------------------------------------------------------


def reference_pair(teams: Column) -> Column:
    """Key of exactly two distinct team names, null otherwise."""
    names = F.transform(teams, lambda t: F.lower(F.trim(t)))
    distinct = F.array_sort(F.array_distinct(F.filter(names, lambda n: n.isNotNull() & (n != ""))))
    return F.when(F.size(distinct) == 2, F.array_join(distinct, SEPARATOR))


def link(
    documents: DataFrame,
    candidates: DataFrame,
    *,
    key: str,
    published: str,
    teams: str,
    event: str | None = None,
    keep: Sequence[str] = ("match_id", "patch", "tournament"),
    identity: Sequence[str] = ("match_id", "team1", "team2"),
    team1: str = "team1",
    team2: str = "team2",
    dated: str = "datetime_utc",
    tournament: str = "tournament",
    days_before: int = DAYS_BEFORE,
    days_after: int = DAYS_AFTER,
    max_rows: int = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Documents with the ``keep`` columns of their match, null when none fits.

    A candidate fits when its two teams are the document's pair and it is dated inside the
    window.  If the document names an event and some fitting candidate's tournament contains it,
    only those count.  The nearest in time wins, then the lowest ``identity``.

    The nearest candidate is carried along each pair's timeline, so a pair with many documents
    and many matches costs their sum and never their product.  Event hints are resolved once for all pairs,
    by an index of the tournaments' letters.
    """
    rank = F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity])
    right = candidates.select(
        reference_pair(F.array(team1, team2)).alias("_pair"),
        micros(lenient_timestamp(F.col(dated).cast("string"))).alias("_t"),
        rank.alias("_rank"),
        F.lower(F.coalesce(F.col(tournament), F.lit(""))).alias("_event"),
        F.struct(*keep).alias("_match"),
    ).where(F.col("_pair").isNotNull() & F.col("_t").isNotNull())
    left = documents.select(
        key,
        reference_pair(F.col(teams)).alias("_pair"),
        micros(F.col(published)).alias("_t"),
        F.lower(F.trim(blank_to_null(F.col(event)))).alias("_hint") if event else F.lit(None).cast("string").alias("_hint"),
    ).where(F.col("_pair").isNotNull() & F.col("_t").isNotNull())
    # Both sides are read several times below; the narrow copies spare recomputing what leads to them.
    left, right = written(left, "link-documents"), written(right, "link-candidates")
    reach = (days_before * _DAY, days_after * _DAY)

    anywhere = _nearest_in_reach(left, right, ["_pair"], reach, max_rows)
    if event:
        hints = left.where(F.col("_hint").isNotNull()).select("_pair", "_hint").distinct()
        events = right.groupBy("_pair", "_event").agg(F.min("_t").alias("_from"), F.max("_t").alias("_to"))
        told = events_of_hints(hints.select("_hint").distinct(), events.select("_event").distinct())
        named = hints.join(told, "_hint").join(events, ["_pair", "_event"])
        # A document only meets the events of its pair that were on inside its window.
        on = (F.col("_t") >= F.col("_from") - reach[1]) & (F.col("_t") <= F.col("_to") + reach[0])
        legs = left.join(named, ["_pair", "_hint"]).where(on).drop("_from", "_to")
        on_event = _nearest_in_reach(legs, right, ["_pair", "_event"], reach, max_rows)
        both = on_event.select(key, F.lit(0).alias("_stage"), "_best").unionByName(
            anywhere.select(key, F.lit(1).alias("_stage"), "_best")
        )
        # Two rows or more for each document; by the document at once, so that no task sorts more before the exchange than after it.
        best = top_per_key(
            dealt(both.where(F.col("_best").isNotNull()), 2 * left.count(), key), [key],
            [F.col("_stage"), F.col("_best.distance"), F.col("_best._rank")],
        )
    else:
        best = anywhere.where(F.col("_best").isNotNull()).select(key, "_best")
    found = best.select(key, *[F.col("_best._match")[c].alias(c) for c in keep])
    return documents.join(found, key, "left")


def events_of_hints(hints: DataFrame, events: DataFrame) -> DataFrame:
    """``_hint, _event`` of distinct hints and the distinct events that contain them."""
    return hint_candidates(hints, events).where(F.contains("_event", "_hint"))


def hint_candidates(hints: DataFrame, events: DataFrame) -> DataFrame:
    """Events that hold a hint's rarest three letters (all of a shorter hint), from an index of the events' letters.

    Each hint is posted under one run of letters, the one that fewest events hold, so hints and events never meet as a product."""
    runs = lambda text, n: F.array_distinct(F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.char_length(text), F.lit(1))), lambda i: i + (n - 1) <= F.char_length(text)),
        lambda i: F.substr(text, i, F.lit(n))))
    sized = hints.where(F.char_length("_hint") > 0).withColumn("_n", F.least(F.char_length("_hint"), F.lit(3)))
    asked = sized.select("_hint", F.explode(F.when(F.col("_n") == 3, runs(F.col("_hint"), 3)).otherwise(F.array("_hint"))).alias("_gram"))
    grams = F.explode(F.concat(*[runs(F.col("_event"), n) for n in (1, 2, 3)])).alias("_gram")
    index = events.select("_event", grams).join(asked.select("_gram").distinct(), "_gram", "left_semi")
    holders = index.groupBy("_gram").agg(F.count(F.lit(1)).alias("_uses"))
    rarest = asked.join(holders, "_gram", "left").groupBy("_hint").agg(F.min(F.struct(F.coalesce("_uses", F.lit(0)).alias("uses"), "_gram")).alias("_least"))
    return rarest.select("_hint", F.col("_least._gram").alias("_gram")).join(index, "_gram").select("_hint", "_event")


def _nearest_in_reach(left: DataFrame, right: DataFrame, by: list[str], reach: tuple[int, int], max_rows: int) -> DataFrame:
    sides = neighbours(
        left, right, by=by, on="_t", payload=["_rank", "_match"], tie=["_rank"], run="first",
        max_rows=max_rows, before="_b", after="_a",
    )
    option = lambda side, distance, limit: F.when(
        F.col(side).isNotNull() & (distance <= limit),
        F.struct(distance.alias("distance"), F.col(f"{side}._rank"), F.col(f"{side}._match")),
    )
    options = F.array_compact(F.array(
        option("_b", F.col("_t") - F.col("_b.at"), reach[0]),
        option("_a", F.col("_a.at") - F.col("_t"), reach[1]),
    ))
    return sides.withColumn("_best", F.array_min(options)).drop("_a", "_b")


# -- extraction ---------------------------------------------------------------------------------


class Generator(Protocol):
    """Anything that answers a prompt with text."""

    def generate(self, system: str, user: str, max_new_tokens: int = 128) -> str: ...


#: Names that are sent to every task; more are joined.
TERMS_IN_ROW = 200_000

SYSTEM_PROMPT = (
    "Read the text and name the professional match it is about. Answer with one JSON object: "
    '"teams" lists the team names as they are written (none, one or two), "event" is the tournament '
    'or null, "game_number" is the game within the series or null. If no particular match is meant, '
    "leave the list empty."
)


def generated_references(
    documents: DataFrame, make: Callable[[], Generator], *, key: str, text: str,
    system: str = SYSTEM_PROMPT, head_chars: int = HEAD_CHARS, max_new_tokens: int = 128,
) -> DataFrame:
    """``key, teams, event, game_number`` from an injected text generator.

    The generator is built once per partition; only the key and the head of the text travel to
    Python, and the replies are parsed back on the JVM.
    """
    def answer(batches: Iterator) -> Iterator:
        generator = make()
        for batch in batches:
            batch["reply"] = [generator.generate(system, t, max_new_tokens=max_new_tokens) for t in batch["head"]]
            yield batch[[key, "reply"]]

    heads = documents.select(key, F.substring(F.coalesce(F.col(text), F.lit("")), 1, head_chars).alias("head"))
    kind = documents.schema[key].dataType.simpleString()
    replies = heads.mapInPandas(answer, f"{key} {kind}, reply string")
    return replies.withColumn("_s", reply_slots(F.col("reply"))).select(key, "_s.teams", "_s.event", "_s.game_number")


def words_of(text: Column) -> Column:
    """Lower-case words of a text: runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def gazetteer_references(
    documents: DataFrame, names: DataFrame, *, key: str, text: str,
    name: str = "alias", entity: str = "entity_id", head_chars: int | None = HEAD_CHARS, terms_in_row: int = TERMS_IN_ROW,
) -> DataFrame:
    """``key, teams, event, game_number`` by looking names up in the text.

    Every run of words as long as some name is looked up; each entity found contributes the name
    seen first.  ``head_chars=None`` searches whole texts.  Up to ``terms_in_row`` different names are sent to the tasks, which give out the runs that are names
    and nothing else; more names are joined with all runs.
    """
    spelled = names.select(F.array_join(words_of(F.col(name)), " ").alias("_term"), F.col(entity).alias("_entity"))
    spelled = spelled.where(F.col("_term") != "").distinct()
    body = F.coalesce(F.col(text), F.lit(""))
    body = body if head_chars is None else F.substring(body, 1, head_chars)
    worded = documents.select(key, words_of(body).alias("_words"))
    # A row more than may be sent tells that there are too many.
    terms = [r[0] for r in spelled.select("_term").distinct().limit(terms_in_row + 1).collect()]
    met = _met_in_row(worded, key, terms) if len(terms) <= terms_in_row else _met_by_join(worded, key, spelled)
    hits = met.join(spelled, "_term")
    first = hits.groupBy(key, "_entity").agg(F.min(F.struct("_at", "_term")).alias("_hit"))
    found = first.groupBy(key).agg(
        F.array_distinct(F.transform(F.array_sort(F.collect_list("_hit")), lambda h: h["_term"])).alias("teams")
    )
    found = found if terms else documents.select(key, F.array().cast("array<string>").alias("teams"))
    return found.withColumns(
        {"event": F.lit(None).cast("string"), "game_number": F.lit(None).cast("int")}
    )


def _met_by_join(worded: DataFrame, key: str, spelled: DataFrame) -> DataFrame:
    """``key, _at, _term`` of all runs of as many words as some name has."""
    # Word counts of names: a handful of small numbers.
    lengths = [r[0] for r in spelled.select(F.size(F.split("_term", " "))).distinct().collect()]
    return worded.select(key, F.inline(F.flatten(F.array(*[_runs(F.col("_words"), n) for n in sorted(lengths)]))))


def _met_in_row(worded: DataFrame, key: str, terms: list[str]) -> DataFrame:
    """``key, _at, _term`` of the runs that are names: a batch's words are looked up in the names' first words, and only runs that begin
    with one of them in the names."""
    by_length: dict[int, list[str]] = {}
    for term in terms:
        by_length.setdefault(term.count(" ") + 1, []).append(term)
    tables = [(n, pa.array({t.split(" ", 1)[0] for t in some}), pa.array(some)) for n, some in sorted(by_length.items())]
    kind = worded.schema[key].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_words")
            words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            of = np.repeat(np.arange(len(sizes)), sizes)
            start = (ends - sizes)[of] if len(of) else of
            found = []
            for n, firsts, names in tables:
                at = np.flatnonzero(pc.is_in(words, value_set=firsts).to_numpy(zero_copy_only=False))
                at = at[at + n <= ends[of[at]]]
                run = pc.binary_join_element_wise(*(words.take(pa.array(at + k)) for k in range(n)), " ") if n > 1 else words.take(pa.array(at))
                place = pc.index_in(run, value_set=names)
                hit = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
                at = at[hit]
                found.append(pa.RecordBatch.from_arrays(
                    [batch.column(key).take(pa.array(of[at])), pa.array(at - start[at] + 1, pa.int32()), run.take(pa.array(hit))], names=[key, "_at", "_term"]))
            yield from found

    return worded.mapInArrow(search, f"{key} {kind}, _at int, _term string")


def _runs(words: Column, n: int) -> Column:
    """All runs of ``n`` words with the position of their first occurrence's start."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        starts,
        lambda i: F.struct(i.alias("_at"), F.array_join(F.slice(words, i, F.lit(n)), " ").alias("_term")),
    )


# -- registry -----------------------------------------------------------------------------------


def transcript_content(segments: Column, title: Column) -> Column:
    """Segment texts joined by blanks, or the title of a transcript without segments."""
    texts = F.array_join(F.transform(segments, lambda s: F.coalesce(s["text"], F.lit(""))), " ")
    return F.when(F.size(F.coalesce(segments, F.array())) > 0, texts).otherwise(F.coalesce(title, F.lit("")))


def grounding_text(title: Column, content: Column) -> Column:
    """Title and content on two lines without outer white space."""
    both = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(content, F.lit("")))
    return F.regexp_replace(both, r"^\s+|\s+$", "")


def read_once(documents: DataFrame, content: str) -> DataFrame:
    """Documents with what the registry takes from the content (``_hash``, ``_hint``) instead of the content.

    Both are computed in the scan, so that no text has to follow its row through a join."""
    return documents.withColumns(
        {"_hash": sha256(F.col(content)), "_hint": patch_hint(F.col("origin_uri"), F.col(content))}
    ).drop(content)


def registry_rows(documents: DataFrame, *, source_type: Column, ingested_at: Column | None = None) -> DataFrame:
    """Registry rows of documents out of :func:`read_once` that carry ``match_id`` and ``patch`` (null when not linked)."""
    facts = {
        name: F.create_map(*[F.lit(x) for kind, values in SOURCE_PROPERTIES.items() for x in (kind, values[i])])
        for i, name in enumerate(("tier", "risk"))
    }
    linked = F.col("match_id").isNotNull()
    return documents.select(
        F.col("source_id").cast("string").alias("source_id"),
        "origin_uri",
        source_type.alias("source_type"),
        "platform",
        "author_name",
        "title",
        "published_at",
        (iso_now() if ingested_at is None else ingested_at).alias("ingested_at"),
        F.col("_hash").alias("raw_hash"),
        F.element_at(facts["tier"], source_type).alias("reliability_tier"),
        F.element_at(facts["risk"], source_type).alias("privacy_risk_level"),
        F.when(linked, "grounded").otherwise("ungrounded").alias("processing_status"),
        "match_id",
        F.when(linked, F.col("patch")).alias("patch"),
        F.when(~linked, F.col("_hint")).alias("patch_hint"),
    )


def ground_documents(
    transcripts: DataFrame, candidates: DataFrame, extract: Callable[[DataFrame], DataFrame], *,
    ingested_at: Column | None = None, max_rows: int = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """Registry rows of transcripts.

    ``extract`` maps ``source_id, grounding_text`` to ``source_id, teams, event``.  Documents without
    a readable date or without text are registered but not linked.
    """
    titled = transcripts.withColumn("title", F.coalesce("title", F.lit("")))
    bodies = titled.withColumn("_content", transcript_content(F.col("segments"), F.col("title"))).drop("segments")
    texts = bodies.select("source_id", grounding_text(F.col("title"), F.col("_content")).alias("grounding_text"))
    slots = extract(texts.where(F.col("grounding_text") != ""))
    dated = bodies.select("source_id", compact_date(F.col("published_at")).alias("_published"))
    references = dated.join(slots.select("source_id", "teams", "event"), "source_id")
    linked = link(
        references, candidates, key="source_id", published="_published", teams="teams", event="event",
        keep=("match_id", "patch"), max_rows=max_rows,
    ).select("source_id", "match_id", "patch")
    rows = read_once(bodies, "_content").join(linked, "source_id", "left")
    return registry_rows(rows, source_type=F.lit("transcript"), ingested_at=ingested_at)


def registry_metrics(rows: DataFrame) -> DataFrame:
    """One row: documents processed, linked and not linked."""
    status = F.col("processing_status")
    return rows.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(status == "grounded").alias("grounded"),
        F.count_if(status == "ungrounded").alias("ungrounded"),
    )
