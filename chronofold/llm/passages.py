"""Repeated passages of a corpus: every window of a fixed number of units (words or bytes) that occurs more than once.

A window is represented by its smallest gram, its anchor: equal windows have equal anchors at the same place.  Only anchors that recur
are followed; consecutive windows with one anchor form a segment.  Equal segments are one row from then on, and the
segments of one anchor are compared by the operator's own method.  Nothing is paired: every step is a sum per
anchor, per segment or per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import mapped, slices, sliding_argmin, text_column, utf8
from chronofold.llm.scratch import Scratch

#: An anchor in more texts than this is split further before its segments are gathered.
HOT_ANCHOR = 2000
#: Tasks that the segments of a key above that are dealt to.
_SHARES = 256
#: What a null id is ordered as: after all others.
LAST_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Segments:
    """Runs of windows with one anchor: text number, anchor key, first unit, number of windows and byte span."""

    owner: np.ndarray
    key: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    code: np.ndarray


def anchored(owner: np.ndarray, grams: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First unit, number of windows and anchor unit of every run of windows with one anchor.

    ``owner`` is the text of every unit, ``grams`` the hash of ``gram`` units from each unit on."""
    place = sliding_argmin(grams, window - gram + 1)
    at = np.flatnonzero(owner[: len(place)] == owner[window - 1 : window - 1 + len(place)])
    if not len(at):
        return at, at, at
    place = place[at]
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)])
    return at[new], np.diff(np.r_[new, len(at)]), place[new]


#: Cuts texts into segments; the second argument holds the anchors to keep (None: all), the third those to split further.
Segmenter = Callable[[np.ndarray, np.ndarray, "list[np.ndarray] | None", "list[np.ndarray] | None"], Segments]
#: Takes whole anchors of (key, segment bytes, smallest id) and gives, for each segment, its repeated units as (starts, ends).
Resolver = Callable[[np.ndarray, "list[bytes]", np.ndarray], "list[tuple[list[int], list[int]]]"]

#: Two hashes for each window of a segment; only with ``same_text``.
Singles = Callable[[bytes], "tuple[np.ndarray, np.ndarray]"]


def kept_segments(segments: Segments, wanted: list[np.ndarray]) -> np.ndarray:
    """Which segments have an anchor among those wanted of their text."""
    out = np.zeros(len(segments.key), bool)
    bounds = np.searchsorted(segments.owner, np.arange(len(wanted) + 1))
    for i, own in enumerate(wanted):
        if len(own):
            out[bounds[i] : bounds[i + 1]] = np.isin(segments.key[bounds[i] : bounds[i + 1]], own)
    return out


def of_anchors(segments: Segments, anchors: list[np.ndarray]) -> np.ndarray:
    """As :func:`kept_segments`, for segments that are in no order of their texts."""
    order = np.argsort(segments.owner, kind="stable")
    out = np.zeros(len(order), bool)
    out[order] = kept_segments(Segments(*[getattr(segments, f)[order] for f in Segments.__dataclass_fields__]), anchors)
    return out


def repeated_units(docs: DataFrame, cut: Segmenter, resolve: Resolver, same_text: bool, batch: int = 4000, singles: Singles | None = None) -> DataFrame:
    """``id``, ``digest``, ``copies``, ``first_id`` and the repeated units (``starts``, ``ends``) of every distinct (id, text).

    ``docs`` has ``id`` and ``text``.  Texts that are equal are searched once, as the one of the smallest id; ``starts`` and ``ends`` are those of
    that text.  ``same_text`` also counts repetitions inside a text.  ``resolve`` gets about ``batch`` segments at a time.  Keys that still have more
    than :data:`HOT_ANCHOR` different segments never meet in one task if there is ``singles``: their windows are counted one by one.
    """
    rows = docs.select("id", "text", F.unhex(F.md5("text")).alias("digest"))
    tables = Scratch(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                found = cut(*utf8(part.column("text")), None, None)
                order = np.lexsort((found.key, found.owner))
                owner, key = found.owner[order], found.key[order]
                same = np.zeros(len(key), bool)
                same[1:] = (owner[1:] == owner[:-1]) & (key[1:] == key[:-1])
                twice = np.flatnonzero(~same) + 1
                twice = np.concatenate((same, [False]))[twice] if len(key) else same
                owner, key = owner[~same], key[~same]
                at = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                # A key that recurs inside its text is told by the lowest bit, which no key uses.
                keys = pa.ListArray.from_arrays(pa.array(at), pa.array((key | twice.astype(np.uint64)).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("digest"), keys], names=["id", "digest", "keys"])

    anchors = tables.written(mapped(rows, scan, "id long, digest binary, keys array<long>"), "anchors")
    firsts = tables.written(anchors.groupBy("digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "firsts")
    one = anchors.select(F.xxhash64("digest").alias("text_key"), F.explode("keys").alias("k")).select(
        "text_key", F.col("k").bitwiseAND(F.lit(-2)).alias("key"), F.col("k").bitwiseAND(F.lit(1)).alias("twice")
    )
    recurring = one.groupBy("key").agg(
        F.min("text_key").alias("low"), F.max("text_key").alias("high"), F.max("twice").alias("twice"), F.count(F.lit(1)).alias("n")
    ).filter("low < high or twice = 1" if same_text else "low < high")
    hot = F.col("n") > HOT_ANCHOR
    # Any other anchor has at most HOT_ANCHOR segments, one in a text: its key cannot be crowded.
    loose = hot | (F.col("twice") == 1) if singles is not None else F.lit(False)
    recurring = tables.written(recurring.select("key", hot.alias("hot"), loose.alias("loose")), "recurring")
    hits = one.select("text_key", "key").join(recurring, "key").groupBy("text_key").agg(
        F.collect_set("key").alias("wanted"), *[F.collect_set(F.when(F.col(c), F.col("key"))).alias(c) for c in ("hot", "loose")]
    )
    hits = tables.written(hits.join(firsts.withColumn("text_key", F.xxhash64("digest")), "text_key").select(F.col("first_id").alias("id"), "digest", "text_key", "wanted", "hot", "loose"), "hits")
    tables.drop()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                data, offsets = utf8(part.column("text"))
                wanted, hot, loose = ([np.asarray(x, np.int64).view(np.uint64) for x in part.column(c).to_pylist()] for c in ("wanted", "hot", "loose"))
                found = cut(data, offsets, wanted, hot)
                apart = ~of_anchors(found, [np.setdiff1d(w, x) for w, x in zip(wanted, loose, strict=True)]) if singles is not None else np.zeros(len(found.key), bool)
                whole = data.tobytes()
                ids, texts = part.column("id").to_numpy(), part.column("text_key").to_numpy()
                for at in range(0, len(found.key), 1 << 14):
                    some = slice(at, at + (1 << 14))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(found.key[some].view(np.int64)), pa.array(found.code[some].view(np.int64)), pa.array(ids[found.owner[some]]), pa.array(texts[found.owner[some]]),
                            pa.array(found.first[some].astype(np.int32)), pa.array(found.windows[some].astype(np.int32)), pa.array(apart[some]),
                            pa.array([whole[s:e] for s, e in zip(found.begin[some].tolist(), found.end[some].tolist(), strict=True)], pa.binary()),
                        ],
                        names=["key", "code", "id", "text_key", "first", "windows", "loose", "piece"],
                    )

    segments = tables.written(mapped(rows.join(hits, ["id", "digest"]).select("id", "text_key", "text", "wanted", "hot", "loose"),
        emit, "key long, code long, id long, text_key long, first int, windows int, loose boolean, piece binary"), "segments")
    tables.drop("hits", "recurring")

    def once_each(rows_: DataFrame) -> DataFrame:
        return rows_.groupBy("key", "code").agg(F.min("id").alias("low_id"), F.count(F.lit(1)).alias("n"), F.max("piece").alias("piece"))

    distinct, split = once_each(segments), False
    if singles is not None:
        kinds = segments.filter("loose").select("key", "code").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
        crowded = tables.written(kinds.filter(F.col("kinds") > HOT_ANCHOR).select("key"), "crowded")
        split = crowded.limit(1).count() > 0
    if split:
        # The list grows with the corpus: it is merged at every size, and in shares, as all segments of a key are looked up.  Only loose
        # segments are, after their copies are summed: the bytes of the others do not travel for it.
        share = F.pmod("code", F.lit(_SHARES)).cast("int")
        shares = crowded.select("key", F.explode(F.sequence(F.lit(0), F.lit(_SHARES - 1))).alias("share"), F.lit(True).alias("crowded")).hint("merge")
        looked_up = once_each(segments.filter("loose")).withColumn("share", share).join(shares, ["key", "share"], "left").drop("share")
        looked_up = tables.written(looked_up, "looked_up")
        several = looked_up.filter("crowded").drop("crowded")
        distinct = once_each(segments.filter("not loose")).unionByName(looked_up.filter("crowded is null").drop("crowded"))
    distinct = distinct.repartition("key").sortWithinPartitions("key")

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "piece"):
                hashes = [singles(p) for p in part.column("piece").to_pylist()]
                sizes = [len(h[0]) for h in hashes]
                of = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c).take(of) for c in ("key", "code")], pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])),
                     *[pa.array(np.concatenate([h[k] for h in hashes]).view(np.int64)) for k in (0, 1)]],
                    names=["key", "code", "at", "h1", "h2"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solved(rows_: pa.Table) -> pa.RecordBatch:
            keys = rows_.column("key").to_numpy()
            got = resolve(keys, rows_.column("piece").to_pylist(), rows_.column("low_id").to_numpy())
            return pa.RecordBatch.from_arrays(
                [*[rows_.column(c).combine_chunks() for c in ("key", "code", "low_id", "n")],
                 pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.int32()))],
                names=["key", "code", "low_id", "n", "starts", "ends"],
            )

        for b in batches:
            for at in range(0, b.num_rows, batch):
                held.append(b.slice(at, batch))
                rows_ = pa.Table.from_batches(held)
                keys = rows_.column("key").to_numpy()
                cut_at = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last anchor may go on
                if cut_at >= batch:
                    yield solved(rows_.slice(0, cut_at))
                    held = rows_.slice(cut_at).to_batches()
        if held:
            rows_ = pa.Table.from_batches(held)
            if rows_.num_rows:
                yield solved(rows_)

    answers = mapped(distinct, compare, "key long, code long, low_id long, n long, starts array<int>, ends array<int>")
    if split:
        fields = "key long, code long, at int, h1 long, h2 long"
        units = tables.written(mapped(several.select("key", "code", "piece"), one_by_one, fields), "units")
        again = units.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
        starts = F.sort_array(F.collect_list("at"))
        shared = units.join(again.hint("merge"), ["h1", "h2"]).groupBy("key", "code").agg(starts.alias("starts"))
        alone = several.drop("piece").join(shared, ["key", "code"], "left")
        starts = F.coalesce("starts", F.array().cast("array<int>"))
        answers = answers.union(alone.select("key", "code", "low_id", "n", starts.alias("starts"), F.transform(starts, lambda x: x + F.lit(cut.window)).alias("ends")))
    answers = tables.written(answers, "answers")
    span = cut.window - 1
    found = segments.select("key", "code", "id", "text_key", "first", "windows").join(answers, ["key", "code"])
    # Another occurrence of the whole segment repeats all of its units.
    whole = F.col("n") > 1 if same_text else F.col("low_id") < F.col("id")
    all_units = F.array(F.struct(F.col("first").alias("s"), (F.col("first") + F.col("windows") + span).alias("e")))
    own = F.transform(F.arrays_zip("starts", "ends"), lambda x: F.struct((F.col("first") + x["starts"]).alias("s"), (F.col("first") + x["ends"]).alias("e")))
    # An id may have several texts: runs are those of one of them.
    runs = found.select("id", "text_key", F.when(whole, all_units).otherwise(own).alias("runs")).filter(F.size("runs") > 0)
    per_text = runs.groupBy("id", "text_key").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    info = anchors.select("id", "digest").distinct().join(firsts, "digest").withColumn("text_key", F.xxhash64("digest")).join(
        per_text.withColumnRenamed("id", "first_id"), ["first_id", "text_key"], "left"
    )
    info = tables.written(info.select("id", "digest", "copies", "first_id", "runs"), "passages")
    tables.drop("anchors", "firsts", "segments", "answers", *(["crowded"] if singles is not None else []), *(["looked_up", "units"] if split else []))
    return info


def merged_runs(runs: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint runs in ascending order; runs that touch become one."""
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, e = np.array([r["s"] for r in runs]), np.array([r["e"] for r in runs])
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.flatnonzero(np.r_[True, s[1:] > e[:-1]])
    return s[new], e[np.r_[new[1:] - 1, len(e) - 1]]


def identified(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``id`` (a null id as the last) and ``text`` (null as empty)."""
    return docs.select(F.coalesce(docs[id_column].cast("long"), F.lit(LAST_ID)).alias("id"), text_column(docs, text).alias("text"))
