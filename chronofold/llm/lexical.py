"""Ranked lexical search by NRA: no random access, only sequential reads of impact-sorted lists.

The index is a table of one row per document with its query terms.  A task puts some thousand documents at a time, a shard, into lists sorted by impact, reads
an item's lists from the front, keeps a lower and an upper score of every document met, and reads on until the best ones, their order and
their scores are settled.  The shards' best are ranked together: a term's list is never in one place, however frequent the term is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.common import mapped, slices, span_hashes, text_column, utf8, words
from chronofold.llm.scratch import Scratch

TOP = 10
#: Part of the document length in a score, in hundredths.
LENGTH_SHARE = 75
#: Documents of a shard: what a task holds of the index is at most these times the terms of a query block.
SHARD_DOCUMENTS = 16384
#: Terms of items that are searched together.  More items than that are searched block by block over the same index.
BLOCK_TERMS = 200_000
#: Entries that the first read takes from every list; each further read takes twice as many.
FIRST_READ = 64

#: Bytes of terms: ASCII letters and digits and everything beyond ASCII.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts; start, end, text number and hash of every term."""
    data, offsets = utf8(column)
    data = _LOWER[data]
    starts, ends, owner = words(data, offsets, _INSIDE)
    return data, starts, ends, owner, span_hashes(data, starts, ends)


def _same_bytes(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each piece of ``sizes`` bytes whether ``a`` and ``b`` agree in it."""
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    differ = a[np.repeat(a_starts, sizes) + at] != b[np.repeat(b_starts, sizes) + at]
    total = np.r_[0, np.cumsum(differ)]
    ends = np.cumsum(sizes)
    return total[ends] == total[ends - sizes]


class Vocabulary:
    """Numbers of a bounded list of distinct terms, found by hash and then compared byte by byte."""

    def __init__(self, terms: list[str]):
        column = pa.array(terms, pa.string())
        self.data, offsets = utf8(column)
        hashes = span_hashes(self.data, offsets[:-1], offsets[1:])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.number = hashes[order], order
        self.starts, self.sizes = offsets[:-1][order], np.diff(offsets)[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two query terms have one hash")

    def found(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pieces are terms of the list, and their numbers."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        hit = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[at] == ends - starts)) if len(self.hashes) else np.zeros(0, np.int64)
        place = at[hit]
        hit_is = _same_bytes(data, starts[hit], self.data, self.starts[place], self.sizes[place])
        return hit[hit_is], self.number[place[hit_is]]


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id``, ``term``, ``times``: the terms of every item with their repeats.

    Equal rows are one item; different texts of one id, also of the null id, are one item with the terms of all."""
    lowered = F.translate(text_column(items, text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    rows = items.select(items[item_id].cast("long").alias("item_id"), lowered.alias("text"), found.alias("terms"))
    return rows.distinct().select("item_id", F.explode("terms").alias("term")).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def counted(docs: DataFrame, terms: list[str], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n`` terms, and the numbers and counts of those of ``terms`` that the text holds; one row for each row."""
    known = Vocabulary(terms)
    size = max(1, len(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, starts, ends, owner, hashes = _terms(part.column("text"))
                hit, number = known.found(data, starts, ends, hashes)
                cells, times = np.unique(owner[hit] * size + number, return_counts=True)
                of = cells // size
                at = np.searchsorted(of, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(v, t)) for v, t in ((cells % size, pa.int32()), (times, pa.int64()))]
                sizes = np.bincount(owner, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "times"])

    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), text_column(docs, text).alias("text"))
    return mapped(rows, run, "doc_id long, n long, terms array<int>, times array<long>")


def settled(lists: list[tuple[np.ndarray, np.ndarray]], size: int, top: int = TOP) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``top`` best documents of the impact-sorted lists with their scores, and how many entries were read.

    ``lists`` are (document, impact) by falling impact, each document once; documents are numbered in tie order below ``size``.  After every read a
    document's lower score is what its entries sum to; its upper score adds, for each list it was not met in, that list's last impact.  Reading goes on
    in all lists until no other document can reach the worst of the best, and then, for the best alone, until their scores cannot grow.
    """
    lower, met = np.zeros(size, np.int64), np.zeros(size, bool)
    at, read, entries = 0, FIRST_READ, 0
    while True:
        for docs, gain in lists:
            some = docs[at : at + read]
            lower[some] += gain[at : at + read]
            met[some] = True
            entries += len(some)
        at, read = at + read, read * 2
        last = [int(gain[at - 1]) if at < len(gain) else 0 for _, gain in lists]
        some = np.flatnonzero(met)
        best = _best(lower, some, top)
        if not any(last):
            return best, lower[best], entries
        floor = int(lower[best[-1]]) if len(best) == top else 0
        if floor <= sum(last):  # a document not met yet may be as good
            continue
        upper = lower[some] + sum(last)
        place = np.zeros(size, np.int64)
        place[some] = np.arange(len(some))
        for (docs, _), value in zip(lists, last, strict=True):
            if value:
                upper[place[docs[:at]]] -= value
        inside = np.zeros(size, bool)
        inside[best] = True
        if int(upper[~inside[some]].max(initial=0)) >= floor:
            continue
        for docs, gain in lists:
            if np.count_nonzero(inside[docs[:at]]) == len(best):  # this list has told all of the best
                continue
            mine = inside[docs[at:]]
            lower[docs[at:][mine]] += gain[at:][mine]
            entries += len(mine)
        best = _best(lower, best, top)
        return best, lower[best], entries


def _best(lower: np.ndarray, some: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` of some documents by falling score, equal ones by number."""
    if len(some) > top:
        least = np.partition(lower[some], len(some) - top)[len(some) - top]
        some = some[lower[some] >= least]
    return some[np.lexsort((some, -lower[some]))][:top]


@dataclass(frozen=True)
class Scoring:
    """Figures of the whole table that a score is made of: documents with a term, their terms, a weight for each term."""

    documents: int
    total: int
    weights: np.ndarray

    @classmethod
    def of(cls, documents: int, total: int, holders: np.ndarray) -> Scoring:
        return cls(documents, total, np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * h + 1))) for h in holders.tolist()], np.int64))

    def impacts(self, terms: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What entries (term, occurrences, terms of the document) add to a score."""
        share = LENGTH_SHARE * self.documents
        if len(sizes) and int(sizes.max()) * share >= 1 << 63:
            long = np.array([int(n) * share // self.total for n in sizes], np.int64)
        else:
            long = sizes * share // max(self.total, 1)
        return self.weights[terms] * (1_000_000_000 * times // (1000 * times + 8 * (100 - LENGTH_SHARE + long)))


def searched(index: DataFrame, items: dict[int | None, tuple[np.ndarray, np.ndarray]], scoring: Scoring, top: int = TOP, shard: int = SHARD_DOCUMENTS) -> DataFrame:
    """``item_id``, ``doc_id``, ``score``: the best documents of every shard for every item, given as (term numbers, repeats)."""

    def solved(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        order = np.argsort(pc.fill_null(ids, (1 << 63) - 1).to_numpy(), kind="stable")  # ties by id, null ids last
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lists, times = table.column("terms").combine_chunks(), table.column("times").combine_chunks()
        counts = pc.list_value_length(lists).to_numpy()
        terms, of = lists.flatten().to_numpy(), np.repeat(np.arange(len(order)), counts)
        gain = scoring.impacts(terms, times.flatten().to_numpy(), np.repeat(table.column("n").to_numpy(), counts))
        by_impact = np.lexsort((place[of], -gain, terms))
        terms, of, gain = terms[by_impact], place[of][by_impact], gain[by_impact]
        out_item, out_doc, out_score = [], [], []
        for item, (wanted, repeats) in items.items():
            spans = zip(np.searchsorted(terms, wanted), np.searchsorted(terms, wanted, "right"), repeats.tolist(), strict=True)
            best, score, _ = settled([(of[a:b], gain[a:b] * r) for a, b, r in spans if a < b], len(order), top)
            some = score > 0
            out_item += [item] * int(some.sum())
            out_doc.append(order[best[some]])
            out_score.append(score[some])
        docs = np.concatenate(out_doc) if out_doc else np.zeros(0, np.int64)
        scores = np.concatenate(out_score) if out_score else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(out_item, pa.int64()), ids.take(pa.array(docs)), pa.array(scores, pa.int64())], names=["item_id", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= shard:
                yield solved(held)
                held, size = [], 0
        if size:
            yield solved(held)

    return mapped(index.filter(F.size("terms") > 0), run, "item_id long, doc_id long, score long")


def ranked(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: every item's best documents with a score above 0, equal scores by ascending id.

    Every row of ``docs`` is a document of its own, repeated ids and rows too; a null id comes last among equal scores; a null text has no
    term.  Equal items count once; different texts of one item id are one item.  An item without terms, or without a document that has one, gives no
    row; so does an empty table on either side.  Other columns are ignored.  Items are searched in blocks of about ``block_terms`` terms (an item's
    terms stay together), each block against all documents; a block's terms and items are all that is sent to the tasks.
    """
    spark = docs.sparkSession
    tables = Scratch(spark)
    asked = tables.written(item_terms(items, item_id, item_text), "items")
    blocks = max(1, -(-asked.count() // block_terms))
    found = []
    for k in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).toArrow().to_pandas(types_mapper=None, integer_object_nulls=True)
        terms = sorted(set(rows["term"]))
        number = {t: i for i, t in enumerate(terms)}
        wanted: dict[int | None, tuple[list[int], list[int]]] = {}
        for item, term, times in zip(rows["item_id"].tolist(), rows["term"], rows["times"].tolist(), strict=True):
            own = wanted.setdefault(item, ([], []))
            own[0].append(number[term])
            own[1].append(times)
        index = tables.written(counted(docs, terms, id_column, text), f"index-{k}")
        size = index.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        holders = np.zeros(len(terms), np.int64)
        for term, n in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # no more rows than terms
            holders[term] = n
        scoring = Scoring.of(size[0], size[1], holders)
        best = searched(index, {i: (np.array(t), np.array(r, np.int64)) for i, (t, r) in wanted.items()}, scoring, top)
        found.append(tables.written(best, f"best-{k}"))
        tables.drop(f"index-{k}")
    every = found[0]
    for other in found[1:]:
        every = every.union(other)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
