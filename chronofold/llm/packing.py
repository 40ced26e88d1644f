"""Best-fit packing of token pieces into sequences, improved by a swap-based local search.

Pieces are dealt at random into shards of about equal size, so that every shard has the same mix; each is packed on its own, and the last
few bins of each, which can stay underfull, are packed together once more.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.bpe import Encoder
from chronofold.llm.common import mapped, slices, text_column
from chronofold.llm.scratch import Scratch

SEQUENCE_TOKENS = 4096
END_ID = 1
#: Pieces packed together; a shard wastes about one sequence in several thousand.
SHARD_PIECES = 16384
#: A sequence with more room than one part in so many takes part in the last round over all shards.
OPEN_PART = 64


class LibraryEncoder(Encoder):
    """The table of runs with the library's own merging."""

    def word_ids(self, pieces: list[bytes]) -> list[list[int]]:
        tokenize, letters = self.library.model.tokenize, {b: c for c, b in self.byte_of.items()}
        return [[t.id for t in tokenize(p.decode("latin-1").translate(letters))] for p in pieces]


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items, largest first, each into the fullest bin that still takes it.

    Open bins lie in a list per free space; the bits of one number tell which lists are not empty."""
    bins: list[list[int]] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0
    for i in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        fits = some >> sizes[i]
        if fits:
            space = sizes[i] + (fits & -fits).bit_length() - 1
            b = open_bins[space].pop()
            if not open_bins[space]:
                some &= ~(1 << space)
        else:
            space, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        left = space - sizes[i]
        open_bins[left].append(b)
        some |= 1 << left
    return bins


def emptied(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Exchanges documents between underfull bins until no bin can be emptied any more.

    The emptiest bin gives one or two of its documents to a fuller bin, for nothing or for one smaller document, whenever that bin
    has the room; each step makes the sum of squared fills larger, so the search ends.  It stops early at as few bins as the total needs.
    """
    bins = [list(b) for b in bins]
    fill = [sum(sizes[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    gone: set[int] = set()
    moved = True
    while moved and len(bins) - len(gone) > least:
        moved = False
        live = [b for b in range(len(bins)) if b not in gone and fill[b] < capacity]
        for e in sorted(live, key=lambda b: fill[b]):
            before = fill[e]
            if _give_away(e, [b for b in live if b != e and b not in gone and fill[b] < capacity], bins, fill, sizes, capacity):
                gone.add(e)
            if fill[e] != before:
                moved = True
            if len(bins) - len(gone) <= least:
                break
    return [b for k, b in enumerate(bins) if k not in gone]


def _offers(own: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every total that one or two of the sizes have, these sizes; 0 for no size.  A bin has few different sizes, as their sum is at most its capacity."""
    values, count = np.unique(own, return_counts=True)
    first, second = np.zeros(2 * capacity + 1, np.int64), np.zeros(2 * capacity + 1, np.int64)
    for k, value in enumerate(values):
        others = values[k if count[k] > 1 else k + 1 :]
        first[value + others], second[value + others] = value, others
    first[values], second[values] = values, 0
    return first, second


def _give_away(e: int, others: list[int], bins: list[list[int]], fill: list[int], sizes: list[int], capacity: int) -> bool:
    """Empties bin ``e`` into others as far as each step helps; whether nothing is left in it."""
    others = [b for b in others if fill[b] >= fill[e]]
    if not others:
        return not bins[e]
    # Every document of the other bins, and no document (-1) for a plain move.
    items = np.array([i for b in others for i in (-1, *bins[b])])
    where = np.array([b for b in others for _ in range(len(bins[b]) + 1)])
    size = np.array([0 if i < 0 else sizes[i] for i in items])
    level = np.array(fill)
    while bins[e]:
        first, second = _offers([sizes[i] for i in bins[e]], capacity)
        sums = np.flatnonzero(first)
        room = capacity - level[where]
        best = np.searchsorted(sums, size + room, "right") - 1
        gain = np.where(best >= 0, sums[best] - size, 0)
        worth = np.where(gain > 0, gain * (level[where] - level[e] + gain), 0)
        k = int(worth.argmax())
        if worth[k] <= 0:
            return False
        b, given = int(where[k]), []
        for wanted in (int(first[sums[best[k]]]), int(second[sums[best[k]]])):
            if wanted:
                given.append(next(i for i in bins[e] if sizes[i] == wanted and i not in given))
        bins[e] = [i for i in bins[e] if i not in given]
        if items[k] >= 0:
            bins[b].remove(int(items[k]))
            bins[e].append(int(items[k]))
        bins[b] += given
        fill[b] += int(gain[k])
        fill[e] -= int(gain[k])
        level[b], level[e] = fill[b], fill[e]
        keep = np.ones(len(items), bool)
        keep[k] = items[k] < 0
        items, where = np.r_[items[keep], given], np.r_[where[keep], [b] * len(given)]
        size = np.r_[size[keep], [sizes[i] for i in given]]
    return True


def pieces(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``: every text's ids and the end id, cut after each ``capacity`` of them."""
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        for batch in batches:
            for part in slices(batch):
                of, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encoder.encoded(part.column("text"))):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        of.append(i)
                        piece.append(n)
                        start.append(at // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), text_column(docs, text).alias("text"))
    return mapped(rows, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def packed(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset``: where it lies among sequences of at most ``capacity`` tokens.

    A null or empty text is the end id alone; only texts longer than a sequence are cut; repeated rows are packed each; a null id stays null; among equal
    choices the first bin is taken; an empty table gives no row.  The texts are read once, after that only piece lengths move.
    """
    tables = Scratch(docs.sparkSession)
    stored = tables.written(pieces(docs, path, id_column, text, capacity), "pieces")
    shards = max(1, -(-stored.count() // SHARD_PIECES))
    dealt = stored.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)))
    first = _packed_shards(dealt, capacity)
    if shards == 1:
        return first.drop("fill")
    # The few sequences of each shard that stayed open are packed anew, those of all shards together.
    first = tables.written(first, "packed")
    tables.drop("pieces")
    is_open = F.col("fill") < capacity - capacity // OPEN_PART
    rest = first.filter(is_open).drop("sequence_id", "offset", "fill")
    again = max(1, -(-rest.count() // SHARD_PIECES))
    rest = rest.withColumn("shard", shards + F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(again)))
    return first.filter(~is_open).union(_packed_shards(rest, capacity)).drop("fill")


def _packed_shards(dealt: DataFrame, capacity: int) -> DataFrame:
    """Each ``shard`` of pieces in sequences of its own, with how full each piece's sequence is."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows["length"].tolist()
        lengths = rows["length"].to_numpy()
        sequence, offset, fill = (np.zeros(len(rows), np.int64) for _ in range(3))
        for b, members in enumerate(emptied(best_fit(sizes, capacity), sizes, capacity)):
            sequence[members] = (int(rows["shard"].iloc[0]) << 32) + b
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
            fill[members] = lengths[members].sum()
        out = rows.drop(columns="shard")
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out.assign(sequence_id=sequence, offset=offset, fill=fill)

    return dealt.groupBy("shard").applyInPandas(pack, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long")
