"""Jaccard join in metric space: pivots, Voronoi regions, windows from the triangle inequality, regions of regions.

The distance of two shingle sets is 1 - J, a metric.  Documents that link share one of their rarest shingles, so the first region of a document
are the pivots (the first holders) of its rare shingles; every two documents that link have a pivot in common.  Where all its neighbours in a region are
too far off, as counts of their shingles by class tell, a document leaves the region.  A region of many documents is
divided by some of its own members: each document belongs to the nearest of them and, as linked documents are at most ``1 - similarity`` apart,
also to every other that is no more than twice this distance farther.  Small regions are joined pair by pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.common import arrow, mapped, once_per_task, slices, text_column, utf8
from chronofold.llm.graph import components, widened
from chronofold.llm.scratch import Scratch
from chronofold.llm.sets import linked, shingles


@dataclass(frozen=True)
class Shingling:
    """How many words a shingle has, whether A-Z count as a-z, and from which share of common shingles on (in hundredths) documents link."""

    words: int = 4
    fold_case: bool = True
    percent: int = 85


DEFAULT = Shingling()
#: A region of at most so many documents and shingles is joined pair by pair in one task.
LEAF, LEAF_SHINGLES = 256, 1 << 22
#: Members of a large region that divide it.
PIVOTS = 8
#: Shingles of a region that one task compares with its pivots.
SHARE_SHINGLES = 1 << 20
#: A division that leaves more than this share of a region together is the last: its pairs are dealt in blocks.
SHRUNK = 0.8
#: Documents of a block; every two blocks of a region that cannot be divided meet in a task.
BLOCK = 128
#: Classes in which a document's shingles are counted, up to 255 each.
CLASSES = 128
#: Regions of at most so many documents are searched for documents without a neighbour.
SKETCHED = 4096
#: Of every so many texts (by hash) one takes part in finding frequent shingles; so many of them are kept.
SAMPLED, FREQUENT_LEAST, FREQUENT_KEPT = 32, 4, 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _sets(column: pa.Array, kind: Shingling) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, by text and hash, and where each text's start (one offset more)."""
    data, offsets = utf8(column)
    keys, _, owner = shingles(_LOWER[data] if kind.fold_case else data, offsets, kind.words)
    return keys, np.searchsorted(owner, np.arange(len(column) + 1))


def frequent(rows: DataFrame, kind: Shingling = DEFAULT) -> np.ndarray:
    """Shingles that a sample of the texts holds often, the most frequent last.

    They only order shingles; which documents link does not depend on them.  At most :data:`FREQUENT_KEPT` reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys, count = np.unique(_sets(part.column("text"), kind)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(count)], names=["s", "c"])

    some = rows.filter(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(SAMPLED)) == 0).select("text")
    counts = mapped(some, run, "s long, c long").groupBy("s").agg(F.sum("c").alias("c")).filter(F.col("c") >= FREQUENT_LEAST)
    top = counts.orderBy(F.desc("c"), "s").limit(FREQUENT_KEPT).select("s").collect()
    return np.array([r["s"] for r in reversed(top)], np.int64).view(np.uint64)


def prefixes(keys: np.ndarray, bounds: np.ndarray, last: np.ndarray, percent: int = DEFAULT.percent) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rarest shingles of every set in one order for all sets: with ``last`` at its end, by hash before.

    Two sets link only if their common shingles are ``percent`` of the larger set, and ``2 p / (100 + p)`` of the smaller one.  So the first of
    them stands among the first n - need + 1 of both sets.  Returns where each set's part ends, the shingles, and which of them are in the shorter part
    that serves towards a set of the same size or a larger one.
    """
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    by_hash = np.argsort(last)
    rank = np.zeros(len(keys), np.int64)
    if len(last):
        at = np.minimum(np.searchsorted(last[by_hash], keys), len(last) - 1)
        rank = np.where(last[by_hash][at] == keys, 1 + by_hash[at], 0)
    order = np.lexsort((keys, rank, owner))
    place = np.arange(len(keys)) - np.repeat(bounds[:-1], sizes)
    longer = sizes - (percent * sizes + 99) // 100 + 1
    shorter = sizes - (2 * percent * sizes + 99 + percent) // (100 + percent) + 1
    kept = place < longer[owner]
    ends = np.r_[0, np.cumsum(np.where(sizes, longer, 0))]
    return ends, keys[order][kept], (place < shorter[owner])[kept]


def sketches(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many shingles of each set are of each class, at most 255.  Two rows never differ by more than the sets do."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    counts = np.bincount(owner * CLASSES + (keys % np.uint64(CLASSES)).astype(np.int64), minlength=n * CLASSES)
    return np.minimum(counts, 255).astype(np.uint8).reshape(n, CLASSES)


def neighbours(counts: np.ndarray, sizes: np.ndarray, percent: int = DEFAULT.percent) -> np.ndarray:
    """Which sets may link with another one, by their sizes and counts alone: none that links is left out.

    Sets of sizes a and b that link differ by at most (100 - p) / (100 + p) (a + b) shingles."""
    out = np.zeros(len(sizes), bool)
    wide = counts.astype(np.int16)
    for i in range(len(sizes)):
        rest = np.flatnonzero((100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])) & ~(out & out[i]))
        apart = np.abs(wide[rest] - wide[i]).sum(1, dtype=np.int64)
        met = rest[(apart * (100 + percent) <= (100 - percent) * (sizes[rest] + sizes[i])) & (rest != i)]
        out[met] = True
        out[i] |= len(met) > 0
    return out


def _measured(rows: DataFrame, last: np.ndarray, kind: Shingling) -> DataFrame:
    """Every row with, in place of ``text``, ``n`` shingles, the set's digest ``node`` (null if empty), its rare shingles, ``near`` the first of them,
    and its ``counts`` by class."""
    names = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys, bounds = _sets(part.column("text"), kind)
                ends, rare, short = prefixes(keys, bounds, last, kind.percent)
                near = np.add.reduceat(np.r_[short, False], ends[:-1]) if part.num_rows else np.zeros(0)
                near = np.where(np.diff(ends) > 0, near, 0)
                nodes = [hashlib.sha256(keys[a:b].tobytes()).digest()[:16] if a < b else None for a, b in zip(bounds, bounds[1:], strict=False)]
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(rare.view(np.int64)))
                counts = pa.array([row.tobytes() for row in sketches(keys, bounds)], pa.binary())
                found = [pa.array(np.diff(bounds), pa.int64()), pa.array(nodes, pa.binary()), lists, pa.array(near, pa.int32()), counts]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *found], names=[*names, "n", "node", "rare", "near", "counts"])

    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return mapped(rows, run, f"{own}, n long, node binary, rare array<long>, near int, counts binary")


def _bodies(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``nid`` and one text of each of the wanted nodes (``text_key``, ``nid``)."""
    texts = once_per_task(rows.select("text_key", "text"), "text_key")
    return texts.join(wanted.hint("merge"), "text_key").dropDuplicates(["nid"]).select("nid", "text")


def regions(nodes: DataFrame, percent: int = DEFAULT.percent) -> DataFrame:
    """``region``, ``nid``: the pivots that every node shares a rare shingle with, itself a pivot of its own region.

    A shingle's pivot is its first holder.  A shingle that is in nobody's shorter part links nobody; nor does it link a node that is smaller than all
    sets that have it in their shorter part, or larger than they allow, unless the node has it in its own."""
    place = F.posexplode("rare").alias("place", "s")
    entries = nodes.select("nid", "n", "near", place).select("s", "nid", "n", (F.col("place") < F.col("near")).alias("short"))
    size = F.when(F.col("short"), F.col("n"))
    blocks = entries.groupBy("s").agg(F.min("nid").alias("region"), F.count(F.lit(1)).alias("holders"), F.min(size).alias("low"), F.max(size).alias("high"))
    met = entries.join(blocks.filter("holders > 1 and low is not null").hint("merge"), "s")
    met = met.filter((F.col("short")) | ((F.col("low") <= F.col("n")) & (F.col("high") * 100 >= F.col("n") * percent)))
    return met.filter("region != nid").select("region", F.explode(F.array("region", "nid")).alias("nid")).distinct()


def _with_neighbours(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``region``, ``nid``, ``n`` without the members that no other member of the region can link with."""

    def kept(region: int, ids: list[int], sizes: list[int], counts: list[bytes]) -> pa.RecordBatch:
        table = np.frombuffer(b"".join(counts), np.uint8).reshape(len(ids), -1)
        some = neighbours(table, np.array(sizes), percent) if len(ids) <= SKETCHED else np.ones(len(ids), bool)
        at = np.flatnonzero(some)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), region), pa.int64()), pa.array(np.array(ids)[at], pa.int64()), pa.array(np.array(sizes)[at], pa.int64())], names=["region", "nid", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, whole = None, ([], [], []), False
        for batch in batches:
            for region, *row in zip(*(batch.column(c).to_pylist() for c in ("region", "nid", "n", "counts")), strict=True):
                if region != now:
                    if held[0]:
                        yield kept(now, *held)
                    now, held, whole = region, ([], [], []), False
                for values, value in zip(held, row, strict=True):
                    values.append(value)
                if len(held[0]) > (0 if whole else SKETCHED):  # a region this large passes as it is, a row at a time from here on
                    yield pa.RecordBatch.from_arrays([pa.array([now] * len(held[0]), pa.int64()), pa.array(held[0], pa.int64()), pa.array(held[1], pa.int64())], names=["region", "nid", "n"])
                    held, whole = ([], [], []), True
        if held[0]:
            yield kept(now, *held)

    rows = members.join(nodes.select("nid", "n", "counts").hint("merge"), "nid").select("region", "nid", "n", "counts")
    return mapped(rows.repartition("region").sortWithinPartitions("region"), run, "region long, nid long, n long")


def _with_sets(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], kind: Shingling) -> Iterator[tuple[tuple, np.ndarray]]:
    """The named values of every row and its shingle set."""
    for batch in batches:
        for part in slices(batch):
            keys, bounds = _sets(part.column("text"), kind)
            for i, row in enumerate(zip(*(part.column(c).to_pylist() for c in names), strict=True)):
                yield row, keys[bounds[i] : bounds[i + 1]]


def _leaves(members: DataFrame, bodies: DataFrame, keys: tuple[str, ...], kind: Shingling) -> DataFrame:
    """Links inside each group of ``keys``: all its pairs are compared in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets = None, [], []

        def solved() -> pa.RecordBatch:
            label, nodes = linked(sets, kind.percent / 100), np.array(ids)
            found = np.flatnonzero(label != np.arange(len(label)))
            return pa.RecordBatch.from_arrays([pa.array(nodes[found], pa.int64()), pa.array(nodes[label[found]], pa.int64())], names=["a", "b"])

        for (nid, *at), own in _with_sets(batches, ("nid", *keys), kind):
            if at != now:
                if ids:
                    yield solved()
                now, ids, sets = at, [], []
            ids.append(nid)
            sets.append(own)
        if ids:
            yield solved()

    rows = members.join(bodies.hint("merge"), "nid").select(*keys, "nid", "text")
    return mapped(rows.repartition(*keys).sortWithinPartitions(*keys), run, "a long, b long")


class Pivots:
    """The shingle sets of some pivots; distances of many sets to all of them."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        self.all = np.unique(np.concatenate(sets))
        self.holds = np.zeros((len(sets), len(self.all)), bool)
        for row, s in zip(self.holds, sets, strict=True):
            row[np.searchsorted(self.all, s)] = True

    def common(self, own: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.all, own), len(self.all) - 1)
        return self.holds[:, at[self.all[at] == own]].sum(1)


def window(common: np.ndarray, sizes: np.ndarray, n: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """To which pivots a set of size ``n`` links, and in whose regions it stands: its nearest pivot's, and those that are at most twice the distance of a link farther."""
    union = sizes + n - common
    distance = 1 - common / union
    return 100 * common >= percent * union, distance <= distance.min() + 2 * (1 - percent / 100) + 1e-9


def _divided(members: DataFrame, chosen: DataFrame, bodies: DataFrame, kind: Shingling, share: int) -> DataFrame:
    """Every member (``region``, ``nid``, ``n``) with the pivots (``to``) that it links to and the pivots (``at``) in whose regions it stands.

    A region's members are dealt in shares, its pivots (``chosen``) go to each."""
    shares = members.groupBy("region").agg(F.ceil(F.sum("n") / share).cast("int").alias("shares"))
    dealt = members.join(shares, "region").select("region", F.pmod(F.xxhash64("nid"), F.col("shares")).cast("int").alias("share"), "nid", F.lit(1).alias("role"))
    copies = chosen.join(shares, "region").select("region", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "nid", F.lit(0).alias("role"))
    rows = dealt.union(copies).join(bodies.hint("merge"), "nid").select("region", "share", "role", "nid", "text")
    rows = rows.repartition("region", "share").sortWithinPartitions("region", "share", "role", "nid")
    types = {"region": pa.int64(), "nid": pa.int64(), "n": pa.int64(), "to": pa.list_(pa.int64()), "at": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heads, ids, space, out = None, [], [], None, []
        for (region, part, role, nid), own in _with_sets(batches, ("region", "share", "role", "nid"), kind):
            if (region, part) != now:
                now, heads, ids, space = (region, part), [], [], None
            if role == 0:
                heads.append(own)
                ids.append(nid)
                continue
            space = space or Pivots(heads)
            to, near = window(space.common(own), space.sizes, len(own), kind.percent)
            out.append((region, nid, len(own), [ids[i] for i in np.flatnonzero(to)], [ids[i] for i in np.flatnonzero(near)]))
            if len(out) == 1000:
                yield arrow(dict(zip(types, zip(*out, strict=True), strict=True)), types)
                out = []
        if out:
            yield arrow(dict(zip(types, zip(*out, strict=True), strict=True)), types)

    return mapped(rows, run, "region long, nid long, n long, to array<long>, at array<long>")


def _connected(divided: DataFrame) -> DataFrame:
    """Links that connect all that :func:`_divided` found: a member and its first pivot, and this one and the member's other pivots, each pair once."""
    first = F.get("to", F.lit(0))
    members = divided.select(F.col("nid").alias("a"), first.alias("b"))
    pivots = divided.filter(F.size("to") > 1).select(first.alias("a"), F.explode(F.slice("to", 2, F.size("to"))).alias("b")).distinct()
    return members.union(pivots).filter("a != b")


def _some(members: DataFrame, level: int, pivots: int) -> DataFrame:
    """Pivots of every region: the members with the smallest hashes."""
    order = Window.partitionBy("region").orderBy(F.xxhash64("nid", F.lit(level)), "nid")
    return members.select("region", "nid").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= pivots).select("region", "nid")


def _open(members: DataFrame, known: DataFrame, classes: bool = False) -> DataFrame:
    """Members of the regions whose documents are not connected yet (classes of nodes are ``known``), with their ``class`` if asked."""
    named = members.join(known.withColumnRenamed("node", "nid"), "nid", "left").withColumn("class", F.coalesce("class", "nid"))
    apart = named.groupBy("region").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("region")
    return (named if classes else members).join(apart.hint("merge"), "region")


def _blocks(members: DataFrame) -> DataFrame:
    """``region``, ``tile``, ``nid`` of regions that cannot be divided: every two blocks of different classes meet in a tile.

    A block holds documents of one class or of several small ones; members of one class need not meet."""
    kinds = members.groupBy("region", "class").agg(F.count(F.lit(1)).alias("c")).withColumn("big", F.col("c") >= BLOCK)
    small = kinds.groupBy("region").agg(F.sum(F.when(~F.col("big"), F.col("c")).otherwise(0)).alias("rest"))
    of = F.when(F.col("big"), F.col("class")).otherwise(0)
    parts = F.greatest(F.lit(1), F.ceil(F.when(F.col("big"), F.col("c")).otherwise(F.col("rest")) / BLOCK))
    part = F.pmod(F.xxhash64(F.when(F.col("big"), F.col("nid")).otherwise(F.col("class"))), parts)
    dealt = members.join(kinds, ["region", "class"]).join(small, "region").select("region", "nid", F.struct("big", of.alias("of"), part.alias("part")).alias("block"))
    blocks = dealt.select("region", "block").distinct()
    tiles = blocks.withColumnRenamed("block", "p").join(blocks.withColumnRenamed("block", "q").hint("merge"), "region")
    tiles = tiles.filter("p <= q and not (p.big and q.big and p.of = q.of)")
    tiles = tiles.select("region", F.xxhash64("p", "q").alias("tile"), F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    return dealt.join(tiles.hint("merge"), ["region", "block"]).select("region", "tile", "nid")


def classes(
    members: DataFrame, bodies: DataFrame, tables: Scratch, kind: Shingling = DEFAULT, leaf: int = LEAF, pivots: int = PIVOTS, share: int = SHARE_SHINGLES,
    known: DataFrame | None = None,
) -> DataFrame:
    """``node`` and ``class`` of what links within the regions (``region``, ``nid``, ``n``): two nodes that link are in one class.

    First every document is compared with the pivot of one of its regions, unless classes are ``known``.  Regions whose documents are one class are done with.
    Regions above ``leaf`` are divided level by level; one that did not shrink is compared block by block.
    """
    if known is None:
        nearest = members.groupBy("nid").agg(F.min("region").alias("region"), F.first("n").alias("n"))
        heads = members.groupBy("region").agg(F.min("nid").alias("nid"))
        known = components(tables.written(_connected(_divided(nearest, heads, bodies, kind, share)), "stars"))
    now, level = tables.written(_open(members, known), "region-0"), 0
    while True:
        level += 1
        sizes = now.groupBy("region").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("weight"))
        small = (F.col("c") <= leaf) & (F.col("weight") <= LEAF_SHINGLES) | (F.col("c") == 1)
        judged = tables.written(sizes.select("region", "c", small.alias("small")), f"sizes-{level}")
        some = judged.agg(F.max("small"), F.min("small")).first()
        if some[0]:
            found = tables.written(_leaves(now.join(judged.filter("small"), "region"), bodies, ("region",), kind), f"leaf-links-{level}")
            known = tables.written(widened(known, found), f"leaf-classes-{level}")
        if some[1] is not False:
            return known
        large = now.join(judged.filter("not small"), "region").select("region", "nid", "n", "c")
        cut = tables.written(_divided(large, _some(large, level, pivots), bodies, kind, share), f"divided-{level}")
        known = tables.written(widened(known, _connected(cut)), f"classes-{level}")
        # What a division left together is compared block by block; the other regions of the pivots, named anew, are the next level.
        deeper = cut.select("region", "nid", "n", F.explode("at").alias("pivot"))
        shrunk = deeper.groupBy("region", "pivot").agg(F.count(F.lit(1)).alias("part")).groupBy("region").agg(F.max("part").alias("part"))
        shrunk = tables.written(shrunk.join(judged, "region").select("region", (F.col("part") <= SHRUNK * F.col("c")).alias("shrunk")), f"shrunk-{level}")
        if shrunk.filter("not shrunk").limit(1).count():
            whole = _open(large.select("region", "nid").join(shrunk.filter("not shrunk").select("region"), "region"), known, True)
            found = tables.written(_leaves(_blocks(whole), bodies, ("region", "tile"), kind), f"block-links-{level}")
            known = tables.written(widened(known, found), f"block-classes-{level}")
        named = deeper.join(shrunk.filter("shrunk").select("region"), "region").select(F.xxhash64("region", "pivot", F.lit(level)).alias("region"), "nid", "n")
        now = tables.written(_open(named, known), f"region-{level}")


def similar(bodies: DataFrame, tables: Scratch, kind: Shingling, known: DataFrame) -> DataFrame:
    """``node`` and ``class`` after linking all texts (``nid``, ``text``, one of each) that share enough shingles, on top of the ``known`` classes."""
    measured = tables.written(_measured(bodies, frequent(bodies, kind), kind).filter("node is not null"), "similar-measured")
    met = _open(tables.written(regions(measured, kind.percent), "similar-met"), known)
    members = tables.written(_with_neighbours(met, measured, kind.percent), "similar-members")
    return classes(members, bodies, tables, kind, known=known)


def joined(docs: DataFrame, id_column: str = "doc_id", text: str = "text", kind: Shingling = DEFAULT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row: the smallest id that links lead to.

    Sets are the distinct 4-word shingles of the text with A-Z lower-cased, all words for a text of fewer; equal sets are one node.  A text without a word
    (null, empty) has an empty set and links with nothing, not even its copies: its component is its own id.  Every row is a document, also of a
    repeated id; the component of rows without any id is null.  An empty table gives no row; other columns are ignored.
    """
    tables = Scratch(docs.sparkSession)
    body = text_column(docs, text)
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), F.unhex(F.substring(F.sha2(body, 256), 1, 32)).alias("text_key"), body.alias("text"))
    measured = tables.written(_measured(rows, frequent(rows, kind), kind), "measured")
    known = measured.filter("node is not null").groupBy("node")
    nodes = known.agg(F.min("doc_id").alias("first"), F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("near").alias("near"), F.first("counts").alias("counts"), F.first("rare").alias("rare"))
    nodes = tables.written(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    met = tables.written(regions(nodes, kind.percent), "met")
    members = tables.written(_with_neighbours(met, nodes, kind.percent), "members")
    wanted = nodes.select("nid", "text_key").join(members.select("nid").distinct().hint("merge"), "nid", "left_semi")
    bodies = tables.written(_bodies(rows, wanted), "bodies")
    found = classes(members, bodies, tables, kind).withColumnRenamed("node", "nid")
    classed = nodes.select("node", "nid", "first").join(found, "nid", "left").select("node", "first", F.coalesce("class", "nid").alias("class"))
    lowest = classed.groupBy("class").agg(F.min("first").alias("component_id"))
    answers = classed.select("node", "class").join(lowest, "class").select("node", "component_id")
    out = measured.select("doc_id", "n", "node").join(answers, "node", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    out = tables.written(out, "components")
    tables.drop(*(name for name in list(tables.paths) if name != "components"))
    return out
