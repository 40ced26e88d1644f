"""Near-duplicate documents by DartMinHash signatures, banded joining and an exact check.

Every element of a weighted set owns the area from 0 to its weight; darts fall on it as a Poisson process in weight and time, all
derived from hashes of the element, so equal elements get equal darts.  The earliest dart of each coordinate is
the signature: two sets agree in a coordinate with the probability of their weighted Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm import metric
from chronofold.llm.common import mapped, mixed, once_per_task, slices, text_column, utf8
from chronofold.llm.graph import components
from chronofold.llm.metric import Shingling
from chronofold.llm.scratch import Scratch
from chronofold.llm.sets import shingles

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Two texts of similarity 0.8 share a band with probability 1 - (1 - 0.8^4)^24 > 0.999996.
BANDS, BAND_ROWS = 24, 4
COORDINATES = BANDS * BAND_ROWS
#: Members of a group that are compared with its leader in one task.
MEMBERS_PER_TASK = 250
SHINGLING = Shingling(words=SHINGLE_WORDS, fold_case=False, percent=round(100 * SIMILARITY))

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def signatures(keys: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, k: int = COORDINATES) -> np.ndarray:
    """The n x k signatures of n weighted sets given as (element hash, weight > 0, set number).

    The weight axis is cut into layers [0, 1), [1, 2), [2, 4) and so on.  Darts hit a layer at a rate of its height, one after
    another in time; those above the element's weight miss.  About k ln k + 2 k darts fill all coordinates, so a set of total
    weight w is watched until the time (k ln k + 2 k) / w; sets with a coordinate still empty are watched twice as long.  An empty set has no dart: all its coordinates stay at the largest value.
    """
    out_time, out = np.full((n, k), np.inf), np.full((n, k), _NONE, np.uint64)
    if not len(keys):
        return out
    total = np.bincount(owner, weights, n)
    until = np.divide(k * np.log(k) + 2 * k, total, out=np.zeros(n), where=total > 0)
    todo = np.flatnonzero(total > 0)
    layers = 1 + np.ceil(np.log2(np.maximum(weights, 1))).astype(int)
    which = np.repeat(np.arange(len(keys)), layers)
    layer = np.arange(len(which)) - np.repeat(np.cumsum(layers) - layers, layers)
    low, high = np.where(layer == 0, 0.0, 2.0 ** (layer - 1)), 2.0**layer
    seed = mixed(keys[which] + _GOLDEN * (layer.astype(np.uint64) + np.uint64(1)))
    set_of, most = owner[which], weights[which]
    while len(todo):
        at = np.flatnonzero(np.isin(set_of, todo)) if len(todo) < n else np.arange(len(seed))
        state, time = seed[at], np.zeros(len(at))
        while len(at):
            state = mixed(state + _GOLDEN)
            time = time - np.log(_uniform(state)) / (high - low)[at]
            live = time <= until[set_of[at]]
            at, state, time = at[live], state[live], time[live]
            dart = mixed(state ^ np.uint64(0xD6E8FEB86659FD93))
            hit = low[at] + (high - low)[at] * _uniform(mixed(dart + _GOLDEN)) < most[at]
            cell = set_of[at][hit] * k + (dart[hit] % np.uint64(k)).astype(np.int64)
            order = np.lexsort((dart[hit], time[hit], cell))
            cell, when, what = cell[order], time[hit][order], dart[hit][order]
            new = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else cell
            cell, when, what = cell[new], when[new], what[new]
            sooner = when < out_time.ravel()[cell]
            out_time.ravel()[cell[sooner]], out.ravel()[cell[sooner]] = when[sooner], what[sooner]
        todo = todo[np.isinf(out_time[todo]).any(1)]
        until[todo] *= 2
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One hash per band, different between bands."""
    rows = signature.reshape(len(signature), BANDS, BAND_ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLDEN, rows.shape[:2])
    for k in range(BAND_ROWS):
        h = mixed(h * np.uint64(0x110003) + rows[:, :, k])
    return h


def _banded(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest`` of the text and the ``bands`` of its shingles; no bands for a text without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = utf8(part.column("text"))
                keys, _, owner = shingles(data, offsets, SHINGLE_WORDS)
                n = part.num_rows
                bands = band_keys(signatures(keys, np.ones(len(keys)), owner, n))
                some = np.bincount(owner, minlength=n) > 0
                at = np.zeros(n + 1, np.int32)
                np.cumsum(some * BANDS, out=at[1:])
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(bands[some].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("digest"), lists], names=["doc_id", "digest", "bands"])

    return mapped(docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), "text"), run, "doc_id long, digest binary, bands array<long>")


def _similar(docs: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (``x``, ``leader``) whose shingle sets are similar enough, checked on the texts.

    A leader's members come to its tasks as texts; a leader of very many members is copied once for every
    :data:`MEMBERS_PER_TASK` of them, so no group has to fit one task.
    """
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_TASK).cast("int").alias("shares"))
    members = pairs.join(sizes, "leader").select(F.col("x").alias("doc_id"), "leader", F.pmod(F.xxhash64("x"), F.col("shares")).cast("int").alias("share"))
    leaders = sizes.select(F.col("leader").alias("doc_id"), "leader", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    rows = docs.join(members.union(leaders).hint("merge"), "doc_id").select("doc_id", "leader", "share", "text")
    dealt = rows.repartition("leader", "share").sortWithinPartitions("leader", "share", F.col("doc_id") != F.col("leader"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, of_head = None, None
        for batch in batches:
            for part in slices(batch):
                keys, _, owner = shingles(*utf8(part.column("text")), SHINGLE_WORDS)
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
                ids, leaders = part.column("doc_id").to_numpy(), part.column("leader").to_numpy()
                found = []
                for i in range(part.num_rows):
                    own = keys[bounds[i] : bounds[i + 1]]
                    if ids[i] == leaders[i]:
                        head, of_head = own, leaders[i]
                    elif of_head == leaders[i]:
                        both = np.count_nonzero(np.isin(own, head, assume_unique=True))
                        if both >= similarity * (len(own) + len(head) - both) - 1e-9:
                            found.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(ids[found], pa.int64()), pa.array(leaders[found], pa.int64())], names=["a", "b"])

    return mapped(dealt, run, "a long, b long")


def _crowded(nodes: DataFrame, texts: DataFrame, tables: Scratch, kind: Shingling, known: DataFrame) -> DataFrame:
    """The ``known`` classes widened by links between members of one bucket, for every bucket whose members (``node``, ``class``, ``bands``) are not one class yet.

    All members of such buckets are joined exactly: only texts that share a rare shingle and whose counts of shingles allow a link meet again, so pages of
    one template that stay under the limit cost no more than their number.  Buckets of three or fewer have been checked.
    """
    spots = nodes.select("node", "class", F.explode("bands").alias("key"))
    buckets = spots.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    some = spots.join(buckets.filter("n > 3 and low < high").select("key").hint("merge"), "key").select("node").distinct()
    bodies = tables.written(texts.join(some.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id").select(F.col("doc_id").alias("nid"), "text"), "crowded")
    return metric.similar(bodies, tables, kind, known)


def classified(docs: DataFrame, tables: Scratch, id_column: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Every row as ``doc_id`` and ``digest`` of its text, and the ``class`` of every digest with the smallest id in it, ``class_id``.

    Texts are told apart by their digests, ids play no part in which of them meet."""
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), F.unhex(F.sha2(text_column(docs, text), 256)).alias("digest"), text_column(docs, text).alias("text"))
    banded = tables.written(_banded(rows), "bands")
    nodes = banded.groupBy("digest").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    nodes = tables.written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    spots = nodes.select("node", F.explode("bands").alias("key"))
    ends = spots.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    met = spots.join(ends.hint("merge"), "key").select("node", F.explode(F.array("first", "last")).alias("other")).filter("node != other")
    pairs = tables.written(met.select(F.greatest("node", "other").alias("x"), F.least("node", "other").alias("leader")).distinct(), "pairs")

    wanted = pairs.select(F.explode(F.array("x", "leader")).alias("node")).distinct()
    # Lists of candidates grow with the corpus: they are merged at every size, never sent to all tasks.
    wanted = nodes.select("node", "digest").join(wanted.hint("merge"), "node")
    texts = once_per_task(rows.select("digest", "text"), "digest").join(wanted.hint("merge"), "digest").dropDuplicates(["node"])
    texts = tables.written(texts.select(F.col("node").alias("doc_id"), "text"), "candidates")
    nearest = pairs.groupBy("x").agg(F.min("leader").alias("leader"))
    links = tables.written(_similar(texts, nearest, similarity), "links")
    found = components(links)

    def class_of(frame: DataFrame, node: str, name: str) -> DataFrame:
        labels = found.select(F.col("node").alias(node), F.col("class").alias(name))
        return frame.join(labels, node, "left").withColumn(name, F.coalesce(name, node))

    open_pairs = class_of(class_of(pairs, "x", "x_class"), "leader", "leader_class").filter("x_class != leader_class").select("x", "leader")
    checked = tables.written(open_pairs.join(nearest, ["x", "leader"], "left_anti"), "open-pairs")
    more = tables.written(links.union(_similar(texts, checked, similarity)), "more-links")
    found = components(more)
    labelled = tables.written(class_of(nodes.select("node", "bands"), "node", "class"), "labelled")
    kind = Shingling(SHINGLE_WORDS, False, round(100 * similarity))
    found = _crowded(labelled, texts, tables, kind, found)
    classes = class_of(nodes.select("digest", "first", "node"), "node", "class")
    lowest = classes.groupBy("class").agg(F.min("first").alias("class_id"))
    classes = tables.written(classes.select("digest", "class").join(lowest, "class"), "classes")
    tables.drop(*(name for name in list(tables.paths) if name not in ("bands", "classes")))
    return banded.select("doc_id", "digest"), classes


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id`` and ``class_id`` of every row: equal texts and texts linked by similar shingle sets share a class.

    ``class_id`` is the smallest id of the class.  Equal texts (null and empty ones too) are one node from the start, different texts never are, whatever their
    ids.  Within a bucket of a band every text is first paired with the bucket's first and last text; then all texts of buckets that hold different
    classes are joined exactly, so every two similar texts that share a band are linked.  Texts without a word are alike only if equal.  A null id has a
    null class; rows of one id and several texts are rows of several classes; other columns are ignored.  ``similarity`` counts in hundredths.
    """
    tables = Scratch(docs.sparkSession)
    rows, classes = classified(docs, tables, id_column, text, similarity)
    out = rows.join(classes.select("digest", "class_id"), "digest", "left")
    out = tables.written(out.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id")), "answers")
    tables.drop("bands", "classes")
    return out


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the text of the smallest id stays, in one row.

    Null ids come last, and of the texts of one id the one with the smallest digest first, so a class without an id keeps a text too."""
    tables = Scratch(docs.sparkSession)
    rows, classes = classified(docs, tables, id_column, text, similarity)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    named = rows.join(classes.select("digest", "class"), "digest")
    first = named.groupBy("class").agg(F.min(place).alias("first"))
    dropped = named.join(first, "class").filter(place != F.col("first")).select("doc_id", "digest").distinct()
    dropped = tables.written(dropped.select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest")), "dropped")
    own = (docs[id_column].cast("long"), F.unhex(F.sha2(text_column(docs, text), 256)))
    kept = docs.join(dropped, own[0].eqNullSafe(dropped["gone_id"]) & (own[1] == dropped["gone_digest"]), "left_anti")
    repeated = rows.groupBy("doc_id", "digest").count().filter("count > 1").limit(1).count()
    tables.drop("bands", "classes")
    if not repeated:
        return kept
    marked = kept.withColumns({"__id": kept[id_column].cast("long"), "__text": F.sha2(text_column(kept, text), 256)})
    return marked.dropDuplicates(["__id", "__text"]).drop("__id", "__text")
