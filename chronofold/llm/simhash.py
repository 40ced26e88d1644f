"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius by permuted block tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.common import gram_hashes, mapped, slices, span_hashes, text_column, utf8, words
from chronofold.session import written

BITS = 64
TERM_WORDS = 5
#: Radius of the search; blocks of the fingerprint, of which all but ``RADIUS`` stay equal within it.
RADIUS, BLOCKS = 3, 6
#: Ranges of ids that documents are sorted in, for each shuffle partition.
RANGES_PER_PARTITION = 4
SAMPLED_PER_RANGE = 40


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One 64-bit fingerprint per text: the sign of each bit's votes.

    A term is a run of five words (all words of a shorter text); every occurrence votes with its length in bytes, at most 255, for the bits
    set in its hash and against the others.  A text without a word has the fingerprint 0.
    """
    n = len(offsets) - 1
    starts, ends, owner = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    sizes = np.bincount(owner, minlength=n)
    first = np.cumsum(sizes) - sizes
    grams = gram_hashes(hashes, TERM_WORDS)
    at = np.flatnonzero(owner[: len(grams)] == owner[TERM_WORDS - 1 : TERM_WORDS - 1 + len(grams)])
    short = np.flatnonzero((sizes > 0) & (sizes < TERM_WORDS))
    terms = np.concatenate((grams[at], [np.bitwise_xor.reduce(gram_hashes(hashes[first[i] : first[i] + sizes[i]], sizes[i])) for i in short])).astype(np.uint64)
    weights = np.minimum(np.concatenate((ends[at + TERM_WORDS - 1] - starts[at], ends[first[short] + sizes[short] - 1] - starts[first[short]])), 255).astype(np.int16)
    of = np.concatenate((owner[at], short))
    order = np.argsort(of, kind="stable")
    terms, weights, of = terms[order], weights[order], of[order]
    votes = np.zeros((n, BITS), np.int64)
    if len(terms):
        begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        for part in range(0, BITS, 16):  # a quarter of the bits at a time keeps the table of votes small
            bits = np.unpackbits((terms >> np.uint64(part)).astype("<u2").view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
            votes[of[begin], part : part + 16] = np.add.reduceat(np.where(bits, weights[:, None], -weights[:, None]), begin, axis=0, dtype=np.int64)
    return ((votes > 0).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum(1, dtype=np.uint64)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def range_bounds(ids: DataFrame, line: str) -> np.ndarray:
    """Numbers that occur, in ascending order from the smallest on, which cut the rows into about equal ranges.

    Taken from a sample by hash, of a size that depends on the number of ranges only, as a distributed sort does."""
    count = RANGES_PER_PARTITION * int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low, n = ids.agg(F.min(line), F.count(F.lit(1))).first()
    if not n:
        return np.zeros(0, np.int64)
    share = int(min(1.0, SAMPLED_PER_RANGE * count / n) * (1 << 30))
    sample = ids.filter(F.pmod(F.xxhash64(line), F.lit(1 << 30)) < share).select(line).toPandas()[line].to_numpy(np.int64)
    cuts = np.sort(sample)[np.arange(1, count) * len(sample) // count] if len(sample) else sample
    return np.unique(np.append(cuts, low))


def _printed(docs: DataFrame, bounds: np.ndarray) -> DataFrame:
    """``doc_id``, ``line``, ``text`` with the fingerprint ``print``, the ``range`` of the line and whether it is a range's ``first``."""
    shared = docs.sparkSession.sparkContext.broadcast(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                prints = fingerprints(*utf8(part.column("text")))
                line = part.column("line").to_numpy()
                at = np.searchsorted(shared.value, line, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(prints.view(np.int64)), pa.array(at, pa.int64()), pa.array(shared.value[at] == line)],
                    names=["doc_id", "line", "text", "print", "range", "first"],
                )

    return mapped(docs, run, "doc_id long, line long, text string, print long, range long, first boolean")


def with_next(rows: DataFrame, order: str, columns: tuple[str, ...], ranges: int) -> DataFrame:
    """Every row with the ``columns`` of the next row in the order of a number, as ``next_...``; after the last comes the first.

    Rows have their ``range`` and whether they are of its ``first`` number.  First rows are also sent to the range before, as its guests, so no range
    needs another and none holds all rows.  Rows of equal number follow each other in the order of the columns.
    """
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    visit = F.struct(F.pmod(F.col("range") - 1, F.lit(max(1, ranges))).alias("range"), F.lit(True).alias("guest"))
    dealt = rows.withColumn("at", F.explode(F.when(F.col("first"), F.array(own, visit)).otherwise(F.array(own))))
    dealt = dealt.drop("range", "first").select("*", "at.range", "at.guest").drop("at")
    line = Window.partitionBy("range").orderBy("guest", order, *columns)
    return dealt.select("*", *[F.lead(c).over(line).alias(f"next_{c}") for c in columns]).filter("not guest").drop("range", "guest")


def block_keys(value: Column) -> list[Column]:
    """One key for every choice of blocks that two fingerprints within the radius may have in common."""
    edges = [i * BITS // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [F.shiftrightunsigned(value, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    return [F.xxhash64(F.lit(n), *[blocks[i] for i in chosen]) for n, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - RADIUS))]


def neighbours(prints: DataFrame, wanted: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``print`` of ``wanted`` and ``n_near``: how many rows of ``prints`` (``print``, ``n``) lie within the radius, itself included.

    Both have distinct fingerprints.  Two fingerprints within the radius differ in at most that many blocks and meet in the table of the other blocks; a pair is
    counted in the first table where it meets, and distances are taken inside the join, so only true neighbours are rows.
    """
    if radius > RADIUS:
        raise ValueError(f"the block tables find neighbours up to {RADIUS} bits")
    tables = len(block_keys(F.lit(0)))

    def spread(frame: DataFrame, name: str) -> DataFrame:
        keys = F.array(*block_keys(F.col("print")))
        return frame.select(F.col("print").alias(name), *[c for c in frame.columns if c != "print"], F.posexplode(keys).alias("table", "key"))

    left, right = spread(wanted.select("print"), "a"), spread(prints.select("print", "n"), "b").withColumnRenamed("table", "of")
    mine, theirs = block_keys(F.col("a")), block_keys(F.col("b"))
    first_met = F.coalesce(*[F.when(x == y, F.lit(i)) for i, (x, y) in enumerate(zip(mine, theirs, strict=True))], F.lit(tables))
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius) & (first_met == F.col("table"))
    # Both sides grow with the corpus: merged at every size.
    met = left.join(right.withColumnRenamed("key", "other").hint("merge"), (F.col("key") == F.col("other")) & (F.col("table") == F.col("of")) & near)
    return met.groupBy(F.col("a").alias("print")).agg(F.sum("n").alias("n_near"))


def fingerprinted(docs: DataFrame, id_column: str = "doc_id", text: str = "text", every: int = 50) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike they and the next document are.

    ``edited``: the last floor(n_chars/4) code points are replaced by the first as many of the next text in the order of the id (nulls first), after the last
    the first; equal ids follow in the order of the text.  ``n_near`` is, for ids divisible by ``every``, how many other rows have a fingerprint within
    :data:`RADIUS` bits, else null.  A null text is empty.  Fingerprints are 16 hexadecimal digits.  Each text crosses the network once; repeated rows are repeated;
    other columns are ignored; an empty table gives no row.
    """
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[id_column].cast("long"), F.lit(-(1 << 63))).alias("line"), text_column(docs, text).alias("text"))
    bounds = range_bounds(rows.select("line"), "line")
    paired = with_next(_printed(rows, bounds), "line", ("text", "print"), len(bounds))

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sizes, edited = [], []
                for own, other in zip(part.column("text").to_pylist(), part.column("next_text").to_pylist(), strict=True):
                    gone = len(own) // 4
                    sizes.append(len(own))
                    edited.append(own[: len(own) - gone] + (other or "")[:gone])
                prints = fingerprints(*utf8(pa.array(edited, pa.large_string())))
                digests = [hashlib.sha256(e.encode()).hexdigest() for e in edited]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), part.column("print"), pa.array(prints.view(np.int64)), part.column("next_print")],
                    names=["doc_id", "n_chars", "edited_sha256", "print", "edited", "next"],
                )

    out = written(mapped(paired.select("doc_id", "text", "print", "next_text", "next_print"), 
        edit, "doc_id long, n_chars long, edited_sha256 string, print long, edited long, next long"), "fingerprints")
    prints = out.groupBy("print").agg(F.count(F.lit(1)).alias("n"))
    wanted = out.filter(F.col("doc_id") % every == 0).select("print").distinct()
    found = neighbours(prints, wanted).withColumnRenamed("print", "found")
    # Only the rows asked about are joined, so that the others do not meet under a null key.
    is_asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    asked = out.filter(is_asked).join(found, F.col("print") == F.col("found"), "left").drop("found")
    both = asked.unionByName(out.filter(~is_asked).withColumn("n_near", F.lit(None).cast("long")))
    return both.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.lower(F.lpad(F.hex("edited"), 16, "0")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited")).alias("near_edited"), likeness(F.col("print"), F.coalesce("next", "print")).alias("near_next"),
        (F.col("n_near") - 1).alias("n_near"),
    )
