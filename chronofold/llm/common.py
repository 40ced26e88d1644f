"""What the operators of this package share: byte views of text columns, words, hashes and anchors.

Texts reach Python as Arrow batches and are worked on as byte arrays of a few megabytes, so a task's memory
does not grow with the number of rows.  A null text counts as empty everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once; a longer single text is taken whole.
CHUNK_BYTES = 2 << 20

#: The six ASCII white-space bytes that separate words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


#: Rows that travel to Python at once.
BATCH_ROWS = 1000


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` with batches of few rows, so that a worker never holds many long texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def text_column(docs: DataFrame, column: str = "text"):
    """The text with null as the empty string."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with at most ``limit`` bytes of text each, at least one row."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text starts (one offset more than texts)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = ~SPACE) -> tuple[np.ndarray, ...]:
    """Start, end and text number of every run of bytes of the class ``inside``; runs end with their text."""
    part = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], part[:-1])) if len(part) else part
    after = np.concatenate((part[1:], [False])) if len(part) else part
    starts = np.flatnonzero(part & (~before | edge[:-1]))
    ends = np.flatnonzero(part & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, _ODD, np.uint64), np.full(n + 1, _ODD_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_codes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial codes (one more than bytes) and the factors that bring a piece to position 0."""
    size = 1 << max(10, int(len(data)).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[: len(data)], out=total[1:])
    return total, down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte pieces ``[start, end)``: equal pieces have equal hashes, wherever they lie."""
    total, down = prefix_codes(data)
    return mixed((total[ends] - total[starts]) * down[starts])


def gram_hashes(items: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` consecutive item hashes, one for each place where ``n`` items fit."""
    count = max(0, len(items) - n + 1)
    h = np.zeros(count, np.uint64)
    for k in range(n):
        h = h * np.uint64(_ODD) + items[k : k + count]
        h ^= h >> np.uint64(29)
    return h


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value in every window of ``width``; the leftmost among equals.

    Blocks of ``width`` with running minima from both sides: each window is the tail of one block and the
    head of the next."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    blocks = -(-n // width)
    order = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    order[:n] = values
    grid = order.reshape(blocks, width)
    place = np.arange(blocks * width).reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1)
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1]
    fresh = np.empty(grid.shape, bool)
    fresh[:, 0] = True
    fresh[:, 1:] = head[:, 1:] < head[:, :-1]
    head_at = np.maximum.accumulate(np.where(fresh, place, 0), axis=1).ravel()
    own = grid == tail  # the leftmost place at or after this one that holds the tail's minimum
    tail_at = np.minimum.accumulate(np.where(own, place, blocks * width)[:, ::-1], axis=1)[:, ::-1].ravel()
    tail, head = tail.ravel(), head.ravel()
    first = np.arange(n - width + 1)
    last = first + width - 1
    return np.where(tail[first] <= head[last], tail_at[first], head_at[last])


def arrow(columns: dict[str, object], like: dict[str, pa.DataType]) -> pa.RecordBatch:
    """A batch with the given columns and types."""
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in like.items()], names=list(like))


def once_per_task(rows: DataFrame, key: str) -> DataFrame:
    """The rows without those whose key their task has met already: copies are dropped before they travel.

    A task remembers one short key per row of its split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            new = []
            for i, k in enumerate(batch.column(key).to_pylist()):
                if k not in seen:
                    seen.add(k)
                    new.append(i)
            yield batch.take(pa.array(new, pa.int64()))

    return mapped(rows, run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema))
