"""Removal of byte strings that occur more than once, by column-wise construction over many short documents.

The documents of one construction are segments with a common anchor, laid under each other so that the anchors stand in one column.
Each round inserts one symbol of every document, from the right-most column to the left: the order of the suffixes that start in the
column (the collection's Burrows-Wheeler order of that column) follows from the last by a stable sort on the new symbol, and the
common prefixes of neighbours from the smallest between them.  Columns are read from, and transforms written to, external
files in sequence.  A string that recurs has the same anchor at the same place, so suffixes of other columns are never its neighbours.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import mapped, mixed, prefix_codes, slices, span_hashes, utf8
from chronofold.llm.passages import LAST_ID, Segments, anchored, identified, kept_segments, merged_runs, repeated_units

WINDOW = 400
_GRAM = 32
#: Windows of a hot anchor are dealt out in ranges of so many starts, by the bytes that all windows of the range have.
_RANGE = 48
_EMPTY = 256


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive bytes."""
    count = max(0, len(data) - n + 1)
    total, down = prefix_codes(data)
    return mixed((total[n : n + count] - total[:count]) * down[:count])


@dataclass(frozen=True)
class ByteCutter:
    """Segments of bytes: an anchor is the smallest hash of 32 bytes in a window."""

    window: int = WINDOW

    def __call__(self, data, offsets, wanted, hot) -> Segments:
        owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        gram = min(_GRAM, self.window)
        first, windows, anchor = anchored(owner, _grams(data, gram), gram, self.window)
        key = span_hashes(data, anchor, anchor + gram) & ~np.uint64(1)
        none = np.zeros(len(first), np.int64)
        if wanted is None:
            return Segments(owner[first], key, none, windows, none, none, key)
        keep = kept_segments(Segments(owner[first], key, first, windows, first, first, key), wanted)
        first, windows, key, anchor = first[keep], windows[keep], key[keep], anchor[keep]
        split = kept_segments(Segments(owner[first], key, first, windows, first, first, key), hot)

        # A hot anchor's windows are cut where their distance to the anchor passes a multiple of the range.
        far = anchor[split] - first[split]
        ranges = far // _RANGE - (far - windows[split] + 1) // _RANGE + 1
        of = np.repeat(np.flatnonzero(split), ranges)
        nth = np.arange(ranges.sum()) - np.repeat(np.cumsum(ranges) - ranges, ranges)
        step = (anchor[of] - first[of]) // _RANGE - nth
        high = np.minimum(anchor[of] - first[of], step * _RANGE + _RANGE - 1)
        low = np.maximum(anchor[of] - first[of] - windows[of] + 1, step * _RANGE)
        start, count = anchor[of] - high, high - low + 1
        core = anchor[of] - step * _RANGE  # every window of the range has [core, core + window - range)
        core_key = mixed(span_hashes(data, core, core + self.window - _RANGE + 1) + step.astype(np.uint64)) & ~np.uint64(1) if self.window > _RANGE else key[of]

        first, windows = np.concatenate((first[~split], start)), np.concatenate((windows[~split], count))
        key = np.concatenate((key[~split], core_key))
        end = first + windows + self.window - 1
        return Segments(owner[first], key, first - offsets[owner[first]], windows, first, end, span_hashes(data, first, end))


def repeated_starts(group: np.ndarray, documents: list[bytes], align: np.ndarray, length: int, transforms=None) -> np.ndarray:
    """Documents x columns: whether a string of ``length`` bytes that starts there is in another document of the group at the same column.

    ``group`` ascends; ``align`` is the column of each document's first byte.  ``transforms``, a binary file, gets for
    each round the column's transform: the symbols before the suffixes, in the order of the suffixes, as 16-bit numbers.
    """
    n = len(documents)
    sizes = np.array([len(d) for d in documents])
    width = int((align + sizes).max())
    grid = np.full((n, width), _EMPTY, np.uint16)
    for i, d in enumerate(documents):
        grid[i, align[i] : align[i] + len(d)] = np.frombuffer(d, np.uint8)
    hits = np.zeros((n, width), bool)
    with tempfile.TemporaryFile() as columns:
        np.ascontiguousarray(grid.T[::-1]).tofile(columns)
        del grid
        columns.seek(0)
        ranks = np.cumsum(np.r_[0, group[1:] != group[:-1]])
        order, common = np.arange(n), np.zeros(n + 1, np.int32)  # common[i]: of the suffixes at places i - 1 and i
        for column in range(width - 1, -1, -1):
            symbols = np.fromfile(columns, np.uint16, n)[order]
            if transforms is not None:
                transforms.write(symbols.tobytes())
            place = ranks[order] * (_EMPTY + 1) + symbols
            moved = np.argsort(place, kind="stable")
            place, order = place[moved], order[moved]
            same = np.flatnonzero((place[1:] == place[:-1]) & (symbols[moved][1:] != _EMPTY))
            after = np.zeros(n + 1, np.int32)
            if len(same):
                bounds = np.stack((moved[same] + 1, moved[same + 1] + 1), 1).ravel()
                after[same + 1] = np.minimum.reduceat(common, bounds)[::2] + 1
            common = after
            if width - column >= length:
                near = np.maximum(common[:-1], common[1:]) >= length
                hits[order[near], column] = True
    return hits


def repeated_in_segments(keys: np.ndarray, pieces: list[bytes], ids: np.ndarray, window: int = WINDOW) -> list[tuple[list[int], list[int]]]:
    """For each segment its bytes covered by windows that another segment of the same anchor has too."""
    out: list[tuple[list[int], list[int]]] = [([], [])] * len(pieces)
    several = np.zeros(len(keys), bool)
    several[1:] |= keys[1:] == keys[:-1]
    several[:-1] |= keys[1:] == keys[:-1]
    at = np.flatnonzero(several)
    if not len(at):
        return out
    some = [pieces[i] for i in at]
    anchors = np.array([anchor_place(p, window) for p in some])
    hits = repeated_starts(keys[at], some, anchors.max() - anchors, window)
    for i, row, shift in zip(at, hits, anchors.max() - anchors, strict=True):
        starts = np.flatnonzero(row) - shift
        if len(starts):
            new = np.r_[True, starts[1:] > starts[:-1] + window]
            last = np.r_[new[1:], True]
            out[i] = (starts[new].tolist(), (starts[last] + window).tolist())
    return out


def anchor_place(piece: bytes, window: int) -> int:
    """Where the anchor of a segment lies: at the smallest gram of its first window."""
    head = np.frombuffer(piece[:window], np.uint8)
    return int(np.argmin(_grams(head, min(_GRAM, window))))


def single_windows(piece: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window of a segment."""
    data = np.frombuffer(piece, np.uint8)
    return _grams(data, window), _grams(data ^ np.uint8(0xA5), window)


FIELDS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row.

    A byte goes if a string of 400 bytes around it starts anywhere else too, in the same text or another; strings are those of the input and
    never cross texts.  Null and empty texts have no bytes; texts under 400 bytes lose none; repeated rows repeat each other's strings
    and lose all from 400 bytes on; a null id is an id of its own; other columns are ignored.
    """
    rows = identified(docs, id_column, text)
    info = repeated_units(rows, ByteCutter(), repeated_in_segments, same_text=True, singles=single_windows)
    joined = rows.withColumn("digest", F.unhex(F.md5("text"))).join(info, ["id", "digest"]).select(
        F.when(F.col("id") < LAST_ID, F.col("id")).alias("doc_id"), "text", (F.col("copies") > 1).alias("copied"), "runs"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = utf8(part.column("text"))
                sizes, gone, spans, digests = np.diff(offsets), [], [], []
                for i, (copied, runs) in enumerate(zip(part.column("copied").to_pylist(), part.column("runs").to_pylist(), strict=True)):
                    own = data[offsets[i] : offsets[i + 1]]
                    s, e = (np.array([0]), np.array([len(own)])) if copied and len(own) >= WINDOW else merged_runs(None if copied else runs)
                    at, digest = 0, hashlib.sha256()
                    for a, b in zip(s.tolist(), e.tolist(), strict=True):
                        digest.update(own[at:a])
                        at = b
                    digest.update(own[at:])
                    gone.append(int((e - s).sum()))
                    spans.append(len(s))
                    digests.append(digest.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return mapped(joined, run, FIELDS)
