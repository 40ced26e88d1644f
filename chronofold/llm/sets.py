"""Shingle sets of texts and their overlaps."""

from __future__ import annotations

import numpy as np

from chronofold.llm.common import gram_hashes, mixed, span_hashes, words

#: Shingles whose overlaps are counted at once.
_COLUMNS = 1 << 12

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts with their counts and owners, ordered by owner and hash.

    A text of fewer words than a shingle has one shingle, all its words; a text without a word has none.
    """
    starts, ends, owner = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    grams = gram_hashes(hashes, n)
    inside = owner[: len(grams)] == owner[n - 1 : n - 1 + len(grams)]
    keys, of = [grams[inside]], [owner[: len(grams)][inside]]
    sizes = np.bincount(owner, minlength=len(offsets) - 1)
    first = np.cumsum(sizes) - sizes
    for size in range(1, n):
        short = np.flatnonzero(sizes == size)
        if len(short):
            h = np.full(len(short), size, np.uint64)
            for k in range(size):
                h = mixed(h * _GOLDEN + hashes[first[short] + k])
            keys.append(h)
            of.append(short)
    keys, of = np.concatenate(keys), np.concatenate(of)
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    if not len(keys):
        return keys, np.zeros(0, np.int64), of
    new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])])
    return keys[new], np.diff(np.r_[new, len(keys)]), of[new]


def linked(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each shingle set the first one that a chain of similar pairs leads to; every pair is compared."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count[column] > 1
    owner, column = owner[common], (np.cumsum(count > 1) - 1)[column[common]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, n))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        some = slice(*np.searchsorted(column, (low, low + _COLUMNS)))
        grid = np.zeros((n, _COLUMNS), np.float32)
        grid[owner[some], column[some] - low] = 1
        both += grid @ grid.T
    similar = both >= similarity * (sizes[:, None] + sizes - both) - 1e-9
    np.fill_diagonal(similar, True)
    label = np.arange(n)
    while True:
        low = np.where(similar, label, n).min(1)
        if (low == label).all():
            return label
        label = low
