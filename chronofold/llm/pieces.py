"""Pieces of texts as spans of bytes, and a table that numbers distinct spans, without a Python object per word."""

from __future__ import annotations

import unicodedata

import numpy as np
import regex

from chronofold.llm.common import SPACE, mixed

#: Classes of bytes: between pieces, letters, numbers (each a piece), everything else, and runs that are cut elsewhere.
GAP, LETTER, NUMBER, OTHER, WHOLE = range(5)
#: Characters below this are cut here: none of them is composed with another one of them.
PLAIN_BELOW = 0x300

#: Letters after an apostrophe that form a piece with it, by the length of the piece.
_SHORT_ENDS = np.zeros((256, 256), bool)
_SINGLE_ENDS = np.zeros(256, bool)
_SINGLE_ENDS[[ord(c) for c in "stmd"]] = True
for _end in ("re", "ve", "ll"):
    _SHORT_ENDS[ord(_end[0]), ord(_end[1])] = True


def _character_tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower-case code of every character below :data:`PLAIN_BELOW`; ``WHOLE`` for those whose lower case is not one of them."""
    kinds, lower = np.zeros(PLAIN_BELOW, np.uint8), np.arange(PLAIN_BELOW)
    letter, number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    for code in range(PLAIN_BELOW):
        c = chr(code)
        low = c.lower()
        if code in (*range(9, 14), 0x20, 0x85, 0xA0):
            kinds[code] = GAP
        elif len(low) != 1 or ord(low) >= PLAIN_BELOW or len(low.encode()) != len(c.encode()) or unicodedata.normalize("NFC", c) != c:
            kinds[code] = WHOLE
        else:
            kinds[code] = LETTER if letter.match(low) else NUMBER if number.match(low) else OTHER
            lower[code] = ord(low)
    return kinds, lower


_KINDS, _LOWER = _character_tables()
_KINDS_ASCII = np.concatenate([_KINDS[:128], np.full(128, WHOLE, np.uint8)])
_LOWER_ASCII = np.concatenate([_LOWER[:128], np.arange(128, 256)]).astype(np.uint8)


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, end, text number and class of the pieces of all texts.

    A run between ASCII white space that holds a character from :data:`PLAIN_BELOW` on, or ``<|`` as special tokens do, is one
    piece of the class :data:`WHOLE` with its bytes as they are.
    """
    low, kind = _LOWER_ASCII[data], _KINDS_ASCII[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    fresh = np.ones(len(data), bool)  # not the second byte of a character
    if len(data) and data.max() >= 0x80:
        lead = np.flatnonzero((data >= 0xC2) & (data < 0xCC))
        code = ((data[lead].astype(np.int64) & 0x1F) << 6) | (data[lead + 1] & 0x3F)
        kind[lead] = kind[lead + 1] = _KINDS[code]
        low[lead], low[lead + 1] = 0xC0 | (_LOWER[code] >> 6), 0x80 | (_LOWER[code] & 0x3F)
        fresh[lead + 1] = False
    odd = kind == WHOLE
    odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    odd = np.flatnonzero(odd)
    if len(odd):
        stops = np.flatnonzero(SPACE[data])
        stops = np.unique(np.concatenate([stops, stops + 1, offsets]))
        run = np.unique(np.searchsorted(stops, odd, "right")) - 1
        a, b = stops[run], stops[run + 1]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[a] += 1
        inside[b] -= 1
        inside = np.cumsum(inside[:-1]).astype(bool)
        kind[inside], low[inside], fresh[inside] = WHOLE, data[inside], False
    before = np.concatenate(([GAP], kind[:-1])) if len(kind) else kind
    start = (kind != GAP) & ((kind != before) | edge[:-1] | ((kind == NUMBER) & fresh))
    mark = np.flatnonzero((low == 0x27) & (kind == OTHER) & start)
    if len(mark):
        padded, next_kind = np.concatenate([low, [0, 0, 0]]), np.concatenate([kind, [GAP] * 4])
        ends = np.concatenate([edge, [True] * 3])
        one = (next_kind[mark + 1] == LETTER) & ~ends[mark + 1]
        two = one & (next_kind[mark + 2] == LETTER) & ~ends[mark + 2]
        size = np.where(one & _SINGLE_ENDS[padded[mark + 1]], 2, np.where(two & _SHORT_ENDS[padded[mark + 1], padded[mark + 2]], 3, 0))
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        after = mark + size
        more = (next_kind[after] == LETTER) & ~ends[after]
        start[after[more]] = True
    last = np.concatenate([start[1:] | (kind[1:] == GAP) | edge[1:-1], [True]]) if len(kind) else start
    starts, ends = np.flatnonzero(start), np.flatnonzero((kind != GAP) & last) + 1
    return low, starts, ends, np.searchsorted(offsets, starts, "right") - 1, kind[starts]


#: Pieces of more bytes do not go into a table.
TABLE_BYTES = 16


class Table:
    """Numbers of distinct pieces of at most 16 bytes, counted up from 0, in an open-addressed table of arrays.

    A piece is told by its first and last eight bytes and its length, so equal numbers mean equal bytes.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.mask = (1 << (2 * capacity - 1).bit_length()) - 1
        self.slots = np.full(self.mask + 1, -1, np.int32)
        self.first, self.last = np.zeros(capacity, np.uint64), np.zeros(capacity, np.uint64)
        self.size = np.zeros(capacity, np.uint8)
        self.count = 0

    _MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1] * 9, np.uint64)

    def keys(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last eight bytes and length of pieces of at most 16 bytes."""
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        window = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
        size = ends - starts
        first = window[starts] & self._MASKS[size]
        last = np.zeros(len(starts), np.uint64)
        wide = np.flatnonzero(size > 8)
        last[wide] = window[ends[wide] - 8]
        return first, last, size

    @staticmethod
    def _hash(first: np.ndarray, last: np.ndarray, size: np.ndarray) -> np.ndarray:
        return mixed(first + mixed(last * np.uint64(31) + size.astype(np.uint64)))

    def find(self, first: np.ndarray, last: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers of short pieces, -1 for those that are not there."""
        slot = (self._hash(first, last, size) & np.uint64(self.mask)).astype(np.int64)
        out = self.slots[slot]
        at = np.maximum(out, 0)
        open_ = np.flatnonzero((out >= 0) & ((self.first[at] != first) | (self.last[at] != last) | (self.size[at] != size)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            got = self.slots[slot[open_]]
            out[open_] = got
            at = np.maximum(got, 0)
            wrong = (got >= 0) & ((self.first[at] != first[open_]) | (self.last[at] != last[open_]) | (self.size[at] != size[open_]))
            open_ = open_[wrong]
        return out

    def add(self, first: np.ndarray, last: np.ndarray, size: np.ndarray) -> None:
        """Numbers new, distinct short pieces in their order."""
        end = self.count + len(first)
        self.first[self.count : end], self.last[self.count : end], self.size[self.count : end] = first, last, size
        number = np.arange(self.count, end, dtype=np.int32)
        slot = (self._hash(first, last, size) & np.uint64(self.mask)).astype(np.int64)
        while len(number):
            free = self.slots[slot] < 0
            _, winner = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            winner = winner[free[winner]]
            self.slots[slot[winner]] = number[winner]
            rest = np.ones(len(number), bool)
            rest[winner] = False
            number, slot = number[rest], (slot[rest] + 1) & self.mask
        self.count = end
