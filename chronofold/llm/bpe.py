"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

The tokenizer file is a byte-pair vocabulary whose words end in a suffix: text is composed
(NFC), lower-cased and cut into words; white space is dropped.  Words are cut as spans of bytes and looked up in a table of arrays; each distinct
word is merged once per Python worker, and again only if it was not met for a whole generation of the table.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from chronofold.llm import pieces
from chronofold.llm.common import mapped, slices, text_column, utf8

#: Words of a worker's table.
WORDS_KEPT = 500_000

NO_RANK = 1 << 30

# Fixed values of the file format: byte-level alphabet (printable bytes stand for themselves, the others follow from 256).
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# Fixed values of the file format: white space of its pattern (Unicode White_Space).
_GAP = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
_SPLIT_DIFFERS = regex.compile(r"[\x1c-\x1f]")
#: From here on character tables differ between Unicode versions.
_YOUNG = regex.compile("[\u0530-\U0010ffff]")


def _objects(values: list[bytes]) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def byte_alphabet() -> list[str]:
    """Character that stands for each byte."""
    table, extra = {b: chr(b) for b in _PRINTABLE}, 256
    for b in range(256):
        if b not in table:
            table[b], extra = chr(extra), extra + 1
    return [table[b] for b in range(256)]


def merge_word(symbols: list[int], rank_of: Callable[[int, int], tuple[int, int] | None]) -> list[int]:
    """Merges a word's symbols pair by pair, always the leftmost pair of the lowest rank.

    A segment tree holds the rank of the pair that starts at each symbol; its root tells the lowest rank and
    leads to the leftmost place.  A merge changes three leaves, so a word of n symbols takes O(n log n).
    ``rank_of(a, b)`` gives (rank, merged symbol) or None.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 1).bit_length()
    tree, made = [NO_RANK] * (2 * size), [0] * n
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    symbols = list(symbols)

    def pair(i: int) -> int:
        j = after[i]
        found = rank_of(symbols[i], symbols[j]) if j < n else None
        if found is None:
            return NO_RANK
        made[i] = found[1]
        return found[0]

    def put(i: int, rank: int) -> None:
        i += size
        if tree[i] == rank:
            return
        tree[i] = rank
        while i > 1:
            i >>= 1
            low = tree[2 * i] if tree[2 * i] <= tree[2 * i + 1] else tree[2 * i + 1]
            if tree[i] == low:
                break
            tree[i] = low

    for i in range(n - 1):
        tree[size + i] = pair(i)
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    while tree[1] < NO_RANK:
        low, i = tree[1], 1
        while i < size:
            i = 2 * i if tree[2 * i] == low else 2 * i + 1
        i -= size
        j = after[i]
        symbols[i] = made[i]
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        put(j, NO_RANK)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    out, i = [], 0
    while i < n:
        out.append(symbols[i])
        i = after[i]
    return out


def merge_words(symbols: np.ndarray, sizes: np.ndarray, keys: np.ndarray, merged: np.ndarray) -> np.ndarray:
    """:func:`merge_word` for many words at once: one segment tree per row, one merge per row and round.

    ``symbols`` is words x symbols, of which ``sizes`` count; ``keys`` are the mergeable pairs as
    ``a << 32 | b`` in ascending order and ``merged`` their (rank, symbol).  Dropped places become -1.
    """
    rows, n = symbols.shape
    size = 1 << max(1, (n - 1).bit_length())
    symbols = symbols.astype(np.int64)
    place = np.arange(n)
    after = np.minimum(place + 1, sizes[:, None])
    before = np.tile(place - 1, (rows, 1))
    tree = np.full((rows, 2 * size), NO_RANK, np.int64)
    made = np.zeros((rows, n), np.int64)

    def looked_up(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = a << 32 | b
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        return np.where(hit, merged[at, 0], NO_RANK), merged[at, 1]

    def put(r: np.ndarray, i: np.ndarray, rank: np.ndarray) -> None:
        i = i + size
        tree[r, i] = rank
        while i[0] > 1:
            i = i >> 1
            tree[r, i] = np.minimum(tree[r, 2 * i], tree[r, 2 * i + 1])

    if n > 1:
        ranks, made[:, :-1] = looked_up(symbols[:, :-1], symbols[:, 1:])
        tree[:, size : size + n - 1] = np.where(place[1:] < sizes[:, None], ranks, NO_RANK)
        for width in (1 << k for k in range(size.bit_length() - 2, -1, -1)):
            tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
    live = np.flatnonzero(tree[:, 1] < NO_RANK)
    while len(live):
        low, i = tree[live, 1], np.ones(len(live), np.int64)
        while i[0] < size:
            i = 2 * i + (tree[live, 2 * i] != low)
        i -= size
        j = after[live, i]
        symbols[live, i] = made[live, i]
        symbols[live, j] = -1
        k = after[live, j]
        after[live, i] = k
        put(live, j, np.full(len(live), NO_RANK))
        ends = k >= sizes[live]
        safe = np.where(ends, 0, k)
        before[live[~ends], k[~ends]] = i[~ends]
        rank, made[live, i] = looked_up(symbols[live, i], symbols[live, safe])
        put(live, i, np.where(ends, NO_RANK, rank))
        h = before[live, i]
        some = h >= 0
        if some.any():
            r, h, i = live[some], h[some], i[some]
            rank, made[r, h] = looked_up(symbols[r, h], symbols[r, i])
            put(r, h, rank)
        live = live[tree[live, 1] < NO_RANK]
    return np.where(place < sizes[:, None], symbols, -1)


class Encoder:
    """Encodes and decodes texts by a tokenizer file, with the results of the library that the file is made for."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        pairs = sorted((a << 32 | b, *found) for (a, b), found in self.merges.items())
        self.keys, self.merged = np.array([p[0] for p in pairs]), np.array([p[1:] for p in pairs])
        alphabet = byte_alphabet()
        self.of_byte = np.array([vocab[c] for c in alphabet])
        self.of_last = np.array([vocab[c + suffix] for c in alphabet])
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        splitter = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(splitter["pattern"]["Regex"])
        self.markers = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.library = Tokenizer.from_file(path)
        self.long: dict[tuple[bool, bytes], bytes] = {}
        self.table, self.met, self.known = pieces.Table(0), np.zeros(0, bool), np.empty(0, object)
        self._renewed(0)

    def _cut(self, run: str) -> list[bytes]:
        """The pieces of a run without white space.  Letters of younger scripts depend on the library's own
        character tables, so such runs are normalised and cut by it."""
        if run.isascii():
            low = run.lower()
            return [low.encode()] if low.isalpha() else [piece.encode() for piece in self.pieces.findall(low)]
        if _YOUNG.search(run):
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(run))
            return [bytes(self.byte_of[c] for c in piece) for piece, _ in pieces]
        # The library lowers character by character; no letter before _YOUNG but the final sigma depends on others.
        low = unicodedata.normalize("NFC", run)
        low = "".join([c.lower() for c in low]) if "Σ" in low else low.lower()
        return [piece.encode() for piece in self.pieces.findall(low)]

    def word_ids(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pieces that the pattern keeps together, rows of like length in one batch."""
        out: list[list[int]] = [[]] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            by_size.setdefault((len(piece) - 1).bit_length(), []).append(k)
        for bits, members in by_size.items():
            if bits > 6:
                for k in members:
                    codes = np.frombuffer(pieces[k], np.uint8)
                    out[k] = merge_word([*self.of_byte[codes[:-1]].tolist(), int(self.of_last[codes[-1]])], lambda a, b: self.merges.get((a, b)))
                continue
            for at in range(0, len(members), 4096):
                some = members[at : at + 4096]
                sizes = np.array([len(pieces[k]) for k in some])
                codes = np.frombuffer(b"".join(pieces[k].ljust(1 << bits, b"\0") for k in some), np.uint8).reshape(len(some), -1)
                symbols = self.of_byte[codes]
                last = (np.arange(len(some)), sizes - 1)
                symbols[last] = self.of_last[codes[last]]
                for k, row in zip(some, merge_words(symbols, sizes, self.keys, self.merged).tolist(), strict=True):
                    out[k] = [i for i in row if i >= 0]
        return out

    def _split(self, text: str) -> list[str]:
        """The runs between white space, and special tokens as runs of their own."""
        out, at = [], 0
        for found in self.markers.finditer(text) if self.markers else ():
            out += [*self._plain(text[at : found.start()]), found[0]]
            at = found.end()
        return out + self._plain(text[at:]) if at else self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        return [r for r in _GAP.split(text) if r] if _SPLIT_DIFFERS.search(text) else text.split()

    def _renewed(self, more: int) -> None:
        """A table with room for ``more`` words; words that were met since the last one was begun are taken over, unless they fill more than half of it."""
        old, values = self.table, self.known
        kept = np.flatnonzero(self.met[: old.count])
        if len(kept) + more > WORDS_KEPT:
            kept = kept[:0]
        capacity = max(WORDS_KEPT, len(kept) + more)
        self.table, self.known = pieces.Table(capacity), np.empty(capacity, object)
        self.decimals, self.spelled, self.counts, self.shown_to = np.empty(capacity, object), np.empty(capacity, object), np.zeros(capacity, np.int64), 0
        self.table.add(old.first[kept], old.last[kept], old.size[kept])
        self.known[: len(kept)] = values[kept]
        self.met = np.zeros(capacity, bool)

    def _numbered(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The table's numbers of short pieces; new ones are learned."""
        keys = self.table.keys(low, starts, ends)
        number = self.table.find(*keys)
        new = np.flatnonzero(number < 0)
        if len(new):
            _, one = np.unique(np.rec.fromarrays([k[new] for k in keys]), return_index=True)
            if self.table.count + len(one) > self.table.capacity:
                self._renewed(len(np.unique(np.rec.fromarrays(keys))))
                return self._numbered(low, starts, ends)
            one = new[one]
            at = self.table.count
            self.table.add(*(k[one] for k in keys))
            words = [low[a:b].tobytes() for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)]
            self.known[at : at + len(one)] = [struct.pack(f"<{len(i)}I", *i) for i in self.word_ids(words)]
            number[new] = self.table.find(*(k[new] for k in keys))
        self.met[number] = True
        return number

    def _rare(self, keys: list[tuple[bool, bytes]]) -> list[bytes]:
        """The ids of long pieces (False, lower-cased) and of runs that are cut by character tables (True, as they are)."""
        if len(self.long) > WORDS_KEPT // 4:
            self.long = {}
        new = list({k for k in keys if k not in self.long})
        runs = [[raw] if not whole else [x for r in self._split(raw.decode()) for x in ([r] if r in self.special else self._cut(r))] for whole, raw in new]
        words = list({w for r in runs for w in r if isinstance(w, bytes)})
        ids_of = {w: struct.pack(f"<{len(i)}I", *i) for w, i in zip(words, self.word_ids(words), strict=True)}
        ids_of |= {name: struct.pack("<I", i) for name, i in self.special.items()}
        self.long |= {key: b"".join([ids_of[w] for w in run]) for key, run in zip(new, runs, strict=True)}
        return [self.long[k] for k in keys]

    def _looked_up(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Of a column's pieces: places and numbers of those in the table, places and ids of the others; where each text's pieces start."""
        low, starts, ends, owner, kind = pieces.cut(*utf8(column))
        short = (ends - starts <= pieces.TABLE_BYTES) & (kind != pieces.WHOLE)
        at, rare = np.flatnonzero(short), np.flatnonzero(~short)
        number = self._numbered(low, starts[at], ends[at])
        ids = self._rare([(bool(kind[k] == pieces.WHOLE), low[starts[k] : ends[k]].tobytes()) for k in rare])
        return at, number, rare, ids, np.searchsorted(owner, np.arange(len(column) + 1))

    def encoded(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of every text of a string column, as little-endian unsigned 32-bit numbers."""
        at, number, rare, ids, bounds = self._looked_up(column)
        every = np.empty(len(at) + len(rare), object)
        every[at], every[rare] = self.known[number], _objects(ids)
        every = every.tolist()
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield b"".join(every[a:b])

    def _spell(self, ids: bytes) -> tuple[bytes, bytes]:
        numbers = np.frombuffer(ids, "<u4").tolist()
        return " ".join(map(str, numbers)).encode(), " ".join([self.names[i] for i in numbers]).encode()

    def displayed(self, column: pa.Array) -> Iterator[tuple[int, bytes, bytes]]:
        """For every text the number of its ids, the ids as decimal numbers and the decoded text, both joined by one space."""
        at, number, rare, ids, bounds = self._looked_up(column)
        new = slice(self.shown_to, self.table.count)
        both = [self._spell(i) for i in self.known[new]]
        self.decimals[new], self.spelled[new] = _objects([x for x, _ in both]), _objects([x for _, x in both])
        self.counts[new] = [len(i) // 4 for i in self.known[new]]
        self.shown_to = self.table.count
        shown = [self._spell(i) for i in ids]
        counts = np.empty(len(at) + len(rare), np.int64)
        counts[at], counts[rare] = self.counts[number], [len(i) // 4 for i in ids]
        totals = np.r_[0, np.cumsum(counts)]
        totals = (totals[bounds[1:]] - totals[bounds[:-1]]).tolist()
        if not counts.all():  # a run of characters that are no piece
            bounds = np.r_[0, np.cumsum(counts > 0)][bounds]
        texts = []
        for table, own in ((self.decimals, [x for x, _ in shown]), (self.spelled, [x for _, x in shown])):
            every = np.empty(len(at) + len(rare), object)
            every[at], every[rare] = table[number], _objects(own)
            texts.append(every[counts > 0].tolist())
        for n, a, b in zip(totals, bounds, bounds[1:], strict=False):
            yield n, b" ".join(texts[0][a:b]), b" ".join(texts[1][a:b])

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(next(self.encoded(pa.array([text], pa.string()))), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by one space, as the library does for a file without a decoder."""
        return " ".join(self.names[i] for i in ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column_name: str = "text") -> DataFrame:
    """Digest of every text's encoding and decoding: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    One row for each row, in one pass without a shuffle.  Null and empty texts have no tokens and the digest of the empty string;
    a null id stays null; repeated rows are repeated; other columns are ignored.  ``path`` must exist on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for part in slices(batch):
                counts, ids, decoded = [], [], []
                for n, numbers, tokens in enc.displayed(part.column("text")):
                    counts.append(n)
                    ids.append(hashlib.sha256(numbers).hexdigest())
                    decoded.append(hashlib.sha256(tokens).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), text_column(docs, text_column_name).alias("text"))
    return mapped(rows, run, SCHEMA)
