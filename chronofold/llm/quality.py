"""Quality rules: plain counts, and the divergence of a document's histograms from language references."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.common import SPACE, arrow, gram_hashes, mapped, slices, span_hashes, text_column, utf8, words
from chronofold.session import written

#: Common words of a reference.
COMMON_WORDS = 64
#: A document is compared by characters from so many characters on, by words from so many words on.
LEAST_CHARS, LEAST_WORDS = 200, 50
#: Jensen-Shannon distances (0 to 1) beyond which a document fails.
MOST_CHARS, MOST_WORDS = 0.25, 0.43
#: Languages a reference is kept for; more are refused, as references are broadcast.
MOST_LANGUAGES = 500
#: Distinct (language, word) counts that a task holds before it passes them on.
HELD_COUNTS = 1 << 20

SYMBOLS = "#*$%&|<>"


def _classes() -> np.ndarray:
    table = np.full(256, 8)  # other ASCII
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\n\v\f\r", b".,;:'\"?!()-", SYMBOLS.encode())):
        table[list(chars)] = k
    table[0xC0:] = 7  # first byte of a character beyond ASCII
    table[0x80:0xC0] = -1  # its further bytes are not counted
    return table


CHAR_CLASSES = 9
_CLASS = _classes()
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x classes: how many characters of each class."""
    n = len(offsets) - 1
    kind = _CLASS[data]
    owner = np.repeat(np.arange(n), np.diff(offsets))
    counted = kind >= 0
    return np.bincount(owner[counted] * CHAR_CLASSES + kind[counted], minlength=n * CHAR_CLASSES).reshape(n, CHAR_CLASSES)


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased runs of letters and the text each belongs to."""
    starts, ends, owner = words(data, offsets, _LETTER)
    return span_hashes(_LOWER[data], starts, ends), owner


def divergence(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of counts from a distribution; 1 for an empty row."""
    total = counts.sum(1, keepdims=True)
    p = counts / np.maximum(total, 1)
    m = (p + reference) / 2

    def against(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0).sum(1)

    return np.where(total[:, 0] > 0, np.sqrt(np.clip((against(p) + against(np.broadcast_to(reference, p.shape))) / 2, 0, 1)), 1.0)


@dataclass(frozen=True)
class Reference:
    """One language: shares of the character classes, hashes of common words in order, their shares and the rest's."""

    lang: str
    chars: np.ndarray
    words: np.ndarray
    shares: np.ndarray


def distances(data: np.ndarray, offsets: np.ndarray, references: list[Reference]) -> tuple[np.ndarray, ...]:
    """Distance by characters and by words from the nearest reference, and the number of letter words.

    With no reference every distance is 0: there is nothing to diverge from."""
    n = len(offsets) - 1
    if not references:
        return np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    chars = class_counts(data, offsets)
    hashes, owner = letter_words(data, offsets)
    by_chars = np.min([divergence(chars, r.chars) for r in references], 0)
    by_words = np.ones(n)
    for r in references:
        at = np.minimum(np.searchsorted(r.words, hashes), len(r.words) - 1)
        slot = np.where(r.words[at] == hashes, at, len(r.words))
        width = len(r.words) + 1
        by_words = np.minimum(by_words, divergence(np.bincount(owner * width + slot, minlength=n * width).reshape(n, width), r.shares))
    return by_chars, by_words, np.bincount(owner, minlength=n)


def base_counts(texts: list[str], data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` of every text."""
    n = len(offsets) - 1
    starts, ends, owner = words(data, offsets)
    owner_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    hashes = span_hashes(data, starts, ends)
    windows = gram_hashes(hashes, 5)
    inside = owner[: len(windows)] == owner[4:] if len(windows) else np.zeros(0, bool)
    at, keys, of = np.flatnonzero(inside), windows[inside], owner[: len(windows)][inside]
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = (keys[1:] == keys[:-1]) & (of[1:] == of[:-1])
    twice = at[order][same[1:] | same[:-1]]
    mark = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(mark, twice, 1)
    np.add.at(mark, twice + 5, -1)
    repeated = np.cumsum(mark)[:-1] > 0
    is_symbol, is_char = np.isin(data, np.frombuffer(SYMBOLS.encode(), np.uint8)), (data & 0xC0) != 0x80
    dup_lines = []
    for t in texts:
        seen, twins = set(), 0
        for line in t.split("\n"):
            if line.strip(" \t\n\v\f\r"):
                twins += line in seen
                seen.add(line)
        dup_lines.append(twins)
    return {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": np.bincount(owner_of_byte[is_char & ~SPACE[data]], minlength=n),
        "n_symbols": np.bincount(owner_of_byte[is_symbol], minlength=n),
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": np.bincount(owner[repeated], minlength=n),
    }


def learn_references(docs: DataFrame, lang: str = "lang", text: str = "text") -> list[Reference]:
    """A reference for every language of the labelled rows, counted over all of them.

    Each task adds up its own counts before the shuffle; only the classes and the :data:`COMMON_WORDS` most frequent words
    of each language reach the driver.  Equally frequent words are taken in the order of their hash.
    """
    rows = docs.select(docs[lang].cast("string").alias("lang"), text_column(docs, text).alias("text")).filter(F.col("lang").isNotNull())
    kind = {"lang": pa.string(), "word": pa.int64(), "slot": pa.int32(), "n": pa.int64()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        chars: dict[str, np.ndarray] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            owner, word, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((word, owner))
            owner, word, n = owner[order], word[order], n[order]
            new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (word[1:] != word[:-1])])
            return owner[new], word[new], np.add.reduceat(n, new)

        def word_rows() -> Iterator[pa.RecordBatch]:
            owner, word, n = merged()
            held.clear()
            for at in range(0, len(owner), 1 << 16):
                o = owner[at : at + (1 << 16)]
                yield arrow({"lang": np.array(names, object)[o], "word": word[at : at + (1 << 16)].view(np.int64), "slot": np.full(len(o), -1), "n": n[at : at + (1 << 16)]}, kind)

        for batch in batches:
            for part in slices(batch, limit=4 << 20):
                data, offsets = utf8(part.column("text"))
                langs = part.column("lang").to_pylist()
                for name in set(langs):
                    if name not in names:
                        names.append(name)
                number = np.array([names.index(x) for x in langs])
                sums = class_counts(data, offsets)
                for k in set(number.tolist()):
                    chars[names[k]] = chars.get(names[k], 0) + sums[number == k].sum(0)
                hashes, owner = letter_words(data, offsets)
                if len(hashes):
                    held.append((number[owner], hashes, np.ones(len(hashes), np.int64)))
                    held[:] = [merged()]
                    if len(held[0][0]) > HELD_COUNTS:
                        yield from word_rows()
        if held:
            yield from word_rows()
        for name, sums in chars.items():
            yield arrow({"lang": [name] * CHAR_CLASSES, "word": [0] * CHAR_CLASSES, "slot": range(CHAR_CLASSES), "n": sums}, kind)

    counts = mapped(rows, count, "lang string, word long, slot int, n long").groupBy("lang", "word", "slot").agg(F.sum("n").alias("n"))
    ranked = written(counts, "word-counts").withColumn("is_word", F.col("slot") < 0)
    # The rank is cut to its first places in each task before the shuffle.
    place = F.row_number().over(Window.partitionBy("lang", "is_word").orderBy(F.desc("n"), "word", "slot"))
    top = ranked.withColumn("place", place).filter(F.col("place") <= COMMON_WORDS)
    totals = {(r["lang"], r["is_word"]): r["n"] for r in ranked.groupBy("lang", "is_word").agg(F.sum("n").alias("n")).limit(2 * MOST_LANGUAGES + 1).collect()}
    if len(totals) > 2 * MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    out: list[Reference] = []
    found = top.toPandas()
    for name, own in found.groupby("lang", sort=True):
        chars = np.zeros(CHAR_CLASSES)
        of_chars, of_words = own[~own["is_word"]], own[own["is_word"]]
        chars[of_chars["slot"]] = of_chars["n"]
        if not chars.sum() or not len(of_words):
            continue
        hashes, n = of_words["word"].to_numpy().view(np.uint64), of_words["n"].to_numpy(float)
        order = np.argsort(hashes)
        total = totals[name, True]
        out.append(Reference(name, chars / chars.sum(), hashes[order], np.append(n[order], total - n.sum()) / total))
    return out


FIELDS = {
    "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(), "kept": pa.bool_(), "char_distance": pa.float64(), "word_distance": pa.float64(),
}


def _judged(docs: DataFrame, references: list[Reference], keep: tuple[str, ...], text: str) -> DataFrame:
    """Columns ``k0``, ``k1`` ... for those kept and the fields of :data:`FIELDS`; no outer name can clash with these."""
    shared = docs.sparkSession.sparkContext.broadcast(references)
    names = [f"k{i}" for i in range(len(keep))]
    source = f"k{keep.index(text)}" if text in keep else "text"
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names, strict=True)], *([] if text in keep else [docs[text].alias("text")]))
    kinds = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
             "base_failed": "boolean", "kept": "boolean", "char_distance": "double", "word_distance": "double"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, source):
                column = pc.fill_null(part.column(source).cast(pa.large_string()), "")
                data, offsets = utf8(column)
                got = base_counts(column.to_pylist(), data, offsets)
                by_chars, by_words, n_letter_words = distances(data, offsets, shared.value)
                length = pc.utf8_length(column).to_numpy(zero_copy_only=False)
                failed = (got["n_words"] < 10) | (100 * got["n_repeat_words"] > 20 * got["n_words"])
                far = (length >= LEAST_CHARS) & (by_chars > MOST_CHARS) | (n_letter_words >= LEAST_WORDS) & (by_words > MOST_WORDS)
                got |= {"base_failed": failed, "kept": ~failed & ~far, "char_distance": by_chars, "word_distance": by_words}
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *[pa.array(got[k], t) for k, t in FIELDS.items()]], names=[*names, *FIELDS])

    fields = ", ".join([*[f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names, strict=True)], *[f"{k} {t}" for k, t in kinds.items()]])
    return mapped(rows, run, fields)


def judged(docs: DataFrame, references: list[Reference], keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row with its counts, ``base_failed``, ``kept`` and the two distances.

    ``kept`` is false if ``base_failed`` (fewer than 10 words, or over a fifth of them in repeated 5-word windows), or if a long
    enough text lies too far from every reference by characters or by words.  A null text counts as empty: it has no words and
    fails.  Repeated rows get repeated verdicts; columns other than ``keep`` and the text are ignored.
    """
    out = _judged(docs, references, keep, text)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *FIELDS)


def accepted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that pass; references are learned from the rows themselves."""
    keep = tuple(docs.columns)
    out = _judged(docs, learn_references(docs), keep, text).filter("kept")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)])
