"""Removal of word passages that a document with a smaller id already has, located by Aho-Corasick automata."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import gram_hashes, mapped, mixed, slices, span_hashes, utf8, words
from chronofold.llm.passages import LAST_ID, Segments, anchored, identified, kept_segments, merged_runs, repeated_units

WINDOW = 13
_GRAM = 4


def _at(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    return mixed(hashes[places])


@dataclass(frozen=True)
class WordCutter:
    """Segments of words: an anchor is the smallest hash of four words in a window."""

    window: int = WINDOW

    def __call__(self, data, offsets, wanted, hot) -> Segments:
        starts, ends, owner = words(data, offsets)
        hashes = span_hashes(data, starts, ends)
        grams = gram_hashes(hashes, _GRAM)
        first, windows, anchor = anchored(owner, grams, _GRAM, self.window)
        key = grams[anchor] & ~np.uint64(1)
        sizes = np.bincount(owner, minlength=len(offsets) - 1)
        before = np.cumsum(sizes) - sizes

        def segments(first, windows, key) -> Segments:
            last = first + windows + self.window - 2
            begin, end = (starts[first], ends[last]) if len(first) else (first, first)
            return Segments(owner[first], key, first - before[owner[first]], windows, begin, end, span_hashes(data, begin, end))

        if wanted is None:
            none = np.zeros(len(first), np.int64)
            return Segments(owner[first], key, none, windows, none, none, key)
        keep = kept_segments(Segments(owner[first], key, first, windows, first, first, key), wanted)
        first, windows, key = first[keep], windows[keep], key[keep]
        split = kept_segments(Segments(owner[first], key, first, windows, first, first, key), hot)
        # Windows of a hot anchor go alone, each under its own hash.
        each = np.repeat(first[split], windows[split]) + np.arange(windows[split].sum()) - np.repeat(np.cumsum(windows[split]) - windows[split], windows[split])
        plain, single = segments(first[~split], windows[~split], key[~split]), segments(each, np.ones(len(each), np.int64), np.zeros(len(each), np.uint64))
        # Their hashes are of the words, as white space between them does not count.
        own = {"key": _at(gram_hashes(hashes, self.window), each) & ~np.uint64(1), "code": _at(gram_hashes(mixed(hashes), self.window), each)}
        return Segments(*[np.concatenate((getattr(plain, f), own.get(f, getattr(single, f)))) for f in Segments.__dataclass_fields__])


def locate(keys: np.ndarray, pieces: list[bytes], ids: np.ndarray, window: int = WINDOW) -> list[tuple[list[int], list[int]]]:
    """For each piece the words covered by windows that a piece of a smaller id has too.

    Windows met under two ids are confirmed; an automaton of them, a shard of all confirmed passages, runs over the pieces and finds
    every occurrence, each with the smallest id of its window.
    """
    number: dict[bytes, int] = {}
    texts = [tuple([number.setdefault(w, len(number) + 1) for w in p.split()]) for p in pieces]
    alone = np.ones(len(keys), bool)
    alone[1:] &= keys[1:] != keys[:-1]
    alone[:-1] &= keys[1:] != keys[:-1]
    first: dict[tuple[int, ...], int] = {}
    confirmed: set[tuple[int, ...]] = set()
    for text, doc, single in zip(texts, ids.tolist(), alone.tolist(), strict=True):
        if single:
            continue  # one segment under its anchor: nothing else has its windows
        for i in range(len(text) - window + 1):
            phrase = text[i : i + window]
            known = first.setdefault(phrase, doc)
            if known != doc:
                confirmed.add(phrase)
                if doc < known:
                    first[phrase] = doc
    out: list[tuple[list[int], list[int]]] = [([], [])] * len(pieces)
    if not confirmed:
        return out
    shard = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    phrases = list(confirmed)
    for k, phrase in enumerate(phrases):
        shard.add_word(phrase, k)
    shard.make_automaton()
    for n, (text, doc, single) in enumerate(zip(texts, ids.tolist(), alone.tolist(), strict=True)):
        if single:
            continue
        starts, ends = [], []
        for last, k in shard.iter(text):
            if first[phrases[k]] < doc:
                if ends and last - window + 1 <= ends[-1]:
                    ends[-1] = last + 1
                else:
                    starts.append(last - window + 1)
                    ends.append(last + 1)
        out[n] = (starts, ends)
    return out


def _stay(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """For every row the starts and ends of its words, which of them stay, and its text."""
    data, offsets = utf8(part.column("text"))  # a null text is empty
    starts, ends, owner = words(data, offsets)
    bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
    whole = data.tobytes()
    for i, (later, runs) in enumerate(zip(part.column("later").to_pylist(), part.column("runs").to_pylist(), strict=True)):
        own = slice(bounds[i], bounds[i + 1])
        stay = np.ones(bounds[i + 1] - bounds[i], bool)
        if later:  # the same text has a smaller id: every window goes
            stay[:] = len(stay) < WINDOW
        else:
            for s, e in zip(*merged_runs(runs), strict=True):
                stay[s:e] = False
        yield starts[own] - offsets[i], ends[own] - offsets[i], stay, whole[offsets[i] : offsets[i + 1]]


def _searched(docs: DataFrame, keep: tuple[str, ...], id_column: str, text: str) -> DataFrame:
    """``k0``, ``k1`` ... for the columns kept but the text, ``doc_id``, ``text`` and what of it is repeated (``later``, ``runs``)."""
    info = repeated_units(identified(docs, id_column, text), WordCutter(), locate, same_text=False)
    whole = docs.select(
        *[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce(docs[id_column].cast("long"), F.lit(LAST_ID)).alias("id"), docs[text].cast("string").alias("text")
    )
    joined = whole.withColumn("digest", F.unhex(F.md5(F.coalesce("text", F.lit(""))))).join(info, ["id", "digest"])
    doc_id = F.when(F.col("id") < LAST_ID, F.col("id")).alias("doc_id")
    return joined.select(*[f"k{i}" for i in range(len(keep))], doc_id, "text", (F.col("first_id") < F.col("id")).alias("later"), "runs")


def without_passages(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of every row.

    A word goes if a window of 13 words around it also starts in a row of a smaller id; windows are those of the input.  Null and empty
    texts have no words; texts under 13 words lose none; rows of equal id are no reason to remove from each other; a null id is larger
    than all others; repeated rows are repeated; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                total, gone, digests = [], [], []
                for starts, ends, stay, whole in _stay(part):
                    kept = [whole[s:e] for s, e in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)]
                    total.append(len(stay))
                    gone.append(len(stay) - len(kept))
                    digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    return mapped(_searched(docs, (), id_column, text), run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def trimmed(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: str = "n_chars") -> DataFrame:
    """The rows, with all their columns, without the words that :func:`without_passages` removes.

    White space before a removed run stays and that after it goes; a text that loses nothing is unchanged, a null one stays null.  ``size``, where there is
    such a column, is brought up to date.  A row goes if it has lost words and none is left.
    """
    keep = tuple(c for c in docs.columns if c != text)
    names = [f"k{i}" for i in range(len(keep))]
    fields = [f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts, empty, changed = [], [], []
                for own, (starts, ends, stay, whole) in zip(part.column("text"), _stay(part), strict=True):
                    empty.append(len(stay) > 0 and not stay.any())
                    changed.append(not stay.all())
                    if not changed[-1]:
                        texts.append(own.as_py())
                        continue
                    edge = np.flatnonzero(np.diff(np.r_[True, stay, True].astype(np.int8)))
                    pieces, at = [], 0
                    for first, after in zip(edge[::2], edge[1::2], strict=True):  # runs of removed words
                        pieces.append(whole[at : starts[first]])
                        at = starts[after] if after < len(starts) else len(whole)
                    texts.append(b"".join([*pieces, whole[at:]]).decode())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], pa.array(texts, pa.string()), pa.array(empty, pa.bool_()), pa.array(changed, pa.bool_())],
                    names=[*names, "trimmed", "empty", "changed"],
                )

    out = mapped(_searched(docs, keep, id_column, text), run, ", ".join([*fields, "trimmed string, empty boolean, changed boolean"])).filter("not empty")
    fresh = {text: F.col("trimmed")}
    if size in keep:
        at = F.col(f"k{keep.index(size)}")
        fresh[size] = F.when(F.col("changed"), F.char_length("trimmed").cast(docs.schema[size].dataType)).otherwise(at)
    return out.select(*[fresh[c].alias(c) if c in fresh else F.col(f"k{keep.index(c)}").alias(c) for c in docs.columns])
