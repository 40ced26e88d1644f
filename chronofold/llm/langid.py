"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import arrow, mapped, mixed, slices, text_column

#: Buckets of the n-gram hash; the matrix holds this many doubles for each language.
BUCKETS = 1 << 16
#: Lengths of the n-grams.
ORDERS = (1, 2, 3)
#: About so many documents of each language are learned from, chosen by a hash of the id and text.
SAMPLE_DOCS = 4000
#: The matrix is broadcast; more languages than this (250 MB) are refused.
MOST_LANGUAGES = 500
#: Added to every count.
SMOOTHING = 0.05
UNKNOWN = "und"

#: Bytes of text whose n-grams are held at once.
CHUNK = 1 << 19
_PARTS = 8
_COUNTS = {"lang": pa.string(), "bucket": pa.int32(), "n": pa.int64()}


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of lower-cased texts, and the text each belongs to, in text order per length.

    Whatever lies between letters counts as one space; a text without a letter has no n-grams.
    """
    low = [t.lower() for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(t) for t in low])
    letter = _letters()[codes]
    first = np.ones(len(codes), bool)
    first[1:] = owner[1:] != owner[:-1]
    after_letter = np.zeros(len(codes), bool)
    after_letter[1:] = letter[:-1]
    keep = letter | (after_letter & ~first)
    codes, owner = np.where(letter, codes, 32)[keep].astype(np.uint64), owner[keep]
    buckets, owners = [], []
    for n in ORDERS:
        count = max(0, len(codes) - n + 1)
        h = np.full(count, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x110003) + codes[k : k + count]
        same = owner[:count] == owner[n - 1 : n - 1 + count]
        if n == 1:
            same &= codes[:count] != 32
        buckets.append((mixed(h[same]) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[:count][same])
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass(frozen=True)
class Model:
    """``languages`` in order, ``weights`` (languages x buckets) log-probabilities, ``priors`` (languages) logs."""

    languages: tuple[str, ...]
    weights: np.ndarray
    priors: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The likeliest language and its posterior probability; :data:`UNKNOWN` and 0 without a letter."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        buckets, owners = ngrams(texts)
        scores = np.stack([np.bincount(owners, w[buckets], len(texts)) for w in self.weights]) + self.priors[:, None]
        seen = np.bincount(owners, minlength=len(texts)) > 0
        best = scores.argmax(0)  # the first of the ordered languages among equals
        sure = 1 / np.exp(scores - scores.max(0)).sum(0)
        names = [self.languages[b] if s else UNKNOWN for b, s in zip(best, seen, strict=True)]
        return names, np.where(seen, sure, 0.0).tolist()


def train(docs: DataFrame, id_column: str = "doc_id", lang: str = "lang", text: str = "text") -> Model:
    """Counts n-grams of labelled rows: a fixed-size sample of each language, whole texts.

    Rows with a null language do not take part; repeated rows count as often as they are there.  Counting is spread over
    a few tasks, summed by Spark and only the summed (language, bucket) counts reach the driver.
    """
    rows = docs.select(
        docs[lang].cast("string").alias("lang"), text_column(docs, text).alias("text"),
        F.xxhash64(docs[id_column], docs[text]).alias("pick"),
    ).filter(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return Model((), np.zeros((0, BUCKETS)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, int(min(1.0, SAMPLE_DOCS / n) * (1 << 20)))])
    sample = rows.filter(F.pmod("pick", F.lit(1 << 20)) < F.element_at(share, F.col("lang"))).repartition(_PARTS, "pick")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, limit=CHUNK):
                langs, texts = part.column("lang").to_pylist(), part.column("text").to_pylist()
                buckets, owners = ngrams(texts)
                for name in set(langs):
                    own = np.array([x == name for x in langs])[owners]
                    sums[name] = sums.get(name, 0) + np.bincount(buckets[own], minlength=BUCKETS)
        for name, n in sums.items():
            at = np.flatnonzero(n)
            yield arrow({"lang": [name] * len(at), "bucket": at, "n": n[at]}, _COUNTS)

    summed = mapped(sample.select("lang", "text"), count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = tuple(sorted(sizes))
    counts = np.zeros((len(names), BUCKETS))
    counts[[names.index(x) for x in summed["lang"]], summed["bucket"]] = summed["n"]
    weights = np.log(counts + SMOOTHING) - np.log(counts.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
    totals = np.array([sizes[x] for x in names], float)
    return Model(names, weights, np.log(totals / totals.sum()))


def _scored(docs: DataFrame, model: Model, keep: tuple[str, ...], text: str) -> DataFrame:
    """Columns ``k0``, ``k1`` ... for those kept, ``lang_pred`` and ``score``; no outer name can clash with these."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"k{i}" for i in range(len(keep))]
    # A text that is kept anyway travels once.
    source = f"k{keep.index(text)}" if text in keep else "text"
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names, strict=True)], *([] if text in keep else [docs[text].alias("text")]))
    fields = [f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names, strict=True)]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, source, CHUNK):
                found, sure = shared.value.predict([t or "" for t in part.column(source).cast(pa.string()).to_pylist()])
                columns = [*[part.column(n) for n in names], pa.array(found, pa.string()), pa.array(sure, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score"])

    return mapped(rows, score, ", ".join([*fields, "lang_pred string", "score double"]))


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row, with ``lang_pred`` and ``score``.  One pass, the model is broadcast."""
    out = _scored(docs, model, keep, text)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def accepted(docs: DataFrame, least_score: float = 0.5, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is known: not :data:`UNKNOWN`, and likelier than all others together.

    Learned from the labelled rows themselves; when no row has a language there is nothing to go by and every text with a letter stays."""
    model = train(docs)
    keep = tuple(docs.columns)
    if not model.languages:
        return docs.filter(docs[text].rlike(r"\p{L}"))
    out = _scored(docs, model, keep, text).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)])


def is_held_out(docs: DataFrame, id_column: str = "doc_id"):
    """Whether crc32 of the id as text leaves 1 when divided by 3; null for a null id."""
    return F.crc32(docs[id_column].cast("string").cast("binary")) % 3 == 1


def identified(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row.

    Learned from rows that are not held out.  A null, empty or letterless text is :data:`UNKNOWN` with score 0, as is every
    text when no row has a language.  A null id is not held out and not learned from; repeated rows are repeated; ties go
    to the first language in alphabetical order; other columns are ignored.
    """
    docs = docs.withColumn(id_column, docs[id_column].cast("long"))
    model = train(docs.filter(~is_held_out(docs, id_column)), id_column)
    out = predict(docs, model, (id_column,)).withColumnRenamed(id_column, "doc_id")
    held = F.coalesce(is_held_out(out, "doc_id"), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
