"""Language ID, quality rules, encoding, packing and fingerprints."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from chronofold.llm import bpe, langid, packing, pieces, quality, simhash
from chronofold.llm.common import gram_hashes, sliding_argmin, span_hashes, utf8, words
from tests.llm import cases

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_and_windows():
    data, offsets = utf8(pa.array(["a bc", None, " d\x0be ", "", "é\xa0f"], pa.string()))
    starts, ends, owner = words(data, offsets)
    assert [(int(o), data[s:e].tobytes().decode()) for s, e, o in zip(starts, ends, owner)] == [(0, "a"), (0, "bc"), (2, "d"), (2, "e"), (4, "é\xa0f")]
    rng = np.random.default_rng(1)
    for n, width in ((0, 3), (2, 3), (3, 3), (50, 7), (64, 8), (65, 1)):
        values = rng.integers(0, 9, n, dtype=np.uint64)
        assert sliding_argmin(values, width).tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(max(0, n - width + 1))]


def test_encoder_agrees_with_the_library():
    own, library = bpe.Encoder(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(5)
    pool = [*map(chr, range(0x20, 0x180)), *"\t\n\x1c\x85\xa0\u200b\u3000Σςİſ\u0301日한😀ำǅ½٣", "<|endoftext|>", "'re", "'LL"]
    samples = [*filter(None, cases.texts()), *("".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(1500)), "q" * 5000]
    for text in samples:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.ids(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_pieces_are_cut_as_by_the_pattern():
    pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\x85\p{L}\p{N}]+")
    rng = random.Random(1)
    pool = [c for c in map(chr, range(0x20, pieces.PLAIN_BELOW)) if pieces._KINDS[ord(c)] != pieces.WHOLE]
    pool += [*"\t\n\x1c\x85\xa0", "'re", "'LL", "'s", "'t'", "''d", "'v\xe9", "a", "b", "1"]
    for _ in range(200):
        some = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(20)]
        low, starts, ends, owner, kind = pieces.cut(*utf8(pa.array(some)))
        got = [[] for _ in some]
        for a, b, of in zip(starts, ends, owner, strict=True):
            got[of].append(low[a:b].tobytes().decode())
        assert all(g == pattern.findall(t.lower()) for t, g in zip(some, got, strict=True) if "<|" not in t)


def test_table_of_pieces():
    rng = np.random.default_rng(6)
    words = list({bytes(rng.integers(97, 100, int(rng.integers(1, 17))).astype(np.uint8)) for _ in range(4000)})
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    table = pieces.Table(len(words))
    keys = table.keys(data, starts, ends)
    assert (table.find(*keys) == -1).all()
    half = len(words) // 2
    table.add(*(k[:half] for k in keys))
    assert table.find(*keys).tolist() == [*range(half), *[-1] * (len(words) - half)]
    table.add(*(k[half:] for k in keys))
    assert table.find(*keys).tolist() == list(range(len(words)))


def test_merging_one_word_and_many_agree():
    own = bpe.Encoder(PATH)
    rng = random.Random(2)
    pieces = ["".join(rng.choice("thening é") for _ in range(rng.randrange(1, 60))).encode() for _ in range(300)]
    one = [bpe.merge_word([*own.of_byte[list(p[:-1])].tolist(), int(own.of_last[p[-1]])], lambda a, b: own.merges.get((a, b))) for p in pieces]
    assert own.word_ids(pieces) == one == packing.LibraryEncoder(PATH).word_ids(pieces)


def test_word_table_stays_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 50)
    own, library = bpe.Encoder(PATH), Tokenizer.from_file(PATH)
    for text in filter(None, cases.texts()):
        assert own.ids(text) == library.encode(text, add_special_tokens=False).ids
        assert next(own.displayed(pa.array([text])))[1].decode() == " ".join(map(str, own.ids(text)))


@pytest.mark.parametrize("repeated", [False, True])
def test_encoded_documents(spark, repeated):
    df = cases.frame(spark, repeated, null_id=True)
    library = Tokenizer.from_file(PATH)
    out = bpe.encode_documents(df, PATH)
    assert out.count() == df.count() and bpe.encode_documents(cases.empty(spark), PATH).count() == 0
    got = cases.by_id(out)
    for doc_id, text, *_ in cases.rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def _check_packing(out, capacity):
    rows = sorted(out.collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    at = {}
    for r in rows:
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(v <= capacity for v in at.values())
    return len(at), sum(at.values())


def test_packing(spark, monkeypatch):
    df = cases.frame(spark, repeated=True, null_id=True)
    library = Tokenizer.from_file(PATH)
    n, total = _check_packing(packing.packed(df, PATH), 4096)
    assert n == -(-total // 4096)
    monkeypatch.setattr(packing, "SHARD_PIECES", 16)
    small = packing.packed(df, PATH, capacity=100)
    n, total = _check_packing(small, 100)
    assert n <= math.ceil(total / 100) * 1.1 + 8
    pieces = {}
    for r in small.collect():
        pieces.setdefault(r["doc_id"], {})[r["piece"]] = r
    for doc_id, text, *_ in cases.rows():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want = [(n, at, len(ids[at : at + 100]), zlib.crc32(ids[at : at + 100].tobytes())) for n, at in enumerate(range(0, len(ids), 100))]
        assert [(n, r["start"], r["length"], r["ids_crc32"]) for n, r in sorted(pieces[doc_id].items())] == want
    assert packing.packed(cases.empty(spark), PATH).count() == 0


def test_search_empties_bins_and_keeps_items():
    rng = random.Random(4)
    for _ in range(40):
        sizes = [rng.randrange(1, 60) for _ in range(rng.randrange(1, 120))]
        bins = [[i] for i in range(len(sizes))]  # a poor start
        out = packing.emptied(bins, sizes, 100)
        assert sorted(i for b in out for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 100 for b in out)
        assert len(out) <= len(bins)
        fitted = packing.best_fit(sizes, 100)
        assert len(packing.emptied(fitted, sizes, 100)) <= len(fitted)
    # Best fit leaves three bins; one exchange of two for one leaves two.
    sizes = [5, 5, 4, 3, 3]
    assert len(packing.emptied([[0, 2], [1, 3], [4]], sizes, 10)) == 2


def test_pairs_of_all_documents_are_offered():
    rng = random.Random(5)
    for _ in range(50):
        own = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 60))]
        first, second = packing._offers(own, 100)
        sums = {*own, *(a + b for n, a in enumerate(own) for b in own[:n])}
        assert {*np.flatnonzero(first).tolist()} == sums and ((first + second)[list(sums)] == list(sums)).all()
        assert all(second[s] == 0 for s in own)
    # 200 documents of one bin, of which only the two smallest fill the gap that another bin has.
    sizes = [*[20] * 198, 2, 3, 3995]
    bins, fill = [list(range(200)), [200]], [3965, 3995]
    assert not packing._give_away(0, [1], bins, fill, sizes, 4000)
    assert fill == [sum(sizes[i] for i in b) for b in bins] == [3960, 4000]


def test_quality_counts_and_verdicts(spark):
    df = cases.frame(spark, repeated=True, null_id=True)
    references = quality.learn_references(df)
    assert [r.lang for r in references] == ["en", "fr"]
    out = quality.judged(df, references, ("doc_id", "score", "n"))
    assert out.count() == df.count()
    got = cases.by_id(out.select("doc_id", *quality.FIELDS))
    for doc_id, text, *_ in cases.rows():
        w = cases.WORD.findall(text or "")
        spots = {}
        for i in range(len(w) - 4):
            spots.setdefault(tuple(w[i : i + 5]), []).append(i)
        repeat = {k for v in spots.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if cases.WORD.search(x)]
        r = got[doc_id]
        want = (len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(repeat))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 10 or 100 * len(repeat) > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])
    assert quality.learn_references(cases.empty(spark)) == []
    assert quality.judged(cases.empty(spark), [], ("doc_id",)).count() == 0
    # Nothing to diverge from: the base rules decide.
    assert all(r["kept"] != r["base_failed"] for r in quality.judged(df, [], ("doc_id",)).collect())
    assert set(quality.accepted(df).columns) == set(df.columns)


def test_divergence_by_hand():
    counts, reference = np.array([[3.0, 1.0, 0.0], [0.0, 0.0, 0.0]]), np.array([0.25, 0.25, 0.5])
    p, m = [0.75, 0.25, 0.0], [0.5, 0.25, 0.25]
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    got = quality.divergence(counts, reference)
    assert abs(got[0] - math.sqrt((kl(p) + kl(reference)) / 2)) < 1e-12 and got[1] == 1


def test_junk_is_rejected_and_prose_kept(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    kept = quality.judged(docs, quality.learn_references(docs), ("doc_id",))
    both = kept.join(labels, "doc_id").filter("not base_failed").toPandas()
    assert both[both["quality"] == 1]["kept"].mean() > 0.97
    assert both[both["quality"] == 0]["kept"].mean() < 0.5


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = langid.identified(docs).toPandas().merge(docs.toPandas(), on="doc_id")
    held = out[out["held_out"]]
    assert (held["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in held["doc_id"]]).all()
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95
    odd = cases.frame(spark, repeated=True, null_id=True)
    got = langid.identified(odd)
    assert got.count() == odd.count()
    found = cases.by_id(got.filter("doc_id is not null"))
    for doc_id, text, *_ in cases.rows():
        r = found[doc_id]
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or "")) and 0 <= r["score"] <= 1
    assert langid.identified(cases.empty(spark)).count() == 0
    unlabelled = odd.withColumn("lang", odd["source"].substr(9, 9))
    assert {r["lang_pred"] for r in langid.identified(unlabelled.filter("lang is null")).collect()} == {"und"}
    assert langid.accepted(odd).columns == odd.columns


def test_naive_bayes_by_hand():
    weights = np.log(np.full((2, langid.BUCKETS), 1e-3))
    buckets, _ = langid.ngrams(["ab"])
    weights[1, buckets] = np.log(0.5)
    model = langid.Model(("aa", "bb"), weights, np.log([0.5, 0.5]))
    names, sure = model.predict(["ab", "1 2", "", "AB!"])
    assert names == ["bb", "und", "und", "bb"] and sure[1] == sure[2] == 0 and sure[0] > 0.99
    assert len(buckets) == 3  # a, b, ab


@pytest.mark.parametrize("repeated", [False, True])
def test_fingerprints(spark, repeated):
    df = cases.frame(spark, repeated)
    rows = sorted(cases.rows() + (cases.rows()[:5] if repeated else []), key=lambda r: (r[0], r[1] or ""))
    out = simhash.fingerprinted(df, every=3).collect()
    assert len(out) == len(rows) and simhash.fingerprinted(cases.empty(spark)).count() == 0
    got = {r["doc_id"]: r for r in out}
    values = {i: int(r["fingerprint"], 16) for i, r in got.items()}
    of_text = {}
    for (doc_id, text, *_), (_, after, *_) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        r = got[doc_id]
        of_text.setdefault(text, set()).add(r["fingerprint"])
        gone = len(text) // 4
        assert r["n_chars"] == len(text)
        if not repeated:
            assert r["edited_sha256"] == hashlib.sha256((text[: len(text) - gone] + after[:gone]).encode()).hexdigest()
        if doc_id % 3 == 0:
            assert r["n_near"] == sum((values[doc_id] ^ values[x[0]]).bit_count() <= simhash.RADIUS for x in rows) - 1
        else:
            assert r["n_near"] is None
    assert all(len(v) == 1 for v in of_text.values())


def test_block_tables_find_every_neighbour(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(63) for _ in range(30)]
    prints = list({*base, *(b ^ sum(1 << k for k in rng.sample(range(63), d)) for b in base for d in (1, 2, 3, 4))})
    df = spark.createDataFrame([(p, 1 + p % 3) for p in prints], "print long, n long")
    for radius in (1, 3):
        got = {r["print"]: r["n_near"] for r in simhash.neighbours(df, df, radius).collect()}
        assert got == {p: sum(1 + q % 3 for q in prints if (p ^ q).bit_count() <= radius) for p in prints}


MASK = (1 << 64) - 1


def _plain_mix(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & MASK
    return h ^ (h >> 31)


def test_fingerprints_equal_plain_votes():
    """Every term's bits are voted on one at a time; a term's number is the hash of its words alone, whatever the text around it."""
    several = [*filter(None, cases.texts()), "", "a " + "b" * 400 + " c d e f"]
    got = simhash.fingerprints(*utf8(pa.array(several)))
    for text, value in zip(several, got.tolist(), strict=True):
        found = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
        size = min(simhash.TERM_WORDS, len(found))
        votes = [0] * simhash.BITS
        for i in range(len(found) - size + 1 if size else 0):
            run = found[i : i + size]
            alone = [m[0].encode() for m in run]
            ends = np.cumsum([len(w) for w in alone])
            hashes = span_hashes(np.frombuffer(b"".join(alone), np.uint8), ends - [len(w) for w in alone], ends)
            term = int(gram_hashes(hashes, size)[0])
            weight = min(255, len(text[run[0].start() : run[-1].end()].encode()))
            for bit in range(simhash.BITS):
                votes[bit] += weight if term >> bit & 1 else -weight
        assert value == sum(1 << bit for bit, v in enumerate(votes) if v > 0)


def test_training_equals_plain_counts(spark):
    """Counts of n-grams letter by letter, smoothed; the sample takes all rows of a small table."""
    rows = [(i, t, ("en", "fr", None)[i % 3]) for i, t in enumerate(["Ab c", "été là", "zz", "ab. AB", None, "x1y", "", "É a", "c"])]
    rows.append(rows[0])
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("en", "fr")
    counts = np.zeros((2, langid.BUCKETS))
    for _, text, lang in rows:
        if lang is None:
            continue
        # One space stands for all that lies between letters, and after the last ones.
        plain = re.sub(r"[^\W\d_]+|.", lambda m: m[0] if m[0][0].isalpha() else "\0", (text or "").lower(), flags=re.S)
        plain = re.sub("\0+", " ", plain).lstrip(" ")
        for n in langid.ORDERS:
            for i in range(len(plain) - n + 1):
                gram = plain[i : i + n]
                if gram == " ":
                    continue
                h = n
                for c in gram:
                    h = (h * 0x110003 + ord(c)) & MASK
                counts[model.languages.index(lang), _plain_mix(h) % langid.BUCKETS] += 1
    expected = np.log((counts + langid.SMOOTHING) / (counts.sum(1, keepdims=True) + langid.SMOOTHING * langid.BUCKETS))
    assert np.allclose(model.weights, expected, atol=1e-12)
