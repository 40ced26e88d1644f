"""Small tables with every awkward row, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, id string, digest string, text_key long, n long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}é"[: rng.randrange(3, 7)] for _ in range(n))


def texts() -> list[str | None]:
    rng = random.Random(7)
    base = [sentence(rng, rng.randrange(20, 220)) for _ in range(24)]
    near = []
    for t in base[:6]:
        w = t.split()
        w[len(w) // 2] = "changed"
        near.append(" ".join(w))
    shared = sentence(rng, 90)
    long = sentence(rng, 6000)
    return [
        *base, *near, base[0], base[0], base[1], None, None, "", " \n\t", "one", "two words", "x" * 900, "ab" * 450, "\x1c odd \x85 white\xa0space\u3000here",
        shared, f"head {shared} tail", f"{shared} {shared}", shared + "\n" + base[3], long, long + " more", "line a\nline a\nline b\n\nline a", "!!! ### $$$ %%%",
        "日本語のテキスト \U0001f600 emoji", "<|endoftext|> special <|startoftext|>", "0123 4567", *[sentence(rng, 12) for _ in range(6)],
    ]


def rows(first: int = 0) -> list[tuple]:
    out = [(first + i, t, ("en", "fr", None)[i % 3], "s", len(t or ""), 1.0, "k", "i", "d", 1, 2) for i, t in enumerate(texts())]
    random.Random(3).shuffle(out)
    return out


def frame(spark, repeated: bool = False, null_id: bool = False):
    data = rows()
    if repeated:
        data += data[:5]
    if null_id:
        data += [(None, texts()[2], "en", None, None, None, None, None, None, None, None), (None, "only here " * 9, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}
