"""String expressions.  Every function takes and returns columns; nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mean "yes" in directory flags.
TRUTHY = ("1", "yes", "true")

# Fixed value: a patch such as 25.22 or 14.3, optionally introduced by "patch".  `(?iU)` makes the
# word boundary and the digits follow Unicode rules.
PATCH_PATTERN = r"(?iU)\b(patch[- _]?)?(\d{2,2}\.\d{1,2})\b"

# Fixed value: how much of a body is searched for a patch when the file name has none.
PATCH_SAMPLE_CHARS = 2000

# Roman digits.
ROMAN_DIGITS = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def blank_to_null(value: Column) -> Column:
    """Empty string as null."""
    return F.nullif(value, F.lit(""))


def first_filled(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(v) for v in values])


def yes_no(value: Column) -> Column:
    """'Yes' for an affirmative flag, 'No' for anything else including null."""
    affirmative = F.lower(F.trim(value)).isin(*TRUTHY)
    return F.when(affirmative, "Yes").otherwise("No")


def page_url(base: str, page: Column) -> Column:
    """Wiki address of a page name: spaces become underscores, the rest is percent-encoded
    except letters, digits and ``_.-~/``."""
    encoded = F.url_encode(F.replace(page, F.lit(" "), F.lit("_")))
    for form_encoded, percent in (("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(form_encoded), F.lit(percent))
    return F.concat(F.lit(base), encoded)


def comma_list(value: Column) -> Column:
    """Comma-separated text as an array without empty items; null for null or empty text."""
    items = F.filter(F.split(value, ","), lambda item: item != "")
    return F.when(blank_to_null(value).isNotNull(), items)


def patch_of(version: Column) -> Column:
    """First two parts of a dotted version."""
    return F.substring_index(version, ".", 2)


def joined(separator: str, *values: Column) -> Column:
    """Values joined by a separator; null as soon as one is null (``concat_ws`` skips nulls)."""
    parts = [values[0]]
    for value in values[1:]:
        parts += [F.lit(separator), value]
    return F.concat(*parts)


def file_stem(uri: Column) -> Column:
    """Last path component without its last suffix.  A leading dot does not start a suffix."""
    name = F.regexp_extract(uri, r"([^/]*)/*$", 1)
    return F.regexp_replace(name, r"(?<=[^/])\.[^./]+$", "")


def patch_hint(uri: Column, body: Column) -> Column:
    """Patch named in the file name, else in the head of the body, else null."""
    in_name = F.regexp_extract(F.coalesce(file_stem(uri), F.lit("")), PATCH_PATTERN, 2)
    head = F.substring(F.coalesce(body, F.lit("")), 1, PATCH_SAMPLE_CHARS)
    in_body = F.regexp_extract(head, PATCH_PATTERN, 2)
    return first_filled(in_name, in_body)


def roman_to_int(numeral: Column) -> Column:
    """Value of a roman numeral; unknown characters count zero."""
    digits = F.create_map(*[F.lit(x) for pair in ROMAN_DIGITS.items() for x in pair])
    values = F.transform(
        F.reverse(F.filter(F.split(numeral, ""), lambda c: c != "")),
        lambda c: F.coalesce(F.try_element_at(digits, c), F.lit(0)),
    )
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("right"))
    return F.aggregate(
        values,
        start,
        lambda acc, v: F.struct(
            F.when(v < acc["right"], acc["total"] - v).otherwise(acc["total"] + v).alias("total"),
            v.alias("right"),
        ),
        lambda acc: acc["total"],
    )


def sha256(text: Column) -> Column:
    """Hexadecimal SHA-256 of the UTF-8 bytes."""
    return F.sha2(text, 256)


def reply_slots(reply: Column) -> Column:
    """Slots of the JSON object inside a free-text reply: trimmed non-blank ``teams``, ``event``
    (blank as null) and ``game_number`` when it is an integer.  Null when nothing parses."""
    block = blank_to_null(F.regexp_extract(reply, r"(?s)\{.*\}", 0))
    parsed = F.from_json(block, "teams array<string>, event string, game_number string, _bad string",
                         {"columnNameOfCorruptRecord": "_bad"})
    teams = F.filter(
        F.transform(F.coalesce(parsed["teams"], F.array().cast("array<string>")), lambda t: F.trim(t)),
        lambda t: t.isNotNull() & (t != ""),
    )
    # Only a JSON number counts; a quoted one is text.
    told = F.try_variant_get(F.try_parse_json(block), "$.game_number", "variant")
    is_number = F.schema_of_variant(told).isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    number = F.when(is_number & parsed["game_number"].rlike(r"^-?\d+$"), parsed["game_number"]).try_cast("int")
    slots = F.struct(
        teams.alias("teams"),
        blank_to_null(parsed["event"]).alias("event"),
        number.alias("game_number"),
    )
    return F.when(block.isNotNull() & parsed["_bad"].isNull(), slots)
