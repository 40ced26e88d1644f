"""Numeric, temporal and map expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_default(value: Column, default) -> Column:
    """The value, or a default for null."""
    return F.coalesce(value, F.lit(default))


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0.0 where the whole is not positive or null."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def epoch_seconds(value: Column) -> Column:
    """Epoch seconds as a zone-free UTC timestamp; null counts as the epoch."""
    return F.timestamp_seconds(or_default(value, 0)).cast("timestamp_ntz")


def epoch_millis(value: Column) -> Column:
    """Epoch milliseconds as a zone-free UTC timestamp."""
    return F.timestamp_millis(value).cast("timestamp_ntz")


def year_month(value: Column) -> Column:
    """``yyyyMM`` of a date or timestamp."""
    return F.date_format(value, "yyyyMM")


def lenient_timestamp(text: Column) -> Column:
    """ISO-like text as a timestamp: ``Z`` ignored, no zone means UTC, unreadable is null."""
    cleaned = F.trim(F.replace(text, F.lit("Z"), F.lit("")))
    return F.try_to_timestamp(F.nullif(cleaned, F.lit("")))


def compact_date(text: Column) -> Column:
    """``yyyyMMdd`` text as a timestamp at midnight UTC, unreadable is null."""
    valid = F.when(text.rlike(r"^\d{8}$"), text)
    return F.try_to_timestamp(valid, F.lit("yyyyMMdd"))


def sunday_of(day: Column) -> Column:
    """The Sunday that starts the week of a date."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def monday_of(day: Column) -> Column:
    """The Monday that starts the ISO week of a date."""
    return F.trunc(day, "week")


def partition_parts(day: Column) -> dict[str, Column]:
    """Path parts of a landed weekly snapshot: ``year``, unpadded ``month`` and ``week_of``."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "week_of": F.date_format(day, "yyyyMMdd"),
    }


def iso_now() -> Column:
    """Time of the query as ISO text."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def micros(value: Column) -> Column:
    """Microseconds since the epoch of a timestamp or zone-free timestamp."""
    return F.unix_micros(value.cast("timestamp"))


def seconds_apart(one: Column, two: Column) -> Column:
    """Absolute distance of two timestamps in seconds."""
    return F.abs(micros(one) - micros(two)) / F.lit(1_000_000)


def map_get(mapping: Column, key: Column, default) -> Column:
    """Map value, or a default for an absent key."""
    return F.coalesce(F.try_element_at(mapping, key), F.lit(default))


def map_bump(mapping: Column, key: Column, by: Column | int) -> Column:
    """Map with the counter of ``key`` moved by ``by``; counters stop at zero and leave the map."""
    by = by if isinstance(by, Column) else F.lit(by)
    value = F.greatest(F.lit(0), map_get(mapping, key, 0) + by)
    others = F.map_filter(mapping, lambda k, _: k != key)
    return F.when(value > 0, F.map_concat(others, F.create_map(key, value))).otherwise(others)


def padded(values: Column, size: int) -> Column:
    """Array filled with zeros up to ``size``; longer arrays stay whole."""
    return F.concat(values, F.array_repeat(F.lit(0), F.greatest(F.lit(0), F.lit(size) - F.size(values))))
