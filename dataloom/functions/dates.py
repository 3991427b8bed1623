"""Date/time columns with the reference's rules (whole elapsed units, ISO
durations, format fallbacks). All Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("YEAR", "QUARTER", "MONTH", "WEEK", "DAY", "HOUR", "MINUTE", "SECOND", "MILLISECOND")


def between(unit: str, a: Column, b: Column) -> Column:
    """YearsBetween ... MilliSecondsBetween: ``a`` minus ``b`` in whole elapsed units,
    truncated toward zero (``timestampdiff(unit, b, a)``)."""
    unit = unit.upper()
    if unit not in UNITS:
        raise ValueError(unit)
    return F.timestamp_diff(unit, b, a)


def parse_first(s: Column, formats: list[str], epoch_fallback: bool = True) -> Column:
    """First format that parses wins; else a numeric text is read as epoch seconds."""
    tries = [F.try_to_timestamp(s, F.lit(f)).cast("timestamp_ntz") for f in formats]
    if epoch_fallback:
        tries.append(F.when(s.try_cast("long").isNotNull(), F.timestamp_seconds(s.try_cast("long")).cast("timestamp_ntz")))
    return F.coalesce(*tries)


# fixed value: ISO-8601 duration text PnYnMnDTnHnMnS (week form PnW too)
ISO_DURATION = r"^P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?$"


def iso_duration(text: Column) -> Column:
    """ISO-8601 duration text to a calendar interval (``make_interval``)."""
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(text, ISO_DURATION, i), F.lit("")).cast("int"), F.lit(0))
    secs = F.coalesce(F.nullif(F.regexp_extract(text, ISO_DURATION, 7), F.lit("")).cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    return F.make_interval(part(1), part(2), part(3), part(4), part(5), part(6), secs)


def add_duration(ts: Column, text: Column, sign: int = 1) -> Column:
    """AddDuration / SubtractDuration."""
    iv = iso_duration(text)
    return ts + iv if sign > 0 else ts - iv


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer").when(month.isin(9, 10, 11), "autumn").otherwise("unknown")
    )


def is_weekend(ts: Column) -> Column:
    """1 on Saturday / Sunday (Spark day of week 7 / 1), else 0."""
    return F.when(F.dayofweek(ts).isin(1, 7), 1).otherwise(0)


def floor_to(ts: Column, seconds: int) -> Column:
    u = F.unix_seconds(ts.cast("timestamp"))
    return F.timestamp_seconds(F.floor(u / seconds) * seconds).cast("timestamp_ntz")


def ceil_to(ts: Column, seconds: int) -> Column:
    u = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_seconds(F.ceil(u / (seconds * 1_000_000)) * seconds).cast("timestamp_ntz")
