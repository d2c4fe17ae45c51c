"""Date and time functions and range predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_range(column: Column, lo, hi) -> Column:
    """Half-open range: `lo <= column < hi`, on the bare column so that it can be pushed down."""
    return (column >= F.lit(lo)) & (column < F.lit(hi))


def on_or_after(column: Column, day: dt.date) -> Column:
    """Timestamp compared with a date, which counts as midnight."""
    return column >= F.lit(day)


def add_days(moment: Column, days: Column) -> Column:
    """Timestamp moved by a whole number of days held in a column."""
    return moment + F.make_dt_interval(days)


def difference(start: Column, end: Column) -> Column:
    """`end - start`, NULL while the end is open."""
    return F.when(end.isNotNull(), end - start)


def whole_minutes(start: Column, end: Column) -> Column:
    """Full minutes from start to end, never below zero, NULL while the end is open."""
    elapsed = F.timestamp_diff("MINUTE", start, end)
    return F.when(end.isNotNull(), F.greatest(elapsed, F.lit(0).cast("long"))).cast("int")


def years_since(as_of: dt.date | None, year: Column) -> Column:
    """Calendar years from `year` to the year of `as_of` (today when it is None)."""
    now = F.current_date() if as_of is None else F.lit(as_of)
    return F.year(now) - year


_ZONED = r"(?i)([0-9:.]{4,}\s*([+-]\d{1,2}(:?\d{2})?|Z)|[A-Z]+/[A-Z_/]+|UTC|GMT)$"


def instant(text: Column, zone: str = "UTC") -> Column:
    """The instant that a text names: `2024-03-13 10:15:00+02`, with an offset, a `Z` or a region; without any it is in `zone`.

    The same in every session, whatever its time zone. NULL where the text is no time.
    """
    whole = F.trim(text)
    midnight = F.when(whole.rlike(r"^\d+-\d+-\d+$"), " 00:00:00").otherwise("")
    return F.when(whole.rlike(_ZONED), whole).otherwise(F.concat(whole, midnight, F.lit(f" {zone}"))).try_cast("timestamp")


def wall_time(moment: Column, zone: str) -> Column:
    """What clocks in `zone` show at an instant, as a timestamp without zone."""
    seconds = (F.unix_micros(moment).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
