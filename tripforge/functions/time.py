"""Parsing and arithmetic of trip times, as Column expressions.

Spark patterns use single letters (`H` takes `8` and `08`). Values that do not
parse become null here; `operators.quality` tells them from missing ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spark patterns of the feeds' date formats.
DEFAULT_FORMATS = ("y-M-d H:m:s", "y-M-d H:m", "M/d/y H:m:s", "M/d/y H:m", "d/M/y H:m:s", "d/M/y H:m")


def strip_fraction(raw: Column) -> Column:
    """The text without its first `.digits`."""
    return F.regexp_replace(raw, r"^(.*?)\.\d+", "$1")


def parse_ntz(raw: Column, formats: tuple[str, ...]) -> Column:
    """The first format that fits, in order, whatever the session's zone; fractions and a leading weekday name are dropped."""
    plain = F.regexp_replace(strip_fraction(F.trim(raw)), r"^[A-Za-z]{3}, ", "")
    tried = [F.to_timestamp_ntz(F.when(F.try_to_timestamp(plain, F.lit(f)).isNotNull(), plain), F.lit(f)) for f in formats]
    return reduce(lambda a, b: F.coalesce(a, b), tried)


def parse_offset(raw: Column) -> Column:
    """`2019-04-02 22:18:47.9+02:00` or `… +0200` to the wall clock in UTC."""
    plain = strip_fraction(F.trim(raw))
    at = F.coalesce(F.try_to_timestamp(plain, F.lit("y-M-d H:m:sXXX")), F.try_to_timestamp(plain, F.lit("y-M-d H:m:s XX")))
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz"))


def to_local(raw: Column, zone: str, formats: tuple[str, ...] = ("y-M-d'T'H:m:s", "y-M-d H:m:s")) -> Column:
    """Times with an offset or `Z` to the named zone's wall clock; times without one are that already."""
    plain = strip_fraction(F.trim(raw))
    stamped = F.coalesce(*[F.try_to_timestamp(plain, F.lit(f + s)) for f in formats for s in ("XXX", "XX")])
    moved = F.convert_timezone(F.current_timezone(), F.lit(zone), stamped.cast("timestamp_ntz"))
    return F.coalesce(moved, parse_ntz(raw, formats))


def from_epoch_millis(raw: Column) -> Column:
    """Epoch milliseconds as text to the wall clock in UTC, whatever the session's zone; null for a text that is no number."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (raw.try_cast("bigint") / 1000).cast("decimal(18,6)"))


def combine_date_time(date: Column, time: Column, dates: tuple[str, ...], times: tuple[str, ...]) -> Column:
    """A date and a time column to one timestamp, over all pairs of formats; short times are padded to eight characters."""
    clock = F.trim(time)
    clock = F.when(F.length(clock) < 8, F.lpad(clock, 8, "0")).otherwise(clock)
    return parse_ntz(F.concat(F.trim(date), F.lit(" "), clock), tuple(f"{d} {t}" for d in dates for t in times))


def fix_two_digit_year(at: Column) -> Column:
    """Years below 100 are of this century."""
    return F.when(F.year(at) < 100, at + F.make_ym_interval(F.lit(2000), F.lit(0))).otherwise(at)


def plus_seconds(at: Column, seconds: Column) -> Column:
    return at + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def end_from_minutes(start: Column, minutes: Column) -> Column:
    """Start plus minutes given as text with thousands commas; other text raises under ANSI."""
    return plus_seconds(start, F.replace(minutes, F.lit(","), F.lit("")).cast("int") * 60)


def unify_seconds(seconds: Column, minutes: Column) -> Column:
    """Seconds where they parse, else minutes times 60."""
    return F.coalesce(seconds.try_cast("double"), minutes.try_cast("double") * 60)


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, negative if it ends before."""
    return F.timestamp_diff("SECOND", start, end)


def hms_to_seconds(raw: Column) -> Column:
    """`HH:MM:SS`, hours of any size, to seconds; fields beyond the third are ignored, a missing or odd one gives null."""
    parts = F.split(raw, ":")
    field = lambda i: F.get(parts, F.lit(i)).try_cast("bigint")
    return field(0) * 3600 + field(1) * 60 + field(2)


def calendar(at: Column) -> dict[str, Column]:
    """year, month, hour and dow (Monday 1 to Sunday 7)."""
    return {"year": F.year(at), "month": F.month(at), "hour": F.hour(at), "dow": F.weekday(at) + 1}


def file_period(name: Column) -> Column:
    """First day of the month that a file name states as YYYYMM, YYYY_MM, YYYY-MM or YY_MM; else null."""
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    wide = F.regexp_extract(base, r"(?<!\d)(20\d{2})[-_]?(0[1-9]|1[0-2])(?!\d)", 0)
    four = F.when(wide != "", F.concat(F.substring(wide, 1, 4), F.substring(wide, -2, 2)))
    short = F.regexp_extract(base, r"(?<!\d)(\d{2})_(0[1-9]|1[0-2])(?!\d)", 0)
    two = F.when(short != "", F.concat(F.lit("20"), F.substring(short, 1, 2), F.substring(short, -2, 2)))
    return F.to_date(F.coalesce(four, two), "yyyyMM")
