"""Dates, timestamps without zone, durations and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of raw timestamps and dates, in the order they are tried.
# One-letter fields also accept values without a leading zero.
TIMESTAMP_FORMATS = ("M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss", "yyyy-M-d H:mm:ss", "yyyy/M/d H:mm:ss")
DATE_FORMATS = ("M/d/yyyy", "yyyy-M-d", "yyyy/M/d")
RAW_TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"
RAW_DATE_FORMAT = "MM/dd/yyyy"

# Spark's cast also reads a bare year or month as a date; a full day is asked for here.
_FULL_DAY = r"^\s*\d{4}-\d{1,2}-\d{1,2}"

NTZ = "timestamp_ntz"


def parse_timestamp(text: Column, formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> Column:
    """First format that fits, then an ISO cast; NULL when nothing fits."""
    trimmed = F.trim(text)
    attempts = [F.try_to_timestamp(trimmed, F.lit(fmt)).cast(NTZ) for fmt in formats]
    iso = F.when(text.rlike(_FULL_DAY), text.try_cast(NTZ))
    return F.coalesce(*attempts, iso)


def parse_date(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    trimmed = F.trim(text)
    attempts = [F.try_to_date(trimmed, fmt) for fmt in formats]
    iso = F.when(text.rlike(_FULL_DAY), text.try_cast("date"))
    return F.coalesce(*attempts, iso)


def _whole_seconds(ts: Column) -> Column:
    """Seconds since 1970, fractions cut off; free of the session time zone."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def signed_seconds(start: Column, end: Column) -> Column:
    """Second boundaries crossed between two timestamps without zone."""
    return _whole_seconds(end) - _whole_seconds(start)


def seconds_between(start: Column, end: Column) -> Column:
    """Non-negative duration in seconds; NULL when an end is missing or out of order."""
    seconds = signed_seconds(start, end)
    return F.when(seconds >= 0, seconds)


def year(ts: Column) -> Column:
    return F.year(ts)


def month(ts: Column) -> Column:
    return F.month(ts)


def weekday_sunday0(ts: Column) -> Column:
    return F.dayofweek(ts) - 1


def weekday_monday0(ts: Column) -> Column:
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts).isin(5, 6)


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def date_key(ts: Column) -> Column:
    """YYYYMMDD as a long."""
    day = ts.cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def month_start(ts: Column) -> Column:
    """First day of the month as a timestamp without zone."""
    return F.trunc(ts.cast("date"), "MM").cast(NTZ)


def month_label(year_col: Column, month_col: Column) -> Column:
    """``YYYY-MM``."""
    return F.format_string("%d-%02d", year_col, month_col)


def joined_label(*parts: Column, missing: str = "N/A", separator: str = " | ") -> Column:
    return F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit(missing)) for p in parts])


def raw_timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, RAW_TIMESTAMP_FORMAT)


def raw_date_text(ts: Column) -> Column:
    return F.date_format(ts, RAW_DATE_FORMAT)


def add_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def now_utc() -> Column:
    return F.current_timestamp().cast(NTZ)
