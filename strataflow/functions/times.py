"""Date and time expressions on TIMESTAMP_NTZ, none of which depends on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: date, optional time of day, optional UTC offset.
ISO_PATTERN = r"^\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d{1,6})?)?(Z|[+-]\d\d:\d\d)?)?$"


def ntz(moment: dt.datetime) -> Column:
    """Literal TIMESTAMP_NTZ for a naive datetime, or for an aware one after moving it to UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


def hour_of(ts: Column) -> Column:
    """Start of the hour, as TIMESTAMP_NTZ (`date_trunc` would return a zoned timestamp)."""
    return F.timestamp_add("HOUR", F.hour(ts), F.to_date(ts).cast("timestamp_ntz"))


def month_of(ts: Column) -> Column:
    """First day of the month, as DATE: the partition value of month-partitioned facts."""
    return F.trunc(F.to_date(ts), "MM")


def _numeric_offset(text: Column) -> Column:
    return (F.length(text) > 16) & F.substring(text, -6, 1).isin("+", "-")


def has_offset(text: Column) -> Column:
    """Whether an ISO text ends in `Z` or `+hh:mm`."""
    return text.endswith("Z") | _numeric_offset(text)


def iso_to_utc(text: Column) -> Column:
    """ISO-8601 text to a UTC wall-clock TIMESTAMP_NTZ; NULL for anything else.

    Text without an offset is taken to be UTC. The pattern is needed because
    Spark's cast also accepts '2024' or '2024-11'; the offset is cut off and
    subtracted because a cast to TIMESTAMP_NTZ would read past it.
    """
    sign = F.when(F.substring(text, -6, 1) == "-", 1).otherwise(-1)
    hours, minutes = F.substring(text, -5, 2).try_cast("int"), F.substring(text, -2, 2).try_cast("int")
    numeric = _numeric_offset(text)
    suffix = F.when(text.endswith("Z"), 1).when(numeric, 6).otherwise(0)
    wall = text.substr(F.lit(1), F.length(text) - suffix).try_cast("timestamp_ntz")
    shift = F.when(numeric, sign * (hours * 60 + minutes)).otherwise(0)
    return F.when(F.regexp_like(text, F.lit(ISO_PATTERN)), F.timestamp_add("MINUTE", shift, wall))


def iso_or(text: Column, *fallbacks: Column) -> Column:
    """Parsed text, or the first non-null fallback."""
    return F.coalesce(iso_to_utc(text), *fallbacks)


def seconds_between(a: Column, b: Column) -> Column:
    """|a - b| in seconds with microsecond precision, as DOUBLE."""
    return F.abs(micros(a) - micros(b)) / F.lit(1e6)


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, read as UTC."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def days_before(as_of: dt.date, days: int) -> Column:
    """Midnight `days` days before `as_of`, as TIMESTAMP_NTZ: the lower bound of a trailing window."""
    return ntz(dt.datetime.combine(as_of, dt.time()) - dt.timedelta(days=days))


def within(ts: Column, start: dt.datetime, end: dt.datetime) -> Column:
    """Half-open range test start <= ts < end. Both bounds are literals, so Parquet can skip row groups."""
    return (ts >= ntz(start)) & (ts < ntz(end))


def on_day(ts: Column, day: dt.date) -> Column:
    """`DATE(ts) = day`, written as a range so that it is pushed down to the scan."""
    start = dt.datetime.combine(day, dt.time())
    return within(ts, start, start + dt.timedelta(days=1))


def months_touched(start: dt.datetime, end: dt.datetime) -> list[dt.date]:
    """First days of all months that the half-open range meets."""
    months, month = [], dt.date(start.year, start.month, 1)
    while dt.datetime.combine(month, dt.time()) < end:
        months.append(month)
        month = dt.date(month.year + month.month // 12, month.month % 12 + 1, 1)
    return months
