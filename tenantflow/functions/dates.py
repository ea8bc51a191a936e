"""Date expressions. Every one takes its "now" as an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trailing_days_open(day: Column, as_of: dt.date, days: int = 7) -> Column:
    """The last ``days`` days with both ends left out, so today is excluded too."""
    start = as_of - dt.timedelta(days=days)
    return (day > F.lit(start)) & (day < F.lit(as_of))


def since_whole_days_ago(instant: Column, as_of: dt.date, days: int = 0) -> Column:
    """From midnight ``days`` days ago onward, midnight included; no upper end."""
    return instant >= F.lit(as_of - dt.timedelta(days=days))


def after_instant_days_ago(instant: Column, as_of: dt.datetime, days: int = 7) -> Column:
    """Strictly later than the same time of day ``days`` days ago; no upper end.

    The bound is written as text and cast, so that it takes the zone behaviour of
    the column it is compared with.
    """
    return instant > F.lit(str(as_of - dt.timedelta(days=days))).try_cast("timestamp_ntz")


def on_day(day: Column, as_of: dt.date) -> Column:
    return (day >= F.lit(as_of)) & (day < F.lit(as_of + dt.timedelta(days=1)))


def day_key(day: Column) -> Column:
    """``YYYYMMDD`` as an integer, from date parts: cheaper than formatting text."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def day_text(day: Column) -> Column:
    """``YYYYMMDD`` as text."""
    return day_key(day).cast("string")


def month_of_day_key(key: Column) -> Column:
    """Month number of a ``YYYYMMDD`` key; null where the key is no such number."""
    return F.substring(key.cast("string"), 5, 2).try_cast("int")


#: Date with a four- or two-digit year, and optionally the time of day.
_SOURCE_STAMP = r"^(\d{2})?\d{2}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2})?$"


def source_timestamp(text: Column) -> Column:
    """Timestamp from source text, two-digit years in this century; else null.

    The cast is several times cheaper than parsing with patterns, of which each
    accepts one width of the year only.
    """
    full = F.when(F.substring(text, 3, 1) == "-", F.concat(F.lit("20"), text)).otherwise(text)
    return F.when(text.rlike(_SOURCE_STAMP), full.try_cast("timestamp"))


def days_ago(
    now: Column, n: int, hour: int = 0, minute: int = 0, second: int = 0, microsecond: int = 0
) -> Column:
    """``n`` days before ``now``, at the given time of day (midnight by default)."""
    seconds = F.lit(f"{second}.{microsecond:06d}").cast(T.DecimalType(8, 6))
    midnight = F.date_sub(F.to_date(now), n).cast("timestamp_ntz")
    return midnight + F.make_dt_interval(F.lit(0), F.lit(hour), F.lit(minute), seconds)
