"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MESSAGE_TIME = "yyyy-MM-dd HH:mm:ss"


def duration_hours(start: str, end: str) -> Column:
    """Hours between two times, counted in whole seconds on both sides; may be negative."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600)


def year_month(c: str) -> Column:
    """The month as a number, 202403 for March 2024."""
    return F.year(c) * F.lit(100) + F.month(c)


def month_start(c: str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.col(c), "month")


def calendar_day(c: str) -> Column:
    return F.to_date(F.col(c))


def message_time(c: str) -> Column:
    """Text with seconds; smaller parts are cut off, not rounded."""
    return F.date_format(F.col(c), MESSAGE_TIME)


def parse_time(c: str, fmt: str | None = None, zone_free: bool = True) -> Column:
    """Time from text; NULL where it does not parse. ``zone_free`` picks TIMESTAMP_NTZ."""
    if fmt is None:
        return F.col(c).try_cast("timestamp_ntz" if zone_free else "timestamp")
    parsed = F.try_to_timestamp(F.col(c), F.lit(fmt))
    return parsed.cast("timestamp_ntz" if zone_free else "timestamp")
