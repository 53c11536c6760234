"""Filters written so that the Parquet scan can use them.

Bounds go in as text literals: Spark casts them to the column's own type once, while planning, and
the comparison with the bare column is pushed into the scan. A function around the column would not be.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(day: date | str) -> date:
    if isinstance(day, datetime):
        return day.date()
    return day if isinstance(day, date) else date.fromisoformat(day[:10])


def next_month(day: date) -> date:
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)


def month_number(day: date | str) -> int:
    day = as_date(day)
    return day.year * 100 + day.month


def equals(c: str, value) -> Column:
    return F.col(c) == F.lit(value)


def in_interval(c: str, low, high) -> Column:
    """Closed interval. A date as upper bound means the midnight that begins that day."""
    return F.col(c).between(F.lit(str(low)), F.lit(str(high)))


def _half_open(c: str, low: date, high: date) -> Column:
    return (F.col(c) >= F.lit(str(low))) & (F.col(c) < F.lit(str(high)))


def on_day(c: str, day: date | str) -> Column:
    day = as_date(day)
    return _half_open(c, day, day + timedelta(days=1))


def in_month(c: str, day: date | str) -> Column:
    """The month that contains ``day``."""
    first = as_date(day).replace(day=1)
    return _half_open(c, first, next_month(first))


def in_year(c: str, year: int) -> Column:
    return _half_open(c, date(year, 1, 1), date(year + 1, 1, 1))


def between_months(c: str, low, high, month_column: str = "year_month") -> Column:
    """``in_interval`` plus the bound it implies on a derived month partition, which prunes folders."""
    months = F.col(month_column).between(month_number(low), month_number(high))
    return months & in_interval(c, low, high)


def greater_than(c: str, value) -> Column:
    """``c > value``; NULL and NaN are not greater (Spark alone would rank NaN above all numbers)."""
    return (F.col(c) > F.lit(value)) & ~F.isnan(F.col(c))


def contains_text(c: str, part: str) -> Column:
    """Case-insensitive containment; ``%`` and ``_`` in the part are ordinary characters."""
    return F.contains(F.lower(c), F.lit(part.lower()))
