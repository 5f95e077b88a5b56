"""Calendar expressions over an event-time column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(ts: str | Column) -> Column:
    """The calendar day."""
    return F.to_date(ts)


def month_start(ts: str | Column) -> Column:
    """The first day of the month, as a date."""
    return F.trunc(ts, "MM")


def year_month(ts: str | Column) -> Column:
    """202501 for January 2025."""
    return F.year(ts) * 100 + F.month(ts)


def months_between(start: str | Column, end: str | Column) -> Column:
    """Month boundaries crossed from ``start`` to ``end``."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def days_between(start: str | Column, end: str | Column) -> Column:
    """Midnights crossed from ``start`` to ``end``, not full 24-hour spans."""
    return F.date_diff(end, start)
