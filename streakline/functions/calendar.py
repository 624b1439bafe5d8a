"""Business-day arithmetic on DATE columns (``weekday``: Monday is 0)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def next_business_day(day: Column) -> Column:
    """First weekday after ``day``; Friday, Saturday and Sunday all lead to Monday."""
    ahead = F.when(F.weekday(day) == 4, 3).when(F.weekday(day) == 5, 2).otherwise(1)
    return F.date_add(day, ahead)


def prev_business_day(day: Column) -> Column:
    """Monday leads to Friday, every other day to the day before."""
    return F.date_sub(day, F.when(F.weekday(day) == 0, 3).otherwise(1))


def calendar_length(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end``, both counted."""
    return F.datediff(end, start) + 1


def instant_utc(wall_clock: Column) -> Column:
    """A TIMESTAMP_NTZ read as UTC wall clock, whatever the session's time zone."""
    return F.from_utc_timestamp(wall_clock.cast("timestamp"), F.current_timezone())


def utc_day(instant: Column) -> Column:
    """The UTC calendar day of a TIMESTAMP."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86_400).cast("int"))
