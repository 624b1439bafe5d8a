"""A calendar of trading days: weekdays without holidays, numbered, so that n days ahead is a lookup.

The calendar has a row per day of a stated range and grows with the range,
not with the data: its length is checked before it is broadcast.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: About 270 years; a row is some 20 bytes, so a broadcast calendar stays below 2 MB.
MOST_DAYS = 100_000


def trading_calendar(spark: SparkSession, first: date, last: date, holidays: DataFrame, holiday: str = "day") -> DataFrame:
    """Every ``day`` from ``first`` to ``last``, ``is_trading``, and ``ordinal``, the trading days up to and with that
    day. Repeated holidays, those on a weekend, outside the range or NULL count for nothing more."""
    if not 0 <= (last - first).days < MOST_DAYS:
        raise ValueError(f"a calendar has 1 to {MOST_DAYS} days")
    closed = holidays.select(F.col(f"`{holiday}`").cast("date").alias("day"), F.lit(True).alias("_closed")).distinct()
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    known = days.join(closed, "day", "left").withColumn("is_trading", (F.weekday("day") < 5) & F.col("_closed").isNull())
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return known.select("day", "is_trading", F.sum(F.col("is_trading").cast("int")).over(upto).cast("int").alias("ordinal"))


def _lookup(df: DataFrame, calendar: DataFrame, on: Column) -> DataFrame:
    return df.join(F.broadcast(calendar), on, "left")


def with_ordinal(df: DataFrame, day: str, calendar: DataFrame, name: str = "ordinal", trading: str = "is_trading") -> DataFrame:
    """Adds the day's ordinal and whether it is a trading day; NULL outside the calendar."""
    side = calendar.select(F.col("day").alias("_day"), F.col("ordinal").alias(name), F.col("is_trading").alias(trading))
    return _lookup(df, side, F.col(f"`{day}`") == F.col("_day")).drop("_day")


def with_day_ahead(df: DataFrame, day: str, n: int, calendar: DataFrame, name: str) -> DataFrame:
    """Adds the ``n``-th trading day after ``day``, before it for a negative ``n``; for 0 the day itself or, if it is none,
    the next trading day. NULL where the calendar ends before."""
    target = F.col("_ordinal") + n + F.when(F.col("_trading"), 0).otherwise(1 if n <= 0 else 0)
    placed = with_ordinal(df, day, calendar, "_ordinal", "_trading").withColumn("_target", target)
    ends = calendar.where("is_trading").select(F.col("ordinal").alias("_at"), F.col("day").alias(name))
    return _lookup(placed, ends, F.col("_target") == F.col("_at")).drop("_ordinal", "_trading", "_target", "_at")


def trading_days_between(df: DataFrame, start: str, end: str, calendar: DataFrame, name: str) -> DataFrame:
    """Adds the number of trading days after ``start`` up to and with ``end``, negative if ``end`` lies before."""
    placed = with_ordinal(with_ordinal(df, start, calendar, "_from", "_t1"), end, calendar, "_to", "_t2")
    return placed.withColumn(name, F.col("_to") - F.col("_from")).drop("_from", "_to", "_t1", "_t2")
