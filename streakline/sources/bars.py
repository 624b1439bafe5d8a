"""Daily bars: building them from ticks and scanning date ranges of them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline import schemas
from streakline.functions.calendar import next_business_day


def read_bars(spark: SparkSession, path: str, file_format: str = "parquet", **options: str) -> DataFrame:
    """Live bars from files of any format Spark reads, under the declared schema."""
    return spark.read.schema(schemas.LIVE).options(**options).format(file_format).load(path)


def daily_bars(
    ticks: DataFrame,
    stock: Column,
    day: Column,
    price: Column,
    sequence: Column,
    size: Column | None = None,
) -> DataFrame:
    """One bar per stock and day; ``sequence`` orders the ticks of a day and is unique in it.

    ``volume_value`` is the sum of ``size``, or the number of ticks. All
    aggregates combine before the shuffle, so the ticks of a hot stock leave
    each task as one row per day. Numbers as ``stock``, ``sequence`` and
    ``size`` keep the aggregation hash-based (a struct would make it sort).
    """
    volume = F.count(F.lit(1)) if size is None else F.sum(size)
    bars = ticks.groupBy(stock.alias("stock"), day.alias("stock_valuation_date")).agg(
        F.min_by(price, sequence).cast(schemas.PRICE).alias("open_value"),
        F.max(price).cast(schemas.PRICE).alias("high_value"),
        F.min(price).cast(schemas.PRICE).alias("low_value"),
        F.max_by(price, sequence).cast(schemas.PRICE).alias("close_value"),
        volume.cast(schemas.VOLUME).alias("volume_value"),
    )
    return bars.withColumn("stock", F.col("stock").cast("string"))


def in_range(df: DataFrame, column: str, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Rows with ``column`` (a date or timestamp) in ``[start, end)``; a bound left out does not
    restrict. The bare column is compared, so files outside the range are skipped."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) < F.lit(end).cast("date"))
    return df


def bars_in_range(
    bars: DataFrame,
    start: str | date | None = None,
    end: str | date | None = None,
    stocks: Sequence[str] | None = None,
) -> DataFrame:
    """Bars of ``stocks`` in ``[start, end)``; a bound or list left out does not restrict."""
    bars = in_range(bars, "stock_valuation_date", start, end)
    return bars if stocks is None else bars.where(F.col("stock").isin(list(stocks)))


def bars_full_history(bars: DataFrame, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """The whole history, or a back-fill window of it."""
    return bars_in_range(bars, start, end)


def bars_yesterday(bars: DataFrame, as_of: str | date) -> DataFrame:
    """The one-day slice before ``as_of``."""
    today = F.lit(as_of).cast("date")
    day = F.col("stock_valuation_date")
    return bars.where((day >= F.date_sub(today, 1)) & (day < today))


def last_saved_date(landing: DataFrame, column: str = "date") -> DataFrame:
    """One row, ``max_date``: the newest readable day of the landing table."""
    return landing.agg(F.max(F.col(column).try_cast("date")).alias("max_date"))


def next_business_day_slice(bars: DataFrame, last_saved: DataFrame, as_of: str | date | None = None) -> DataFrame:
    """Bars of the first day after ``last_saved.max_date`` that has bars, a weekday: the next
    weekday, or after a holiday the first one that follows.

    A last date after ``as_of`` (default: today) or a missing one is an error
    when the slice is evaluated.
    """
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    saved = F.col("max_date")
    checked = (
        F.when(saved.isNull(), F.raise_error(F.lit("no last date saved")).cast("date"))
        .when(saved > today, F.raise_error(F.lit("last date out of bounds")).cast("date"))
        .otherwise(next_business_day(saved))
    )
    earliest = last_saved.select(checked.alias("next_day")).scalar()
    ahead = bars.where((F.col("stock_valuation_date") >= earliest) & (F.weekday("stock_valuation_date") < 5))
    target = ahead.agg(F.min("stock_valuation_date")).scalar()
    return bars.where(F.col("stock_valuation_date") == target)


def require_rows(df: DataFrame, message: str = "no rows for the requested range") -> DataFrame:
    """Eager guard: raises on an empty frame after reading at most one row."""
    if df.isEmpty():
        raise ValueError(message)
    return df
