"""Streaks: maximal runs of days a stock spends in one bucket.

Grouping by (stock, run) follows the windows' partitioning by stock, so the
streaks of freshly classified days need no shuffle of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streakline.families import BucketFamily
from streakline.functions.calendar import calendar_length
from streakline.functions.keys import surrogate_id
from streakline.operators.indicators import by_day
from streakline.sources.dims import dim


def streaks(days: DataFrame, family: BucketFamily) -> DataFrame:
    """First day, last day and calendar length of each run; days without a bucket are in none."""
    return (
        days.where(F.col(family.bucket_column).isNotNull())
        .groupBy("stock", family.run_column, family.bucket_column)
        .agg(F.min("stock_valuation_date").alias("start_date"), F.max("stock_valuation_date").alias("end_date"))
        .withColumn("day_length", calendar_length(F.col("start_date"), F.col("end_date")))
    )


def with_key(df: DataFrame, family: BucketFamily, keep_missing: bool = False) -> DataFrame:
    """Adds the bucket's dimension id. A name the dimension lacks is an error. Rows without a
    bucket are left out, or kept without an id (``keep_missing``)."""
    ids = dim(df.sparkSession, family).select(F.col("id").alias("_id"), F.col("bucket_name").alias(family.bucket_column))
    named = F.col(family.bucket_column).isNotNull()
    unknown = F.concat(F.lit(f"{family.dim} lacks "), family.bucket_column)
    key = F.when(named & F.col("_id").isNull(), F.raise_error(unknown).cast("int")).otherwise(F.col("_id"))
    rows = df if keep_missing else df.where(named)
    return rows.join(F.broadcast(ids), family.bucket_column, "left").withColumn(family.key_column, key).drop("_id")


def metric_columns(df: DataFrame, family: BucketFamily) -> DataFrame:
    return df.select(
        surrogate_id(F.col("start_date"), F.col("stock")).alias("id"),
        "stock",
        family.key_column,
        "start_date",
        "end_date",
        "day_length",
    )


def metric_full(days: DataFrame, family: BucketFamily) -> DataFrame:
    """The family's mart, rebuilt from all classified days."""
    return metric_columns(with_key(streaks(days, family), family), family)


def streak_extremes(days: DataFrame, family: BucketFamily) -> DataFrame:
    """Streaks with the highest and lowest traded value and close, and trading days.

    ``days`` are classified with ``carry=("high_value", "low_value")``.
    """
    day = F.col("stock_valuation_date")
    return (
        days.where(F.col(family.bucket_column).isNotNull())
        .groupBy("stock", family.run_column, family.bucket_column)
        .agg(
            F.min(day).alias("start_date"),
            F.max(day).alias("end_date"),
            F.max("high_value").alias("high_value"),
            F.min("low_value").alias("low_value"),
            F.max("stock_value").alias("highest_close"),
            F.min("stock_value").alias("lowest_close"),
            F.count(F.lit(1)).cast("int").alias("trading_days"),
        )
        .withColumn("day_length", calendar_length(F.col("start_date"), F.col("end_date")))
    )


def bucket_record_max(days: DataFrame, family: BucketFamily) -> DataFrame:
    """Each day's value beside the highest value its bucket has seen so far."""
    bucket = (
        Window.partitionBy("stock", family.bucket_column)
        .orderBy("stock_valuation_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return days.select(
        "stock",
        "stock_valuation_date",
        family.bucket_column,
        "stock_value",
        F.max("stock_value").over(bucket).alias("bucket_record_max"),
    )


def bucket_summary(metric: DataFrame, family: BucketFamily) -> DataFrame:
    """How often and how long each stock stays in each bucket."""
    total = F.sum("day_length")
    return metric.groupBy("stock", family.key_column).agg(
        F.count(F.lit(1)).alias("streak_count"),
        total.alias("total_days"),
        (total.cast("double") / F.count(F.lit(1)).cast("double")).alias("average_days"),
        F.max("day_length").alias("longest_days"),
    )


def daily_tracking(bars: DataFrame) -> DataFrame:
    """Live bars with the previous close and the change since."""
    previous = F.lag("close_value").over(by_day())
    return bars.select(
        "stock",
        "stock_valuation_date",
        "open_value",
        "high_value",
        "low_value",
        "close_value",
        "volume_value",
        previous.alias("previous_close"),
        (F.col("close_value") - previous).alias("day_change"),
    )
