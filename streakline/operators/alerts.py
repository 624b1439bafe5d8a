"""Alerts read from the streak marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streakline.families import HIGH_LOW, BucketFamily
from streakline.operators.cleaning import newest_per_key


def latest_streak_alerts(metric: DataFrame, family: BucketFamily = HIGH_LOW) -> DataFrame:
    """The newest streak of every stock."""
    latest = newest_per_key(metric, [F.col("stock")], [F.desc("start_date")])
    return latest.select("stock", family.key_column, "start_date", "end_date", "day_length")


def bucket_break_events(metric: DataFrame, family: BucketFamily = HIGH_LOW) -> DataFrame:
    """The days on which a stock left one bucket for another, and in which direction."""
    order = Window.partitionBy("stock").orderBy("start_date")
    previous = F.lag(family.key_column).over(order)
    events = metric.select(
        "stock",
        F.col("start_date").alias("event_date"),
        previous.alias("from_key"),
        F.col(family.key_column).alias("to_key"),
        F.lag("day_length").over(order).alias("left_after_days"),
    )
    direction = F.when(F.col("to_key") > F.col("from_key"), "up").otherwise("down")
    return events.where(F.col("from_key").isNotNull()).withColumn("direction", direction)


def alert_payload(alerts: DataFrame, family: BucketFamily = HIGH_LOW) -> DataFrame:
    """Alerts under the names a receiver expects."""
    return alerts.select(
        "stock", F.col(family.key_column).alias("valuation_key"), "start_date", "end_date", "day_length"
    )


def alert_json(payload: DataFrame) -> DataFrame:
    """One JSON object per alert in column ``value``."""
    return payload.select(F.to_json(F.struct(*payload.columns)).alias("value"))


def write_alerts(payload: DataFrame, path: str) -> None:
    alert_json(payload).write.mode("append").text(path)


def reconcile(expected: DataFrame, delivered: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Records whose number of copies differs between the two sides.

    Both sides are counted in one aggregation (NULLs compare equal), so
    repeated records combine before the shuffle.
    """
    both = expected.select(*columns, F.lit(1).alias("_e"), F.lit(0).alias("_d")).unionByName(
        delivered.select(*columns, F.lit(0).alias("_e"), F.lit(1).alias("_d"))
    )
    counts = both.groupBy(*columns).agg(F.sum("_e").alias("expected_copies"), F.sum("_d").alias("delivered_copies"))
    return counts.where(F.col("expected_copies") != F.col("delivered_copies"))
