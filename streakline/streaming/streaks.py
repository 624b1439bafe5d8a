"""Streaks kept up to date by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streakline import schemas
from streakline.families import HIGH_LOW, BucketFamily
from streakline.functions.calendar import utc_day
from streakline.operators.alerts import alert_json, alert_payload
from streakline.plans.increments import StreakStore


def closed_day_bars(
    ticks: DataFrame, stock: Column, ts: str, price: Column, sequence: Column, delay: str = "1 hour"
) -> DataFrame:
    """Bars of UTC days the watermark has passed. ``ts`` is the TIMESTAMP column of the stream."""
    return _close_of_day(ticks.withWatermark(ts, delay), stock, ts, price, sequence)


def _close_of_day(ticks: DataFrame, stock: Column, ts: str, price: Column, sequence: Column) -> DataFrame:
    return (
        ticks.groupBy(F.window(ts, "1 day"), stock.alias("stock"))
        .agg(F.max_by(price, sequence).cast(schemas.PRICE).alias("close_value"))
        .select("stock", utc_day(F.col("window.start")).alias("stock_valuation_date"), "close_value")
    )


def flush(
    store: StreakStore, batch: int, ticks: DataFrame, stock: Column, ts: str, price: Column, sequence: Column
) -> int:
    """The end of a source that is finished: bars of the days the watermark never passed.

    ``ticks`` is the same source as a table; only days from the newest one the store holds are read.
    They become a batch of their own, whose number is returned; a day taken in already stays as it is.
    """
    newest = store.newest_day(batch)
    open_ticks = ticks if newest is None else ticks.where(F.col(ts) >= F.unix_seconds(F.lit(newest).cast("timestamp")).cast("timestamp"))
    store.apply(batch + 1, _close_of_day(open_ticks, stock, ts, price, sequence))
    return batch + 1


def start_streaks(
    bars: DataFrame,
    store: StreakStore,
    checkpoint: str,
    alerts_path: str | None = None,
    family: BucketFamily = HIGH_LOW,
    changed_only: bool = False,
) -> StreamingQuery:
    """Feeds each micro-batch of bars to ``store`` and stops when the source is exhausted.

    Restarting with the same checkpoint goes on where the last run ended; a
    batch in doubt is applied again under its old number. With
    ``alerts_path``, each batch also writes every stock's current streak, or
    only those that began with the batch (``changed_only``), as JSON lines to
    a folder of its own.
    """

    def take_in(batch: DataFrame, number: int) -> None:
        store.apply(number, batch)
        if alerts_path:
            current = store.opened(family, number) if changed_only else store.open_streaks(family, number)
            payload = alert_payload(current, family)
            alert_json(payload).write.mode("overwrite").text(f"{alerts_path}/batch={number}")

    return (
        bars.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def last_batch(query: StreamingQuery) -> int:
    """The number of the newest batch the query ran."""
    return max(progress.batchId for progress in query.recentProgress)
