from __future__ import annotations

import random
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from streakline.config import IndicatorParams
from streakline.families import HIGH_LOW
from streakline.operators import indicators, streaks
from streakline.plans.increments import StreakStore
from streakline.plans.marts import daily_alerts
from streakline.streaming.streaks import closed_day_bars, flush, last_batch, start_streaks
from tests.conftest import rows, weekdays

PARAMS = IndicatorParams(band_rows=5, short_rows=2, long_rows=6)
BARS = "stock string, stock_valuation_date date, close_value decimal(12,4)"


def _run(stream, store, checkpoint, alerts_path=None):
    query = start_streaks(stream, store, checkpoint, alerts_path)
    query.awaitTermination()
    return query


def test_files_arriving_over_several_runs(spark, make_bars, tmp_path):
    """Three files, one per micro-batch; the third arrives after a restart."""
    chance = random.Random(5)
    calendar = weekdays("2024-01-01", 15)
    all_rows = [(s, d, chance.randint(1, 30)) for s in "AB" for d in calendar]
    bars = make_bars(all_rows).select("stock", "stock_valuation_date", "close_value")
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    store = StreakStore(spark, str(tmp_path / "store"), (HIGH_LOW,), PARAMS)

    def land(days):
        bars.where(F.col("stock_valuation_date").isin(days)).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)

    def stream():
        return spark.readStream.schema(BARS).option("maxFilesPerTrigger", 1).parquet(source)

    land(calendar[:6])
    land(calendar[6:7])
    first = _run(stream(), store, checkpoint)
    assert last_batch(first) == 1
    land(calendar[7:])
    second = _run(stream(), store, checkpoint, str(tmp_path / "alerts"))
    assert last_batch(second) == 2
    whole = indicators.classified(bars, PARAMS)
    alerts = spark.read.text(str(tmp_path / "alerts" / "batch=2"))
    assert rows(alerts) == rows(daily_alerts(streaks.metric_full(whole, HIGH_LOW)))
    assert rows(store.metric(HIGH_LOW, 2)) == rows(streaks.metric_full(whole, HIGH_LOW))
    assert rows(store.days(2).drop("stddev_90")) == rows(whole.drop("stddev_90"))


def test_only_closed_days_become_bars(spark, tmp_path):
    start = datetime(2024, 1, 1, 12)
    ticks = [(i, "A", start + timedelta(hours=6 * i), float(i)) for i in range(12)]
    df = spark.createDataFrame(ticks, "id bigint, symbol string, ts timestamp, price double")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    bars = closed_day_bars(stream, F.col("symbol"), "ts", F.col("price"), F.col("id"))
    store = StreakStore(spark, str(tmp_path / "store"), (HIGH_LOW,), PARAMS)
    query = _run(bars, store, str(tmp_path / "checkpoint"))
    closes = rows(store.days(last_batch(query)), "stock_valuation_date", "stock_value")
    # Ticks run from 1 January 12:00 to 4 January 06:00; the last one of a day closes it.
    assert [(d.day, int(v)) for d, v in closes] == [(1, 1), (2, 5), (3, 9)]
    last = flush(store, last_batch(query), df, F.col("symbol"), "ts", F.col("price"), F.col("id"))
    closes = rows(store.days(last), "stock_valuation_date", "stock_value")
    assert [(d.day, int(v)) for d, v in closes] == [(1, 1), (2, 5), (3, 9), (4, 11)]


def test_alerts_of_changed_streaks_only(spark, make_bars, tmp_path):
    """A stays in its bucket, B leaves it, C is new."""
    calendar = weekdays("2024-01-01", 3)
    first = [(s, d, c) for s in "AB" for d, c in zip(calendar, (1, 100), strict=False)]
    second = [("A", calendar[2], 99), ("B", calendar[2], 5), ("C", calendar[2], 7)]
    source, alerts = str(tmp_path / "in"), str(tmp_path / "alerts")
    store = StreakStore(spark, str(tmp_path / "store"), (HIGH_LOW,), PARAMS)
    for part in (first, second):
        make_bars(part).select("stock", "stock_valuation_date", "close_value").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(BARS).parquet(source)
        query = start_streaks(stream, store, str(tmp_path / "checkpoint"), alerts, changed_only=True)
        query.awaitTermination()
    told = [sorted(r["value"].split('"stock":"')[1][0] for r in spark.read.text(f"{alerts}/batch={n}").collect()) for n in (0, 1)]
    assert told == [["A", "B"], ["B", "C"]]
