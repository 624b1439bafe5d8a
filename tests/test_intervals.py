"""Overlapping intervals and trading days against plain loops."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from streakline.operators.intervals import _blocks, days_in_intervals
from streakline.operators.trading_days import MOST_DAYS, trading_calendar, trading_days_between, with_day_ahead, with_ordinal

EPOCH = date(1970, 1, 1)


def test_overlapping_intervals(spark):
    """Nested, equal, touching, one-day, reversed and open ones, around the day numbered 0, one stock with most rows."""
    rnd = random.Random(4)
    day = lambda: EPOCH + timedelta(days=rnd.randrange(-70, 70))
    stocks = ["hot"] * 4 + ["a", None]
    days = [(rnd.choice(stocks), None if rnd.random() < 0.03 else day(), i) for i in range(200)]
    days += days[:5]
    spans = [(rnd.choice(stocks), day(), day(), i) for i in range(80)]
    spans += [(s, a, a, 100 + i) for i, (s, a, *_) in enumerate(spans[:10])] + spans[:3]
    spans += [("hot", None, EPOCH, 200), ("hot", EPOCH, None, 201), ("hot", date(1, 1, 1), date(9999, 12, 31), 202), ("a", date(1400, 1, 1), date(2500, 1, 1), 203)]
    got = days_in_intervals(
        spark.createDataFrame(days, "stock string, stock_valuation_date date, _size int").repartition(3),
        spark.createDataFrame(spans, "stock string, start_date date, end_date date, _block int").repartition(3),
    )
    assert got.columns == ["stock", "stock_valuation_date", "_size", "start_date", "end_date", "_block"]
    want = [(s, d, i, a, b, k) for s, d, i in days for t, a, b, k in spans if s is not None and s == t and d and a and b and a <= d <= b]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 1000


def test_long_intervals_have_few_blocks_and_days_two(spark):
    spans = spark.createDataFrame([(date(1400, 1, 1), date(2500, 1, 1)), (EPOCH, EPOCH)], "a date, b date")
    assert [r["n"] for r in spans.select(F.size(_blocks(F.col("a"), F.col("b"))).alias("n")).collect()] < [230, 2]
    found = days_in_intervals(spark.createDataFrame([], "stock string, stock_valuation_date date"), spark.createDataFrame([], "stock string, start_date date, end_date date"))
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("explode(") == 2 and "sequence(0, 20" not in plan


def test_no_range_join(spark):
    days = spark.createDataFrame([], "stock string, stock_valuation_date date")
    spans = spark.createDataFrame([], "stock string, start_date date, end_date date")
    found = days_in_intervals(days, spans)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and found.collect() == []
    with pytest.raises(ValueError, match="both sides"):
        days_in_intervals(days, spans.withColumnRenamed("end_date", "stock_valuation_date"))


def test_trading_days(spark):
    first, last = date(2024, 1, 1), date(2024, 3, 31)
    every = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    holidays = [date(2024, 1, 1), date(2024, 2, 14), date(2024, 2, 15), date(2024, 2, 15), date(2024, 2, 17), date(2030, 1, 1), None]
    trading = [d for d in every if d.weekday() < 5 and d not in holidays]
    calendar = trading_calendar(spark, first, last, spark.createDataFrame([(h,) for h in holidays], "day date"))
    got = {r["day"]: (r["is_trading"], r["ordinal"]) for r in calendar.collect()}
    assert got == {d: (d in trading, sum(t <= d for t in trading)) for d in every}

    df = spark.createDataFrame([(d,) for d in [*every, None, date(2023, 12, 31)]], "day date").withColumnRenamed("day", "traded")
    for n in (-7, -1, 0, 1, 4, 40):
        def ahead(d):
            if d is None or d < first:
                return None
            if n > 0:
                later = [t for t in trading if t > d]
                return later[n - 1] if len(later) >= n else None
            if n == 0:
                return next((t for t in trading if t >= d), None)
            before = [t for t in trading if t < d]
            return before[n] if len(before) >= -n else None

        found = with_day_ahead(df, "traded", n, calendar, "there").collect()
        assert {r["traded"]: r["there"] for r in found} == {d: ahead(d) for d in [*every, None, date(2023, 12, 31)]}, n
    pairs = df.withColumn("until", df.traded + 10)
    for r in trading_days_between(pairs, "traded", "until", calendar, "n").where("n is not null").collect():
        assert r["n"] == sum(r["traded"] < t <= r["until"] for t in trading)
    assert with_ordinal(df, "traded", calendar).count() == len(every) + 2
    with pytest.raises(ValueError, match="days"):
        trading_calendar(spark, first, first + timedelta(days=MOST_DAYS), df.withColumnRenamed("traded", "day"))
