from __future__ import annotations

import random
import statistics
from decimal import Decimal

import pytest
from tests.conftest import rows, weekdays
from pyspark.sql import functions as F

from streakline.config import IndicatorParams
from streakline.families import AVERAGE, FAMILIES, HIGH_LOW
from streakline.operators import indicators, streaks


def _series(seed: int, count: int, nulls: float = 0.1):
    chance = random.Random(seed)
    return [None if chance.random() < nulls else Decimal(chance.randint(1, 10**9)).scaleb(-4) for _ in range(count)]


def _brute(values, params):
    """Indicators and buckets of one stock by looking at every frame anew."""
    out = []
    for i, value in enumerate(values):
        seen = [v for v in values[: i + 1] if v is not None]

        def frame(n, i=i):
            return [v for v in values[max(0, i - n + 1) : i + 1] if v is not None]

        low, high = (min(seen), max(seen)) if seen else (None, None)
        if low is not None and low == high:
            position = "mid_range"
        elif value is None or low is None:
            position = "near_record_high"
        else:
            position = "near_record_high"
            for bound, name in zip(params.position_bounds, HIGH_LOW.bucket_names, strict=False):
                if value - low <= bound * (high - low):
                    position = name
                    break
        band, short, long = frame(params.band_rows), frame(params.short_rows), frame(params.long_rows)
        average = sum(band) / len(band) if band else None
        deviation = statistics.stdev(band) if len(band) > 1 else None
        side = "within"
        if value is not None and deviation is not None:
            side = "below" if value < average - deviation else "above" if value > average + deviation else "within"
        bullish = bool(short) and sum(short) * len(long) > sum(long) * len(short)
        out.append((low, high, average, deviation, position, side, "bullish_alignment" if bullish else "bearish_alignment"))
    return out


PARAMS = IndicatorParams(band_rows=7, short_rows=3, long_rows=11)


@pytest.mark.parametrize("seed", [1, 2])
def test_classified_against_brute_force(make_bars, seed):
    days = weekdays("2020-01-01", 60)
    stocks = {name: _series(seed * 10 + i, 60) for i, name in enumerate("ABC")}
    stocks["C"][:3] = [None] * 3
    bars = make_bars([(s, d, v) for s, values in stocks.items() for d, v in zip(days, values, strict=True)])
    found = {(r.stock, r.stock_valuation_date): r for r in indicators.classified(bars, PARAMS).collect()}
    assert len(found) == 180
    for stock, values in stocks.items():
        runs = [0, 0, 0]
        before = None
        for day, expected in zip(days, _brute(values, PARAMS), strict=True):
            row = found[stock, day]
            low, high, average, deviation, *buckets = expected
            assert (row.minimum_value, row.maximum_value) == (low, high)
            assert row.avg_90 == (None if average is None else pytest.approx(float(average), rel=1e-12))
            assert row.stddev_90 == (None if deviation is None else pytest.approx(float(deviation), rel=1e-9))
            assert [row[f.bucket_column] for f in FAMILIES] == buckets
            runs = [n + (before is None or b != p) for n, b, p in zip(runs, buckets, before or buckets, strict=True)]
            assert [row[f.run_column] for f in FAMILIES] == runs
            before = buckets


def test_constant_prices_have_no_deviation_and_stay_within(make_bars):
    bars = make_bars([("A", d, "0.1") for d in weekdays("2020-01-01", 300)])
    days = indicators.classified(bars)
    assert days.where("stddev_90 > 0").count() == 0
    assert rows(days.select(AVERAGE.bucket_column).distinct()) == [("within",)]
    assert days.where("avg_short <> avg_long or avg_90 <> 0.1").count() == 0


def test_close_exactly_on_the_edge_is_within(make_bars):
    """10.1, 10.2, 10.3: the last close is the mean plus one deviation, which doubles miss."""
    bars = make_bars([("A", d, f"10.{i}") for i, d in enumerate(weekdays("2020-01-01", 3), 1)])
    assert rows(indicators.classified(bars).select(AVERAGE.bucket_column).distinct()) == [("within",)]


def test_first_day(make_bars):
    row = indicators.classified(make_bars([("A", "2020-01-01", 5)])).first()
    assert (row.highest_lowest_valuation, row.average_valuation, row.moving_avg_comparison) == (
        "mid_range",
        "within",
        "bearish_alignment",
    )
    assert row.stddev_90 is None and row.high_low_streak_run == 1


def test_null_closes(make_bars):
    days = weekdays("2020-01-01", 4)
    bars = make_bars(list(zip("AAAA", days, [None, 1, 2, None], strict=True)))
    kept = rows(indicators.classified(bars), "stock_valuation_date", HIGH_LOW.bucket_column)
    assert [bucket for _, bucket in kept] == ["near_record_high", "mid_range", "near_record_high", "near_record_high"]

    nulled = indicators.classified(bars, IndicatorParams(null_policy="null"))
    assert [b for _, b in rows(nulled, "stock_valuation_date", HIGH_LOW.bucket_column)] == [
        None,
        "mid_range",
        "near_record_high",
        None,
    ]
    assert streaks.streaks(nulled, HIGH_LOW).count() == 2


def test_min_periods(make_bars):
    bars = make_bars([("A", d, i) for i, d in enumerate(weekdays("2020-01-01", 5), 1)])
    days = indicators.classified(bars, IndicatorParams(min_periods=3))
    assert [r.avg_90 is None for r in days.orderBy("stock_valuation_date").collect()] == [True, True, False, False, False]


@pytest.mark.parametrize("cuts", [(30,), (1, 2, 40), (59,), (10, 11, 12, 13)])
def test_increment_equals_rebuild(make_bars, cuts):
    days = weekdays("2020-01-01", 60)
    stocks = {name: _series(i, 60) for i, name in enumerate("ABC")}
    stocks["C"][:35] = []  # a stock that starts later
    bars = make_bars([(s, d, v) for s, values in stocks.items() for d, v in zip(days[-len(values) :], values, strict=True)])
    everything = rows(indicators.classified(bars, PARAMS).drop("stddev_90"))

    day = F.col("stock_valuation_date")
    done = indicators.classified(bars.where(day < F.lit(days[cuts[0]])), PARAMS)
    for start, end in zip(cuts, (*cuts[1:], None), strict=True):
        new = bars.where(day >= F.lit(days[start]))
        new = new if end is None else new.where(day < F.lit(days[end]))
        done = done.unionByName(indicators.classify_increment(indicators.history_tail(done, PARAMS), new, PARAMS))
    assert rows(done.drop("stddev_90")) == everything


def test_tail_is_bounded_and_carries_state_once(make_bars):
    bars = make_bars([(s, d, i + 1) for s in "AB" for i, d in enumerate(weekdays("2020-01-01", 40))])
    tail = indicators.history_tail(indicators.classified(bars, PARAMS), PARAMS)
    assert tail.count() == 2 * PARAMS.history_rows
    assert tail.where(F.col("minimum_value").isNotNull()).count() == 2


def test_carried_columns(make_bars):
    days = indicators.classified(make_bars([("A", "2020-01-01", 5)]), carry=("high_value", "low_value"))
    assert days.columns == [*indicators.CLASSIFIED_COLUMNS, "high_value", "low_value"]
