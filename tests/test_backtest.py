from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from streakline.operators import backtest
from tests.conftest import rows, weekdays

DAY1 = date(2024, 1, 1)


@pytest.fixture(scope="module")
def make_days(spark):
    """{stock: [(key, close), ...]} to keyed days, one per calendar day."""

    def make(stocks):
        out = []
        for stock, series in stocks.items():
            run, before = 0, None
            for i, (key, close) in enumerate(series):
                run += key != before
                before = key
                out.append((stock, DAY1 + timedelta(days=i), Decimal(str(close)), key, run))
        return spark.createDataFrame(
            out, f"stock string, stock_valuation_date date, close_value decimal(12,4), {backtest.KEY} int, streak_run bigint"
        )

    return make


def _day(n):
    return DAY1 + timedelta(days=n - 1)


def test_worked_example(make_days):
    """Buy on day 2 at 9, sell on day 4 at 12; the last streak buys on day 6 at 8 and stays open."""
    days = make_days({"A": list(zip((4, 4, 5, 5, 4, 4, 4), (10, 9, 11, 12, 8, 8, 8), strict=True))})
    trades = backtest.streak_trades(backtest.signals(days))
    first, second = rows(trades, "purchased_date", "shares", "purchased_price", "sale_date", "sale_price")
    assert first == (_day(2), Decimal("1111.111"), Decimal("9.0000"), _day(4), Decimal("13333.3320000"))
    assert second == (_day(6), Decimal("1250.000"), Decimal("8.0000"), None, None)

    bought = rows(backtest.purchase_breakdown(trades, days))
    assert [r[1:8] for r in bought] == [
        (_day(1), _day(2), Decimal("9.0000"), Decimal("9.0000"), _day(2), Decimal("10.0000"), _day(1)),
        (_day(5), _day(6), Decimal("8.0000"), Decimal("8.0000"), _day(5), Decimal("8.0000"), _day(5)),
    ]
    assert [r[8] for r in bought] == [0.0, 0.0]
    (sold,) = rows(backtest.sale_breakdown(trades, days))
    assert sold[2] == _day(4) and sold[4:8] == (Decimal("12222.2210000"), _day(3), Decimal("13333.3320000"), _day(4))


def test_last_day_gives_no_signal_and_nulls_never_trade(spark, make_days):
    days = make_days({"A": [(4, 10), (4, 9)], "B": [(5, 1)]})
    assert backtest.next_day_lookup(days).where("next_date is null").count() == 2
    assert backtest.signals(days).count() == 1
    holes = days.withColumn("close_value", F.when(F.col("stock_valuation_date") != F.lit(_day(2)), F.col("close_value")))
    assert backtest.signals(holes).count() == 0


def test_sale_needs_both_days_over_the_cost(make_days):
    days = make_days({"A": [(4, 9), (4, 10), (5, 10), (5, 12), (5, 13)]})
    (trade,) = rows(backtest.streak_trades(backtest.signals(days)), "sale_signal_date", "sale_date", "sale_unit_price")
    assert trade == (_day(4), _day(5), Decimal("13.0000"))
    assert backtest.sell_candidates(days).count() == 2
    assert backtest.sell_candidates(days, Decimal(10)).count() == 1


def _brute_trades(series):
    """One day after the other: the first buy of each streak and its first better sale."""
    trades, bought, run = [], set(), 0
    for i, ((key, _), (next_key, cost)) in enumerate(zip(series, series[1:], strict=False)):
        run += i > 0 and series[i - 1][0] != key
        if key == 4 and next_key == 4 and run not in bought:
            bought.add(run)
            shares = (Decimal(10_000) / cost).quantize(Decimal("0.001"), ROUND_HALF_UP)
            sale = None
            for (k, v), (after, w) in zip(series[i + 1 :], series[i + 2 :], strict=False):
                if k == 5 and after == 5 and min(v, w) > cost:
                    sale = shares * w
                    break
            trades.append([cost, shares, sale])
    return trades


def _brute_trips(series):
    trips = []
    for i, ((key, _), (next_key, cost)) in enumerate(zip(series, series[1:], strict=False)):
        if key == 4 and next_key == 4:
            for j in range(i + 1, len(series) - 1):
                if series[j][0] == 5 and series[j + 1][0] == 5 and min(series[j][1], series[j + 1][1]) > cost:
                    trips.append((_day(i + 2), cost, _day(j + 2), series[j + 1][1]))
                    break
    return trips


@pytest.fixture(scope="module")
def random_stocks():
    chance = random.Random(11)
    stocks = {}
    for name in range(12):
        key, series = 4, []
        for _ in range(chance.randint(1, 150)):
            key = key if chance.random() < 0.6 else chance.choice((3, 4, 5))
            series.append((key, Decimal(chance.randint(100, 400)).scaleb(-1)))
        stocks[f"S{name}"] = series
    return stocks


@pytest.mark.parametrize("block", [32, 2, 1])
def test_trades_and_trips_against_brute_force(monkeypatch, make_days, random_stocks, block):
    """Also with blocks of sells much shorter than a stock's history."""
    monkeypatch.setattr(backtest, "BLOCK", block)
    signals = backtest.signals(make_days(random_stocks))
    trades = backtest.streak_trades(signals).orderBy("stock", "purchased_date").collect()
    trips = backtest.round_trips(signals).collect()
    for stock, series in random_stocks.items():
        ours = [[t.purchased_price, t.shares, t.sale_price] for t in trades if t.stock == stock]
        assert ours == _brute_trades(series)
        found = sorted((t.purchased_date, t.purchased_price, t.sale_date, t.sale_unit_price) for t in trips if t.stock == stock)
        assert found == _brute_trips(series)


def test_no_signals_no_trades(make_days):
    signals = backtest.signals(make_days({"A": [(1, 5), (2, 6), (3, 7)]}))
    assert backtest.streak_trades(signals).count() == 0
    assert backtest.round_trips(signals).count() == 0


def test_streak_days_and_running_extremes(spark, make_bars):
    calendar = weekdays("2024-01-01", 6)
    bars = make_bars([("A", d, p) for d, p in zip(calendar, (5, 7, 6, 1, 2, 3), strict=True)] + [("B", calendar[0], 1)])
    metric = spark.createDataFrame(
        [("A", 4, calendar[0], calendar[2], 3), ("A", 5, calendar[4], calendar[4], 1)],
        f"stock string, {backtest.KEY} int, start_date date, end_date date, day_length int",
    )
    inside = backtest.streak_days(bars, metric)
    assert rows(inside, "stock_valuation_date", backtest.KEY) == [(calendar[0], 4), (calendar[1], 4), (calendar[2], 4), (calendar[4], 5)]
    running = rows(
        backtest.streak_running_extremes(inside), "stock_valuation_date", "start_date", "end_date", "running_min_close", "running_max_close"
    )
    assert [(r[2], int(r[3]), int(r[4])) for r in running] == [
        (calendar[0], 5, 5),
        (calendar[1], 5, 7),
        (calendar[2], 5, 7),
        (calendar[4], 2, 2),
    ]
    assert {r[1] for r in running} == {calendar[0], calendar[4]}


def test_overlapping_streaks_are_an_error(spark, make_bars):
    calendar = weekdays("2024-01-01", 4)
    bars = make_bars([("A", d, 1) for d in calendar])
    metric = spark.createDataFrame(
        [("A", 4, calendar[0], calendar[3], 4), ("A", 5, calendar[1], calendar[1], 1)],
        f"stock string, {backtest.KEY} int, start_date date, end_date date, day_length int",
    )
    with pytest.raises(Exception, match="streaks overlap"):
        backtest.streak_days(bars, metric).collect()


def test_worst_rows(make_days):
    days = make_days({"A": [(4, 10), (4, 10), (4, 6), (5, 12), (5, 13), (5, 26)]})
    trades = backtest.streak_trades(backtest.signals(days))
    (worst,) = rows(backtest.max_drawdown(backtest.purchase_breakdown(trades, days)), "drawdown_pct")
    (best,) = rows(backtest.max_increment(backtest.sale_breakdown(trades, days)), "potential_increment_pct")
    assert worst == (40.0,) and best == (100.0,)


def test_stable_stocks(spark):
    def span(stock, key, *months):
        return [(stock, date(2020 + m // 12, m % 12 + 1, 15), key) for m in months]

    days = spark.createDataFrame(
        span("calm", 4, *range(40)) + span("wild", 5, *range(39)) + span("wild", 2, 39) + span("late", 1, 0) + span("late", 5, 36, 37),
        f"stock string, stock_valuation_date date, {backtest.KEY} int",
    )
    assert rows(backtest.stable_stocks(days), "stock", "is_stable") == [("calm", True), ("late", True), ("wild", False)]
