"""From live bars to everything that is read: marts, snapshot, alerts, back-test."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from streakline.config import IndicatorParams
from streakline.families import FAMILIES, HIGH_LOW
from streakline.operators import alerts, backtest, cleaning, indicators, streaks
from streakline.session import scratch_path


@dataclass(frozen=True)
class Ingested:
    """``live``: the new live table. ``late``: bars up to their stock's newest day that live does not hold, or holds with
    other values. ``rejected``: texts that do not cast and dates that are missing. Nothing that lands is in none of them."""

    live: DataFrame
    late: DataFrame
    rejected: DataFrame


def ingest(landing: DataFrame, tickers: tuple[str, ...], live: DataFrame | None = None) -> Ingested:
    """Landing rows to the new live table: dedup, melt, type, filter by high-water mark, merge."""
    return ingest_long(cleaning.unpivot_live(cleaning.dedup_by_date(landing), tickers), live)


def ingest_long(long_text: DataFrame, live: DataFrame | None = None) -> Ingested:
    """The same from text rows of one stock and day each, for any number of stocks."""
    bars, rejected = cleaning.typed_bars(long_text), cleaning.rejected_rows(long_text)
    if live is None:
        return Ingested(bars, bars.limit(0), rejected)
    return Ingested(cleaning.upsert_live(live, bars, allow_corrections=False), cleaning.late_rows(bars, live), rejected)


def classified_table(live: DataFrame, path: str | None = None, params: IndicatorParams | None = None) -> DataFrame:
    """Classified days written once and read back: three marts read them, and a lost executor
    costs a file read rather than the windows."""
    path = path or scratch_path(live.sparkSession, "classified")
    return write_and_read(indicators.classified(live, params or IndicatorParams()), path)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Stores ``df`` as it is partitioned and goes on from the files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_marts(days: DataFrame) -> dict[str, DataFrame]:
    return {family.mart: streaks.metric_full(days, family) for family in FAMILIES}


def daily_alerts(metric: DataFrame) -> DataFrame:
    """The latest streak of every stock as JSON."""
    return alerts.alert_json(alerts.alert_payload(alerts.latest_streak_alerts(metric, HIGH_LOW), HIGH_LOW))


@dataclass(frozen=True)
class BackTest:
    trades: DataFrame
    purchases: DataFrame
    sales: DataFrame


def run_backtest(days: DataFrame) -> BackTest:
    """Trades and their two breakdowns for every stock in ``days`` (classified)."""
    keyed = backtest.keyed_days(days)
    trades = backtest.streak_trades(backtest.signals(keyed))
    return BackTest(trades, backtest.purchase_breakdown(trades, keyed), backtest.sale_breakdown(trades, keyed))
