from __future__ import annotations

import os
import sys
from datetime import date, timedelta
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from streakline.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


def weekdays(start: str, count: int) -> list[date]:
    day, days = date.fromisoformat(start), []
    while len(days) < count:
        if day.weekday() < 5:
            days.append(day)
        day += timedelta(days=1)
    return days


@pytest.fixture(scope="session")
def make_bars(spark):
    """(stock, day, close) rows to bars; high, low and open follow the close."""

    def make(rows):
        schema = (
            "stock string, stock_valuation_date date, close_value decimal(12,4), high_value decimal(12,4), "
            "low_value decimal(12,4), open_value decimal(12,4), volume_value decimal(18,0)"
        )
        full = []
        for stock, day, close in rows:
            day = date.fromisoformat(day) if isinstance(day, str) else day
            price = None if close is None else Decimal(str(close))
            full.append((stock, day, price, price, price, price, Decimal(1)))
        return spark.createDataFrame(full, schema)

    return make


def rows(df, *columns):
    """Rows as sorted plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
