from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from streakline.config import IndicatorParams
from streakline.functions.calendar import calendar_length, instant_utc, next_business_day, prev_business_day, utc_day
from streakline.functions.classify import bucket_position, classify_average, classify_crossover, classify_high_low


def _number(value):
    return F.lit(None if value is None else Decimal(value)).cast("decimal(12,4)")


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("value", "bucket"),
    [
        ("0", "near_record_low"),
        ("20", "near_record_low"),
        ("20.0001", "lower_range"),
        ("40", "lower_range"),
        ("60", "mid_range"),
        ("87", "higher_range"),
        ("87.0001", "near_record_high"),
        ("100", "near_record_high"),
    ],
)
def test_position_bounds_belong_to_the_lower_bucket(spark, value, bucket):
    assert _one(spark, classify_high_low(_number(value), _number("100"), _number("0"))) == bucket


def test_empty_range_is_mid_range(spark):
    assert _one(spark, classify_high_low(_number("5"), _number("5"), _number("5"))) == "mid_range"
    assert _one(spark, bucket_position(_number("5"), _number("5"), _number("5"))) is None


@pytest.mark.parametrize("policy", ["else", "null"])
def test_null_inputs(spark, policy):
    expected = {"else": ("near_record_high", "within", "bearish_alignment"), "null": (None, None, None)}[policy]
    null, ten = _number(None), _number("10")
    found = (
        _one(spark, classify_high_low(null, ten, _number("0"), null_policy=policy)),
        _one(spark, classify_average(null, ten, ten, policy)),
        _one(spark, classify_crossover(ten, null, policy)),
    )
    assert found == expected


@pytest.mark.parametrize(
    ("value", "bucket"), [("12", "within"), ("8", "within"), ("12.0001", "above"), ("7.9999", "below"), ("10", "within")]
)
def test_band_edges_are_within(spark, value, bucket):
    assert _one(spark, classify_average(_number(value), _number("10"), _number("2"))) == bucket


@pytest.mark.parametrize(
    ("short", "long", "bucket"),
    [("2", "1", "bullish_alignment"), ("1", "2", "bearish_alignment"), ("1", "1", "bearish_alignment")],
)
def test_crossover_tie_is_bearish(spark, short, long, bucket):
    assert _one(spark, classify_crossover(_number(short), _number(long))) == bucket


def test_params_are_checked():
    for bad in ({"null_policy": "drop"}, {"band_rows": 0}, {"position_bounds": (Decimal(1),)}):
        with pytest.raises(ValueError):
            IndicatorParams(**bad)
    assert IndicatorParams(long_rows=10).history_rows == 89


@pytest.mark.parametrize(
    ("day", "following", "before"),
    [
        ("2024-01-04", "2024-01-05", "2024-01-03"),
        ("2024-01-05", "2024-01-08", "2024-01-04"),
        ("2024-01-06", "2024-01-08", "2024-01-05"),
        ("2024-01-07", "2024-01-08", "2024-01-06"),
        ("2024-01-08", "2024-01-09", "2024-01-05"),
    ],
)
def test_business_days(spark, day, following, before):
    column = F.lit(date.fromisoformat(day))
    assert _one(spark, next_business_day(column)).isoformat() == following
    assert _one(spark, prev_business_day(column)).isoformat() == before


def test_calendar_length_counts_both_ends(spark):
    assert _one(spark, calendar_length(F.lit(date(2024, 1, 5)), F.lit(date(2024, 1, 8)))) == 4


def test_utc_day_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", other)
            wall_clock = F.lit("2024-01-05 23:30:00").cast("timestamp_ntz")
            assert _one(spark, utc_day(instant_utc(wall_clock))) == date(2024, 1, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
