"""Bucket rules, ``Column -> Column``.

Inputs of any numeric type work. The position rule compares products rather
than quotients, so decimal inputs are compared exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from streakline.config import POSITION_BOUNDS
from streakline.families import AVERAGE, HIGH_LOW, MOVING_AVG


def _null_when_missing(bucket: Column, inputs: Sequence[Column], null_policy: str) -> Column:
    if null_policy == "else":
        return bucket
    missing = reduce(lambda a, b: a | b, (value.isNull() for value in inputs))
    return F.when(~missing, bucket)


def classify_high_low(
    value: Column,
    maximum: Column,
    minimum: Column,
    bounds: Sequence[Decimal] = POSITION_BOUNDS,
    null_policy: str = "else",
) -> Column:
    """Where ``value`` lies between the record extremes; a bound belongs to the lower bucket."""
    *bounded, top = HIGH_LOW.bucket_names
    bucket = F.when(maximum == minimum, "mid_range")
    for bound, name in zip(bounds, bounded, strict=True):
        bucket = bucket.when(value - minimum <= F.lit(bound) * (maximum - minimum), name)
    return _null_when_missing(bucket.otherwise(top), (value, maximum, minimum), null_policy)


def classify_average(value: Column, average: Column, deviation: Column, null_policy: str = "else") -> Column:
    """Outside of one deviation around the mean, or within it (edges count as within)."""
    above, below, within = AVERAGE.bucket_names
    bucket = F.when(value < average - deviation, below).when(value > average + deviation, above).otherwise(within)
    return _null_when_missing(bucket, (value, average, deviation), null_policy)


def classify_crossover(short: Column, long: Column, null_policy: str = "else") -> Column:
    """Bullish only while the short average is strictly greater."""
    bullish, bearish = MOVING_AVG.bucket_names
    bucket = F.when(short > long, bullish).otherwise(bearish)
    return _null_when_missing(bucket, (short, long), null_policy)


def bucket_position(value: Column, maximum: Column, minimum: Column) -> Column:
    """Share of the record range below ``value``; NULL while the range is empty."""
    return F.try_divide((value - minimum).cast("double"), (maximum - minimum).cast("double"))
