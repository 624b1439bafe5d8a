"""Declared table schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from streakline.config import FIELDS
from streakline.families import FAMILIES, BucketFamily

PRICE = T.DecimalType(12, 4)
VOLUME = T.DecimalType(18, 0)


def wide_column(field: str, ticker: str) -> str:
    return f"{field}_{ticker.strip()}".lower()


def wide_columns(tickers: tuple[str, ...]) -> list[str]:
    return [wide_column(field, ticker) for field in FIELDS for ticker in tickers]


def staging_wide(tickers: tuple[str, ...], with_sequence: bool = True) -> T.StructType:
    """Landing table: a text column per field and ticker, plus the ingest sequence."""
    schema = T.StructType([T.StructField("date", T.StringType())])
    for name in wide_columns(tickers):
        schema.add(name, T.StringType())
    return schema.add("ingest_seq", T.LongType()) if with_sequence else schema


LIVE = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("stock_valuation_date", T.DateType(), False),
        T.StructField("stock", T.StringType(), False),
        T.StructField("close_value", PRICE),
        T.StructField("high_value", PRICE),
        T.StructField("low_value", PRICE),
        T.StructField("open_value", PRICE),
        T.StructField("volume_value", VOLUME),
    ]
)

CLASSIFIED = T.StructType(
    [
        T.StructField("stock", T.StringType(), False),
        T.StructField("stock_valuation_date", T.DateType(), False),
        *(T.StructField(name, PRICE) for name in ("stock_value", "minimum_value", "maximum_value")),
        *(T.StructField(name, T.DoubleType()) for name in ("avg_90", "stddev_90", "avg_short", "avg_long")),
        *(T.StructField(family.bucket_column, T.StringType()) for family in FAMILIES),
        *(T.StructField(family.run_column, T.LongType()) for family in FAMILIES),
    ]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("stock_valuation_date", T.DateType(), False),
        T.StructField("stock", T.StringType(), False),
        T.StructField("stock_value", PRICE),
        T.StructField("highest_lowest_valuation", T.StringType()),
        T.StructField("minimum_close", PRICE),
        T.StructField("maximum_close", PRICE),
        T.StructField("average_valuation", T.StringType()),
        T.StructField("moving_avg_comparison", T.StringType()),
    ]
)

DIM = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("bucket_name", T.StringType(), False),
        T.StructField("bucket_description", T.StringType(), False),
    ]
)


def metric(family: BucketFamily) -> T.StructType:
    return T.StructType(
        [
            T.StructField("id", T.StringType(), False),
            T.StructField("stock", T.StringType(), False),
            T.StructField(family.key_column, T.IntegerType(), False),
            T.StructField("start_date", T.DateType(), False),
            T.StructField("end_date", T.DateType(), False),
            T.StructField("day_length", T.IntegerType(), False),
        ]
    )
