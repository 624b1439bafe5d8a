"""Bars and landing rows derived from the given tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streakline import schemas
from streakline.config import FIELDS
from streakline.functions.calendar import next_business_day
from streakline.sources.bars import daily_bars, in_range
from streakline.sources.landing import pivot_wide

SPLIT = "2000-01-01"
STEP_DAY = "1999-12-28"

# The order priorities, which serve as ticker symbols.
TICKERS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_bars(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Few stocks, long histories: order priorities as tickers, business days. Orders of a weekend
    trade on the Monday after. A range restricts the orders that are read."""
    day = F.to_date("o_orderdate")
    traded = F.when(F.weekday(day) >= 5, next_business_day(day)).otherwise(day)
    since = None if start is None else date.fromisoformat(start) - timedelta(days=2)
    bars = daily_bars(
        in_range(table(spark, sf_dir, "orders"), "o_orderdate", since, end),
        stock=F.col("o_orderpriority"),
        day=traded,
        price=F.col("o_totalprice"),
        sequence=F.col("o_orderkey"),
    )
    return in_range(bars, "stock_valuation_date", start, end)


def part_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many stocks: parts as tickers, all days. Line numbers fit 20 bits, so the two parts of a
    line's key make one number; an order key too large for that raises an overflow error."""
    return daily_bars(
        table(spark, sf_dir, "lineitem"),
        stock=F.col("l_partkey"),
        day=F.to_date("l_shipdate"),
        price=F.col("l_extendedprice"),
        sequence=F.col("l_orderkey") * (1 << 20) + F.col("l_linenumber"),
        size=F.round("l_quantity").cast("bigint"),
    )


def old(bars: DataFrame) -> DataFrame:
    return bars.where(F.col("stock_valuation_date") < F.lit(SPLIT).cast("date"))


def new(bars: DataFrame) -> DataFrame:
    return bars.where(F.col("stock_valuation_date") >= F.lit(SPLIT).cast("date"))


def part_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows in the long form, one per part and day, with faults: every tenth day lands twice, first with
    the opening price as close; on the 7th the close of parts ending in 7 reads ``nan``; volumes read ``12.0``; the
    15th lands once more without a date, NULL for even parts, a blank for odd ones."""
    bars = part_bars(spark, sf_dir)
    text = bars.select(
        F.col("stock_valuation_date").cast("string").alias("date"),
        "stock",
        *(F.col(f"{field}_value").cast("string").alias(field) for field in FIELDS),
        F.dayofmonth("stock_valuation_date").alias("_day"),
    )
    copies = F.sequence(F.lit(1).cast("bigint"), F.when((F.col("_day") % 10 == 0) | (F.col("_day") == 15), 2).otherwise(1).cast("bigint"))
    blank = F.when(F.col("stock").cast("bigint") % 2 == 1, " ")
    landed = text.withColumn("ingest_seq", F.explode(copies))
    landed = landed.withColumn("date", F.when((F.col("_day") == 15) & (F.col("ingest_seq") == 2), blank).otherwise(F.col("date")))
    stale = (F.col("_day") % 10 == 0) & (F.col("ingest_seq") == 1)
    close = F.when(stale, F.col("open")).when((F.col("_day") == 7) & F.col("stock").endswith("7"), "nan").otherwise(F.col("close"))
    return landed.withColumns({"close": close, "volume": F.concat("volume", F.lit(".0"))}).drop("_day")


def staging_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows with the faults of real ones: every tenth day lands twice, first with opening
    prices as closing prices; on the 7th the first ticker's close reads ``nan``; volumes read ``12.0``."""
    wide = pivot_wide(order_bars(spark, sf_dir), TICKERS)
    day = F.dayofmonth(F.col("date").cast("date"))
    copies = F.sequence(F.lit(1).cast("bigint"), F.when(day % 10 == 0, 2).otherwise(1).cast("bigint"))
    landed = wide.withColumn("ingest_seq", F.explode(copies))
    stale = (day % 10 == 0) & (F.col("ingest_seq") == 1)

    changes = {}
    for position, ticker in enumerate(TICKERS):
        close, open_, volume = (f"`{schemas.wide_column(f, ticker)}`" for f in ("close", "open", "volume"))
        text = F.when(stale, F.col(open_)).otherwise(F.col(close))
        if position == 0:
            text = F.when((day == 7) & (F.col(close) != ""), F.lit("nan")).otherwise(text)
        changes[close.strip("`")] = text
        changes[volume.strip("`")] = F.when(F.col(volume) != "", F.concat(volume, F.lit(".0"))).otherwise("")
    return landed.withColumns(changes)
