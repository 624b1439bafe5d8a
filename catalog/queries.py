"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.inputs import SPLIT, STEP_DAY, TICKERS, new, old, order_bars, part_bars, part_landing, staging_wide, table
from streakline import schemas
from streakline.config import IndicatorParams
from streakline.families import AVERAGE, FAMILIES, HIGH_LOW, MOVING_AVG, BucketFamily
from streakline.functions.calendar import instant_utc, next_business_day, prev_business_day
from streakline.functions.classify import bucket_position, classify_high_low
from streakline.functions.keys import surrogate_id
from streakline.operators import alerts, backtest, cleaning, incremental, indicators, quality, streaks
from streakline.operators.asof import asof_join
from streakline.operators.intervals import days_in_intervals
from streakline.operators.spread import place_by_stock
from streakline.operators.trading_days import trading_calendar, trading_days_between, with_day_ahead, with_ordinal
from streakline.plans import marts
from streakline.plans.increments import StreakStore
from streakline.session import scratch_path
from streakline.sources import bars as bar_source
from streakline.sources.dims import dim
from streakline.sources.landing import append_rows, pivot_wide, read_wide_csv, read_wide_csv_apart, write_wide_csv
from streakline.sources.versioned import VersionedTable
from streakline.streaming.streaks import closed_day_bars, flush, last_batch, start_streaks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = ["stock", "stock_valuation_date"]


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        return function

    return register


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.classified(order_bars(spark, sf_dir))


def part_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.classified(place_by_stock(part_bars(spark, sf_dir)))


def order_metric(spark: SparkSession, sf_dir: str, family: BucketFamily = HIGH_LOW) -> DataFrame:
    return streaks.metric_full(order_days(spark, sf_dir), family)


def stored_mart_and_new_days(days: DataFrame, family: BucketFamily = HIGH_LOW) -> tuple[DataFrame, DataFrame]:
    """The mart up to the split as a stored table, and the classified days after it. Indicators only
    look back, so the classified days before the split are those a load up to the split gives."""
    spark = days.sparkSession
    days = marts.write_and_read(days, scratch_path(spark, "days"))
    metric = streaks.metric_full(old(days), family)
    return marts.write_and_read(metric, scratch_path(spark, family.mart)), new(days)


def old_and_next(days: DataFrame, family: BucketFamily = HIGH_LOW) -> tuple[DataFrame, DataFrame]:
    """The stored mart, and a snapshot of each stock's first day after the split."""
    metric, later = stored_mart_and_new_days(days, family)
    first = cleaning.newest_per_key(later, [F.col("stock")], [F.col("stock_valuation_date")])
    return metric, indicators.snapshot_columns(first)


def old_and_day(days: DataFrame, family: BucketFamily = HIGH_LOW) -> tuple[DataFrame, DataFrame]:
    """The stored mart up to the day before ``STEP_DAY``, and the snapshot of that one day."""
    spark = days.sparkSession
    days = marts.write_and_read(days, scratch_path(spark, "days"))
    day = F.lit(STEP_DAY).cast("date")
    metric = streaks.metric_full(days.where(F.col("stock_valuation_date") < day), family)
    snapshot = indicators.snapshot_columns(days.where(F.col("stock_valuation_date") == day))
    return marts.write_and_read(metric, scratch_path(spark, family.mart)), snapshot


# --- scans, landing, dimensions -------------------------------------------------------------------


@query("order_bars")
def _(spark, sf_dir):
    return order_bars(spark, sf_dir)


@query("bars_in_range")
def _(spark, sf_dir):
    span = "1997-01-01", "1998-01-01"
    return bar_source.bars_in_range(order_bars(spark, sf_dir, *span), *span, TICKERS[:2])


@query("bars_full_history")
def _(spark, sf_dir):
    return bar_source.bars_full_history(order_bars(spark, sf_dir))


@query("bars_yesterday")
def _(spark, sf_dir):
    return bar_source.bars_yesterday(order_bars(spark, sf_dir, "2000-01-04", "2000-01-05"), "2000-01-05")


@query("last_saved_date")
def _(spark, sf_dir):
    return bar_source.last_saved_date(staging_wide(spark, sf_dir))


@query("wide_csv_apart")
def _(spark, sf_dir):
    """The wide table as lines; those of the 3rd of a month lack their last field, those of the 4th have two more."""
    wide = pivot_wide(order_bars(spark, sf_dir), TICKERS)
    day, line = F.dayofmonth(F.col("date").cast("date")), F.concat_ws(",", *[F.col(f"`{c}`") for c in wide.columns])
    faulty = F.when(day == 3, F.regexp_replace(line, ",[^,]*$", "")).when(day == 4, F.concat(line, F.lit(",x,y"))).otherwise(line)
    path = scratch_path(spark, "lines")
    wide.select(faulty.alias("value")).write.text(path)
    rows, quarantine = read_wide_csv_apart(spark, path, TICKERS, header=False)
    landed = rows.select("date", F.lit(True).alias("landed"), F.lit(len(rows.columns)).alias("n_fields"))
    return landed.unionByName(quarantine.select(F.substring_index("line", ",", 1).alias("date"), F.lit(False).alias("landed"), "n_fields"))


@query("next_business_day_slice")
def _(spark, sf_dir):
    bars = order_bars(spark, sf_dir)
    saved = bar_source.last_saved_date(old(bars), "stock_valuation_date")
    return bar_source.next_business_day_slice(bars, saved)


@query("pivot_wide")
def _(spark, sf_dir):
    return pivot_wide(order_bars(spark, sf_dir), TICKERS)


@query("wide_csv_roundtrip")
def _(spark, sf_dir):
    path = scratch_path(spark, "wide_csv")
    write_wide_csv(pivot_wide(order_bars(spark, sf_dir), TICKERS), path)
    return read_wide_csv(spark, path, TICKERS).na.fill("")


@query("append_rows")
def _(spark, sf_dir):
    bars = order_bars(spark, sf_dir)
    return append_rows(old(bars), new(bars).select(*reversed(bars.columns)))


def _dim_usage(family: BucketFamily) -> Query:
    def usage(spark, sf_dir):
        days = order_days(spark, sf_dir).groupBy(F.col(family.bucket_column).alias("bucket_name"))
        counts = days.agg(F.count(F.lit(1)).alias("day_count"))
        return dim(spark, family).join(counts, "bucket_name", "left").select("id", "bucket_name", "day_count")

    return usage


for _name, _family in (("dim_high_low", HIGH_LOW), ("dim_average", AVERAGE), ("dim_moving_avg", MOVING_AVG)):
    query(_name)(_dim_usage(_family))


# --- landing to live ------------------------------------------------------------------------------


def _long_text(spark, sf_dir):
    return cleaning.unpivot_live(cleaning.dedup_by_date(staging_wide(spark, sf_dir)), TICKERS)


@query("dedup_by_date")
def _(spark, sf_dir):
    return cleaning.dedup_by_date(staging_wide(spark, sf_dir))


@query("unpivot_live")
def _(spark, sf_dir):
    return _long_text(spark, sf_dir)


@query("typed_bars")
def _(spark, sf_dir):
    return cleaning.typed_bars(_long_text(spark, sf_dir))


@query("rejected_rows")
def _(spark, sf_dir):
    return cleaning.rejected_rows(_long_text(spark, sf_dir))


@query("surrogate_key")
def _(spark, sf_dir):
    bars = order_bars(spark, sf_dir)
    return bars.select(surrogate_id(F.col("stock_valuation_date"), F.col("stock")).alias("id"), *KEYS)


@query("incremental_filter")
def _(spark, sf_dir):
    bars = order_bars(spark, sf_dir)
    return cleaning.incremental_filter(bars, old(bars).where(F.col("stock") != TICKERS[0]))


def _target_and_corrections(spark, sf_dir):
    """Old bars as the target; as the source the last old year, corrected, and all new bars."""
    bars = order_bars(spark, sf_dir)
    recent = bars.where(F.col("stock_valuation_date") >= F.lit("1999-01-01").cast("date"))
    return old(bars), recent.withColumn("volume_value", (F.col("volume_value") + 1).cast("decimal(18,0)"))


@query("upsert_live")
def _(spark, sf_dir):
    return cleaning.upsert_live(*_target_and_corrections(spark, sf_dir))


@query("upsert_live_append_only")
def _(spark, sf_dir):
    return cleaning.upsert_live(*_target_and_corrections(spark, sf_dir), allow_corrections=False)


@query("ingest")
def _(spark, sf_dir):
    live = cleaning.typed_bars(_long_text(spark, sf_dir)).where(F.col("stock_valuation_date") < F.lit(SPLIT))
    return marts.ingest(staging_wide(spark, sf_dir), TICKERS, live).live


@query("late_rows")
def _(spark, sf_dir):
    bars = order_bars(spark, sf_dir)
    return cleaning.late_rows(bars, old(bars).where(F.dayofmonth("stock_valuation_date") != 12))


def _part_landed(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Parts in the long form, and a live table that ends at the split, lacks every 12th of a month and has a close that is
    one higher on every 14th."""
    long_text = marts.write_and_read(cleaning.dedup_long(part_landing(spark, sf_dir)), scratch_path(spark, "long_text"))
    known = old(cleaning.typed_bars(long_text)).where(F.dayofmonth("stock_valuation_date") != 12)
    raised = (F.col("close_value") + F.when(F.dayofmonth("stock_valuation_date") == 14, 1).otherwise(0)).cast(schemas.PRICE)
    return long_text, known.withColumn("close_value", raised)


def _part_ingested(spark, sf_dir) -> marts.Ingested:
    return marts.ingest_long(*_part_landed(spark, sf_dir))


@query("part_landed_balance")
def _(spark, sf_dir):
    return cleaning.landed_balance(*_part_landed(spark, sf_dir))


@query("part_ingest")
def _(spark, sf_dir):
    return _part_ingested(spark, sf_dir).live


@query("part_late_rows")
def _(spark, sf_dir):
    return _part_ingested(spark, sf_dir).late


@query("part_rejected_rows")
def _(spark, sf_dir):
    return _part_ingested(spark, sf_dir).rejected


@query("part_upsert_live")
def _(spark, sf_dir):
    bars = part_bars(spark, sf_dir)
    recent = bars.where(F.col("stock_valuation_date") >= F.lit("1999-01-01").cast("date"))
    return cleaning.upsert_live(old(bars), recent.withColumn("volume_value", (F.col("volume_value") + 1).cast("decimal(18,0)")))


# --- indicators and classifiers -------------------------------------------------------------------


@query("record_extremes")
def _(spark, sf_dir):
    bars = order_bars(spark, sf_dir).select(*KEYS, "close_value")
    return indicators.record_extremes(bars)


@query("rolling_avg_stddev")
def _(spark, sf_dir):
    bars = order_bars(spark, sf_dir).select(*KEYS, "close_value")
    return indicators.rolling_avg_stddev(bars).withColumn("stddev_90", F.round("stddev_90", 4))


@query("moving_averages")
def _(spark, sf_dir):
    return indicators.moving_averages(order_bars(spark, sf_dir).select(*KEYS, "close_value"))


@query("classified")
def _(spark, sf_dir):
    return order_days(spark, sf_dir).withColumn("stddev_90", F.round("stddev_90", 4))


@query("classified_increment")
def _(spark, sf_dir):
    bars = order_bars(spark, sf_dir)
    tail = indicators.history_tail(indicators.classified(old(bars)))
    return indicators.classify_increment(tail, new(bars)).withColumn("stddev_90", F.round("stddev_90", 4))


@query("last_snapshot")
def _(spark, sf_dir):
    return indicators.last_snapshot(order_days(spark, sf_dir))


@query("classify_high_low")
def _(spark, sf_dir):
    extremes = indicators.record_extremes(order_bars(spark, sf_dir))
    bucket = classify_high_low(F.col("close_value"), F.col("maximum_value"), F.col("minimum_value"))
    return extremes.select(*KEYS, bucket.alias(HIGH_LOW.bucket_column))


@query("classify_high_low_custom")
def _(spark, sf_dir):
    bounds = tuple(Decimal(b) for b in ("0.10", "0.25", "0.50", "0.80"))
    days = indicators.classified(order_bars(spark, sf_dir), IndicatorParams(position_bounds=bounds))
    return days.select(*KEYS, HIGH_LOW.bucket_column)


@query("classify_average")
def _(spark, sf_dir):
    return order_days(spark, sf_dir).select(*KEYS, AVERAGE.bucket_column)


@query("classify_crossover")
def _(spark, sf_dir):
    return order_days(spark, sf_dir).select(*KEYS, MOVING_AVG.bucket_column)


@query("bucket_position")
def _(spark, sf_dir):
    extremes = indicators.record_extremes(order_bars(spark, sf_dir))
    position = bucket_position(F.col("close_value"), F.col("maximum_value"), F.col("minimum_value"))
    return extremes.select(*KEYS, position.alias("bucket_position"))


@query("next_business_day")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", next_business_day(F.to_date("o_orderdate")).alias("next_business_day")
    )


@query("prev_business_day")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", prev_business_day(F.to_date("o_orderdate")).alias("prev_business_day")
    )


# --- streaks, marts, increments: one set per family -----------------------------------------------


def _register_family(family: BucketFamily) -> None:
    @query(f"{family.name}_runs")
    def _(spark, sf_dir):
        return order_days(spark, sf_dir).select(*KEYS, family.bucket_column, family.run_column)

    @query(f"{family.name}_streaks")
    def _(spark, sf_dir):
        return streaks.streaks(order_days(spark, sf_dir), family).drop(family.run_column)

    @query(f"{family.name}_metric_full")
    def _(spark, sf_dir):
        return order_metric(spark, sf_dir, family)

    @query(f"part_{family.name}_metric_full")
    def _(spark, sf_dir):
        return streaks.metric_full(part_days(spark, sf_dir), family)

    @query(f"advance_{family.name}")
    def _(spark, sf_dir):
        return incremental.advance_one_day(*old_and_next(order_days(spark, sf_dir), family), family)

    @query(f"upsert_streaks_{family.name}")
    def _(spark, sf_dir):
        metric, snapshot = old_and_next(order_days(spark, sf_dir), family)
        return incremental.upsert_streaks(metric, incremental.advance_one_day(metric, snapshot, family))

    @query(f"advance_many_days_{family.name}")
    def _(spark, sf_dir):
        days = order_days(spark, sf_dir).select(*KEYS, family.bucket_column, family.run_column)
        return incremental.advance_many_days(*stored_mart_and_new_days(days, family), family)

    @query(f"dq_freshness_{family.name}")
    def _(spark, sf_dir):
        bars = order_bars(spark, sf_dir).select(*KEYS, "close_value")
        known = old(order_days(spark, sf_dir)).where(F.col("stock") != TICKERS[-1])
        return quality.freshness(bars, streaks.metric_full(known, family))


for _family in FAMILIES:
    _register_family(_family)


@query("part_bars")
def _(spark, sf_dir):
    return part_bars(spark, sf_dir)


@query("part_classified")
def _(spark, sf_dir):
    return part_days(spark, sf_dir).withColumn("stddev_90", F.round("stddev_90", 4))


@query("part_advance_many_days")
def _(spark, sf_dir):
    days = part_days(spark, sf_dir).select(*KEYS, HIGH_LOW.bucket_column, HIGH_LOW.run_column)
    return incremental.advance_many_days(*stored_mart_and_new_days(days), HIGH_LOW)


def _with_gaps(spark, sf_dir):
    """Part bars of which every fifth one, by a hash, has no price."""
    gap = F.pmod(F.unix_date("stock_valuation_date") * 7 + F.col("stock").cast("bigint"), F.lit(5)) == 0
    return place_by_stock(part_bars(spark, sf_dir)).withColumn("close_value", F.when(~gap, F.col("close_value")))


NULL_BREAKS = IndicatorParams(null_policy="null")


@query("part_metric_full_null")
def _(spark, sf_dir):
    return streaks.metric_full(indicators.classified(_with_gaps(spark, sf_dir), NULL_BREAKS), HIGH_LOW)


@query("part_advance_many_days_null")
def _(spark, sf_dir):
    days = indicators.classified(_with_gaps(spark, sf_dir), NULL_BREAKS).select(*KEYS, HIGH_LOW.bucket_column, HIGH_LOW.run_column)
    days = marts.write_and_read(days, scratch_path(spark, "days"))
    metric = marts.write_and_read(streaks.metric_full(old(days), HIGH_LOW), scratch_path(spark, HIGH_LOW.mart))
    return incremental.advance_many_days(metric, new(days), HIGH_LOW, old(days))


@query("streak_extremes")
def _(spark, sf_dir):
    days = indicators.classified(order_bars(spark, sf_dir), carry=("high_value", "low_value"))
    return streaks.streak_extremes(days, HIGH_LOW).drop(HIGH_LOW.run_column)


@query("bucket_record_max")
def _(spark, sf_dir):
    return streaks.bucket_record_max(order_days(spark, sf_dir), HIGH_LOW)


@query("bucket_summary")
def _(spark, sf_dir):
    return streaks.bucket_summary(order_metric(spark, sf_dir), HIGH_LOW)


@query("part_bucket_summary")
def _(spark, sf_dir):
    return streaks.bucket_summary(streaks.metric_full(part_days(spark, sf_dir), HIGH_LOW), HIGH_LOW)


@query("daily_tracking")
def _(spark, sf_dir):
    return streaks.daily_tracking(order_bars(spark, sf_dir))


def _trailing_and_snapshot(days: DataFrame) -> tuple[DataFrame, DataFrame]:
    metric, snapshot = old_and_day(days)
    return incremental.trailing_streaks(metric), incremental.snapshot_with_key(snapshot, HIGH_LOW)


def _register_increment_steps(prefix: str, days_of: Query) -> None:
    @query(f"{prefix}closed_streaks")
    def _(spark, sf_dir):
        return incremental.closed_streaks(*old_and_day(days_of(spark, sf_dir)))

    @query(f"{prefix}trailing_streaks")
    def _(spark, sf_dir):
        return incremental.trailing_streaks(old_and_day(days_of(spark, sf_dir))[0])

    @query(f"{prefix}trailing_streaks_by_day")
    def _(spark, sf_dir):
        return incremental.trailing_streaks(*old_and_day(days_of(spark, sf_dir)))

    @query(f"{prefix}snapshot_with_key")
    def _(spark, sf_dir):
        return incremental.snapshot_with_key(indicators.last_snapshot(days_of(spark, sf_dir)), HIGH_LOW)

    @query(f"{prefix}extend_streaks")
    def _(spark, sf_dir):
        return incremental.extend_streaks(*_trailing_and_snapshot(days_of(spark, sf_dir)), HIGH_LOW)

    @query(f"{prefix}switch_streaks")
    def _(spark, sf_dir):
        return incremental.switch_streaks(*_trailing_and_snapshot(days_of(spark, sf_dir)), HIGH_LOW)


_register_increment_steps("", order_days)
_register_increment_steps("part_", part_days)


@query("part_advance_high_low")
def _(spark, sf_dir):
    return incremental.advance_one_day(*old_and_next(part_days(spark, sf_dir)), HIGH_LOW)


@query("part_upsert_streaks_high_low")
def _(spark, sf_dir):
    metric, snapshot = old_and_next(part_days(spark, sf_dir))
    return incremental.upsert_streaks(metric, incremental.advance_one_day(metric, snapshot, HIGH_LOW))


@query("part_last_snapshot")
def _(spark, sf_dir):
    return indicators.last_snapshot(part_days(spark, sf_dir))


@query("part_classified_increment")
def _(spark, sf_dir):
    bars = part_bars(spark, sf_dir)
    tail = indicators.history_tail(indicators.classified(place_by_stock(old(bars))))
    return indicators.classify_increment(tail, new(bars)).withColumn("stddev_90", F.round("stddev_90", 4))


@query("part_corrected_streaks")
def _(spark, sf_dir):
    """Parts ending in 0 are corrected in two months of 1999, long after most of their streaks."""
    bars = marts.write_and_read(part_bars(spark, sf_dir).select(*KEYS, "close_value"), scratch_path(spark, "bars"))
    days = marts.write_and_read(indicators.classified(bars), scratch_path(spark, "days"))
    wrong = F.col("stock").endswith("0") & F.col("stock_valuation_date").between(F.lit("1999-03-01").cast("date"), F.lit("1999-04-30").cast("date"))
    live = bars.withColumn("close_value", F.when(wrong, F.col("close_value") + 1000).otherwise(F.col("close_value")).cast("decimal(12,4)"))
    return incremental.correct_streaks(streaks.metric_full(days, HIGH_LOW), days, live, bars.where(wrong), HIGH_LOW)


def _register_corrected(family: BucketFamily) -> None:
    @query(f"corrected_streaks_{family.name}")
    def _(spark, sf_dir):
        """Two weeks of 1995 are corrected in long histories; what lies a window's length later passes through."""
        bars = marts.write_and_read(order_bars(spark, sf_dir).select(*KEYS, "close_value"), scratch_path(spark, "bars"))
        days = marts.write_and_read(indicators.classified(bars), scratch_path(spark, "days"))
        wrong = F.col("stock_valuation_date").between(F.lit("1995-03-01").cast("date"), F.lit("1995-03-14").cast("date"))
        live = bars.withColumn("close_value", F.when(wrong, F.col("close_value") / 2).otherwise(F.col("close_value")).cast("decimal(12,4)"))
        return incremental.correct_streaks(streaks.metric_full(days, family), days, live, bars.where(wrong), family)


for _family in FAMILIES:
    _register_corrected(_family)


@query("part_build_or_advance")
def _(spark, sf_dir):
    """The first load builds, the second one advances what it built."""
    days = marts.write_and_read(part_days(spark, sf_dir), scratch_path(spark, "days"))
    first = incremental.build_or_advance(None, old(days), HIGH_LOW)
    return incremental.build_or_advance(marts.write_and_read(first, scratch_path(spark, HIGH_LOW.mart)), new(days), HIGH_LOW)


STORE_CUTS = ("1997-01-01", "1998-07-01", "2000-01-01", "2001-01-01")


def _part_store(spark: SparkSession, sf_dir: str, family: BucketFamily) -> StreakStore:
    """Five batches over stored state. From the second on each brings, besides its own span, the
    month before with other prices, which lies behind the stored days and changes nothing. Most
    stocks are idle in some batch, some appear late."""
    bars = marts.write_and_read(part_bars(spark, sf_dir).select(*KEYS, "close_value"), scratch_path(spark, "bars"))
    store = StreakStore(spark, scratch_path(spark, "store"), (family,))
    edges = (None, *STORE_CUTS, None)
    for batch, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
        span = bar_source.bars_in_range(bars, start, end)
        if start:
            before = bar_source.in_range(bars, "stock_valuation_date", date.fromisoformat(start) - timedelta(days=30), start)
            span = span.unionByName(before.withColumn("close_value", (F.col("close_value") + 1).cast("decimal(12,4)")))
        store.apply(batch, span)
    return store


def _register_store(family: BucketFamily) -> None:
    @query(f"part_store_{family.name}")
    def _(spark, sf_dir):
        return _part_store(spark, sf_dir, family).metric(family, len(STORE_CUTS))


for _family in FAMILIES:
    _register_store(_family)


@query("part_store_summary")
def _(spark, sf_dir):
    """The summary kept by the five batches, without a look at closed streaks."""
    return _part_store(spark, sf_dir, HIGH_LOW).summary(HIGH_LOW, len(STORE_CUTS))


# --- events as of their time ----------------------------------------------------------------------


def _register_asof(direction: str) -> None:
    @query("part_asof" if direction == "backward" else f"part_asof_{direction}")
    def _(spark, sf_dir):
        """Each line, on the day of its order, beside the part's closing price of that day or the nearest one within 90 days."""
        ordered = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("stock_valuation_date"))
        lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("stock")).join(ordered, "l_orderkey")
        lines = marts.write_and_read(lines, scratch_path(spark, "lines"))
        prices = marts.write_and_read(part_bars(spark, sf_dir).select(*KEYS, "close_value"), scratch_path(spark, "prices"))
        found = asof_join(lines, prices, ["stock"], "stock_valuation_date", "90 days", direction)
        return found.select(
            "l_orderkey", "l_linenumber", F.col("matched.stock_valuation_date").alias("price_date"), F.col("matched.close_value").alias("close_value")
        )


for _direction in ("backward", "forward", "nearest"):
    _register_asof(_direction)


# --- versions of a table --------------------------------------------------------------------------


def _versioned_parts(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Version 0 holds the bars up to the split, 1 also those after it, in 2 the closes of some parts' days of 1997 are one
    higher, and days of 2001 come in."""
    bars = part_bars(spark, sf_dir).select(*KEYS, "close_value")
    versions = VersionedTable(spark, scratch_path(spark, "versions"), bars.schema)
    versions.replace(old(bars).repartitionByRange("stock", "stock_valuation_date"))
    versions.merge(new(bars), KEYS)
    some = bars.where((F.col("stock").cast("bigint") % 50 == 0) & (F.year("stock_valuation_date") == 1997))
    moved = some.unionByName(some.withColumn("stock_valuation_date", F.add_months("stock_valuation_date", 48)).dropDuplicates(KEYS))
    versions.merge(moved.withColumn("close_value", (F.col("close_value") + 1).cast(schemas.PRICE)), KEYS)
    return versions


@query("part_merge_files")
def _(spark, sf_dir):
    return _versioned_parts(spark, sf_dir).as_of()


@query("part_table_as_of")
def _(spark, sf_dir):
    versions = _versioned_parts(spark, sf_dir)
    return versions.as_of(0).withColumn("version", F.lit(0)).unionByName(versions.as_of(1).withColumn("version", F.lit(1)))


# --- alerts ---------------------------------------------------------------------------------------


@query("latest_streak_alerts")
def _(spark, sf_dir):
    return alerts.latest_streak_alerts(order_metric(spark, sf_dir))


@query("part_latest_streak_alerts")
def _(spark, sf_dir):
    return alerts.latest_streak_alerts(streaks.metric_full(part_days(spark, sf_dir), HIGH_LOW))


@query("bucket_break_events")
def _(spark, sf_dir):
    return alerts.bucket_break_events(order_metric(spark, sf_dir))


@query("alert_payload")
def _(spark, sf_dir):
    return alerts.alert_payload(alerts.latest_streak_alerts(order_metric(spark, sf_dir)))


@query("alert_json")
def _(spark, sf_dir):
    return marts.daily_alerts(order_metric(spark, sf_dir))


@query("reconcile")
def _(spark, sf_dir):
    days = marts.classified_table(order_bars(spark, sf_dir))
    expected = alerts.alert_payload(streaks.metric_full(days, HIGH_LOW))
    delivered = alerts.alert_payload(streaks.metric_full(old(days), HIGH_LOW))
    return alerts.reconcile(expected, delivered, expected.columns)


# --- back-test ------------------------------------------------------------------------------------


@query("streak_days")
def _(spark, sf_dir):
    return backtest.streak_days(order_bars(spark, sf_dir), order_metric(spark, sf_dir))


@query("part_streak_days")
def _(spark, sf_dir):
    bars = part_bars(spark, sf_dir)
    return backtest.streak_days(bars, streaks.metric_full(indicators.classified(bars), HIGH_LOW))


@query("part_streak_days_all_families")
def _(spark, sf_dir):
    """Each day beside its streaks of all families, which overlap in one table."""
    days = marts.write_and_read(part_days(spark, sf_dir), scratch_path(spark, "days"))
    spans = [
        streaks.metric_full(days, family).select("stock", F.lit(family.name).alias("family"), F.col(family.key_column).alias("valuation_key"), "start_date", "end_date")
        for family in FAMILIES
    ]
    return days_in_intervals(days.select(*KEYS, "stock_value"), spans[0].unionByName(spans[1]).unionByName(spans[2]))


@query("part_trading_days")
def _(spark, sf_dir):
    """Each order's trading day, counted from 1990 on; weekdays on which the number of orders is a multiple of nine are holidays."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    holidays = orders.groupBy("day").agg(F.count(F.lit(1)).alias("n")).where("n % 9 = 0")
    calendar = marts.write_and_read(trading_calendar(spark, date(1990, 1, 1), date(2005, 12, 31), holidays), scratch_path(spark, "calendar"))
    found = with_ordinal(orders, "day", calendar).withColumn("month_end", F.last_day("day"))
    for name, n in (("opens", 0), ("settles", 2), ("before", -1)):
        found = with_day_ahead(found, "day", n, calendar, name)
    return trading_days_between(found, "day", "month_end", calendar, "left_in_month").drop("month_end")


@query("streak_running_extremes")
def _(spark, sf_dir):
    bars = order_bars(spark, sf_dir)
    return backtest.streak_running_extremes(
        backtest.streak_days(bars, streaks.metric_full(indicators.classified(bars), HIGH_LOW))
    )


def _keyed(spark, sf_dir):
    return backtest.keyed_days(order_days(spark, sf_dir))


@query("ticker_filter")
def _(spark, sf_dir):
    return backtest.ticker_filter(_keyed(spark, sf_dir), TICKERS[1]).drop("streak_run")


@query("next_day_lookup")
def _(spark, sf_dir):
    return backtest.next_day_lookup(_keyed(spark, sf_dir)).drop("streak_run")


@query("buy_signals")
def _(spark, sf_dir):
    return backtest.buy_signals(_keyed(spark, sf_dir)).drop("streak_run")


@query("sell_candidates")
def _(spark, sf_dir):
    return backtest.sell_candidates(_keyed(spark, sf_dir), Decimal("400000")).drop("streak_run")


@query("round_trips")
def _(spark, sf_dir):
    return backtest.round_trips(backtest.signals(_keyed(spark, sf_dir)))


@query("streak_trades")
def _(spark, sf_dir):
    return backtest.streak_trades(backtest.signals(_keyed(spark, sf_dir))).drop("purchase_run", "sale_run")


@query("part_streak_trades")
def _(spark, sf_dir):
    days = backtest.keyed_days(part_days(spark, sf_dir))
    return backtest.streak_trades(backtest.signals(days)).drop("purchase_run", "sale_run")


@query("part_round_trips")
def _(spark, sf_dir):
    return backtest.round_trips(backtest.signals(backtest.keyed_days(part_days(spark, sf_dir))))


@query("purchase_breakdown")
def _(spark, sf_dir):
    return marts.run_backtest(order_days(spark, sf_dir)).purchases


@query("sale_breakdown")
def _(spark, sf_dir):
    return marts.run_backtest(order_days(spark, sf_dir)).sales


@query("max_drawdown")
def _(spark, sf_dir):
    return backtest.max_drawdown(marts.run_backtest(order_days(spark, sf_dir)).purchases)


@query("max_increment")
def _(spark, sf_dir):
    return backtest.max_increment(marts.run_backtest(order_days(spark, sf_dir)).sales)


@query("stable_stocks")
def _(spark, sf_dir):
    return backtest.stable_stocks(_keyed(spark, sf_dir))


@query("part_stable_stocks")
def _(spark, sf_dir):
    return backtest.stable_stocks(backtest.keyed_days(part_days(spark, sf_dir)))


# --- data quality ---------------------------------------------------------------------------------


@query("part_dq_one_pass")
def _(spark, sf_dir):
    """Counters that ride on the write of a mart with planted faults: no end for parts ending in 7, an unknown bucket for
    those ending in 3, a wrong length for 5."""
    metric = streaks.metric_full(part_days(spark, sf_dir), HIGH_LOW)
    last, key = F.substring("stock", -1, 1), HIGH_LOW.key_column
    planted = metric.withColumns(
        {
            "end_date": F.when(last != "7", F.col("end_date")),
            key: F.when(last == "3", F.lit(9)).otherwise(F.col(key)),
            "day_length": F.when(last == "5", F.col("day_length") + 1).otherwise(F.col("day_length")),
        }
    )
    rules = quality.null_rules(["stock", "end_date"]) | quality.domain_rule(key, [1, 2, 3, 4, 5]) | quality.shape_rules()
    path = scratch_path(spark, "checked_mart")
    counts = quality.checked_write(planted, path, rules)
    listed = quality.failing_rows(spark.read.parquet(path), rules, counts)
    passed = spark.createDataFrame(sorted(counts.items()), "check_name string, row_count bigint")
    exact = listed.select(F.explode(F.split("failed_rules", ",")).alias("check_name")).groupBy("check_name").agg(F.count(F.lit(1)).alias("listed_rows"))
    return passed.join(exact, "check_name", "left").na.fill(0, ["listed_rows"])


@query("dq_unique")
def _(spark, sf_dir):
    return quality.unique(staging_wide(spark, sf_dir), ["date"])


@query("dq_not_null")
def _(spark, sf_dir):
    live = cleaning.typed_bars(_long_text(spark, sf_dir))
    return quality.not_null(live, ["id", *KEYS, "close_value", "volume_value"]).select(*KEYS, "null_columns")


@query("dq_accepted_values")
def _(spark, sf_dir):
    return quality.accepted_values(order_days(spark, sf_dir), HIGH_LOW.bucket_column, HIGH_LOW.bucket_names[1:4])


@query("part_dq_accepted_values")
def _(spark, sf_dir):
    return quality.accepted_values(part_days(spark, sf_dir), HIGH_LOW.bucket_column, HIGH_LOW.bucket_names)


@query("part_dq_streak_cover")
def _(spark, sf_dir):
    """Each third streak, by its start, is there twice: its days lie in two streaks."""
    bars = marts.write_and_read(part_bars(spark, sf_dir), scratch_path(spark, "bars"))
    metric = streaks.metric_full(indicators.classified(place_by_stock(bars)), HIGH_LOW)
    copies = F.when(F.unix_date("start_date") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return quality.streak_cover(bars, metric.withColumn("_copy", F.explode(copies)).drop("_copy"))


@query("dq_relationships")
def _(spark, sf_dir):
    parents = dim(spark, HIGH_LOW).where("id <= 3")
    return quality.relationships(order_metric(spark, sf_dir), HIGH_LOW.key_column, parents, "id")


@query("dq_streak_cover")
def _(spark, sf_dir):
    return quality.streak_cover(order_bars(spark, sf_dir), streaks.metric_full(old(order_days(spark, sf_dir)), HIGH_LOW))


@query("dq_streak_shape")
def _(spark, sf_dir):
    metric = order_metric(spark, sf_dir)
    stretched = F.when(F.col(HIGH_LOW.key_column) == 1, F.date_add("end_date", 1)).otherwise(F.col("end_date"))
    return quality.streak_shape(metric.withColumn("end_date", stretched))


# --- streaming ------------------------------------------------------------------------------------


@query("streak_stream")
def _(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # A glob, because a stream takes no plain path to a single file.
    ticks = spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet")
    columns = F.col("event_type"), "ts", F.col("value"), F.col("event_id")
    bars = closed_day_bars(ticks.withColumn("ts", instant_utc(F.col("ts"))), *columns)
    store = StreakStore(spark, scratch_path(spark, "streaks"), (HIGH_LOW,))
    stream = start_streaks(bars, store, scratch_path(spark, "checkpoint"))
    stream.awaitTermination()
    finished = table(spark, sf_dir, "events").withColumn("ts", instant_utc(F.col("ts")))
    return store.metric(HIGH_LOW, flush(store, last_batch(stream), finished, *columns))
