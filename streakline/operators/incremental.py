"""Advancing a streak mart by new days instead of rebuilding it.

``end_date`` and ``day_length`` always come from the new day itself, never
from calendar arithmetic, so weekends and holidays do not break a streak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.config import IndicatorParams
from streakline.families import AVERAGE, MOVING_AVG, BucketFamily
from streakline.functions.calendar import calendar_length, prev_business_day
from streakline.functions.keys import surrogate_id
from streakline.operators.cleaning import newest_per_key, upsert
from streakline.operators.indicators import classify_increment, history_tail
from streakline.operators.spread import place_by_stock
from streakline.operators.streaks import metric_columns, metric_full, with_key

STREAK_KEY = ("stock", "start_date")


def closed_streaks(metric: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Streaks that ended more than a day before the snapshot's newest day."""
    newest = snapshot.agg(F.date_sub(F.max("stock_valuation_date"), 1).alias("cutoff")).scalar()
    return metric.where(F.col("end_date") < newest)


def trailing_streaks(metric: DataFrame, snapshot: DataFrame | None = None) -> DataFrame:
    """The open streak of each stock: its latest one.

    Given a ``snapshot``, only streaks that end on the business day before
    the snapshot's newest day count as open.
    """
    if snapshot is None:
        return newest_per_key(metric, [F.col("stock")], [F.desc("start_date")])
    newest = snapshot.agg(prev_business_day(F.max("stock_valuation_date")).alias("day")).scalar()
    return metric.where(F.col("end_date") == newest)


def snapshot_with_key(snapshot: DataFrame, family: BucketFamily) -> DataFrame:
    return with_key(snapshot, family).select(
        "stock", "stock_valuation_date", "stock_value", family.bucket_column, family.key_column
    )


def _open_beside_snapshot(trailing: DataFrame, keyed_snapshot: DataFrame, family: BucketFamily) -> DataFrame:
    """Each open streak with its stock's snapshot day, if that lies after the streak."""
    snapshot = keyed_snapshot.select(
        "stock", F.col("stock_valuation_date").alias("_day"), F.col(family.key_column).alias("_day_key")
    )
    return trailing.join(snapshot, "stock").where(F.col("_day") > F.col("end_date"))


def _struct(family: BucketFamily, start: Column, end: Column, key: Column) -> Column:
    return F.struct(
        F.col("stock"),
        key.alias(family.key_column),
        start.alias("start_date"),
        end.alias("end_date"),
        calendar_length(start, end).alias("day_length"),
    )


def extend_streaks(trailing: DataFrame, keyed_snapshot: DataFrame, family: BucketFamily) -> DataFrame:
    """Open streaks whose stock stayed in the bucket, grown up to the snapshot day."""
    same = _open_beside_snapshot(trailing, keyed_snapshot, family).where(F.col("_day_key") == F.col(family.key_column))
    grown = same.withColumns(
        {"end_date": F.col("_day"), "day_length": calendar_length(F.col("start_date"), F.col("_day"))}
    )
    return metric_columns(grown, family)


def switch_streaks(trailing: DataFrame, keyed_snapshot: DataFrame, family: BucketFamily) -> DataFrame:
    """Open streaks whose stock changed bucket: the old streak as it is, and a new one of one day."""
    other = _open_beside_snapshot(trailing, keyed_snapshot, family).where(F.col("_day_key") != F.col(family.key_column))
    old = _struct(family, F.col("start_date"), F.col("end_date"), F.col(family.key_column))
    new = _struct(family, F.col("_day"), F.col("_day"), F.col("_day_key"))
    return metric_columns(other.select(F.inline(F.array(old, new))), family)


def open_streaks(metric: DataFrame, keyed_snapshot: DataFrame, family: BucketFamily) -> DataFrame:
    """First streaks of stocks the mart does not know yet."""
    unknown = keyed_snapshot.join(metric.select("stock"), "stock", "left_anti")
    day = F.col("stock_valuation_date")
    return metric_columns(unknown.withColumns({"start_date": day, "end_date": day, "day_length": F.lit(1)}), family)


def advance_one_day(metric: DataFrame, snapshot: DataFrame, family: BucketFamily) -> DataFrame:
    """Rows to merge into ``metric`` for a snapshot of one new day per stock.

    The extended, switched and first streaks of the functions above, from one
    join of the snapshot with the open streaks. A day without a bucket leaves
    no trace here; ``advance`` is the way where ``null_policy="null"`` is used.
    """
    key, day = F.col(family.key_column), F.col("_day")
    fresh = snapshot_with_key(snapshot, family).select(
        "stock", F.col("stock_valuation_date").alias("_day"), F.col(family.key_column).alias("_day_key")
    )
    beside = fresh.join(trailing_streaks(metric), "stock", "left")
    old = _struct(family, F.col("start_date"), F.col("end_date"), key)
    grown = _struct(family, F.col("start_date"), day, key)
    new = _struct(family, day, day, F.col("_day_key"))
    rows = F.when(key.isNull(), F.array(new)).when(key == F.col("_day_key"), F.array(grown)).otherwise(F.array(old, new))
    later = beside.where(key.isNull() | (day > F.col("end_date")))
    return metric_columns(later.select(F.inline(rows)), family)


def upsert_streaks(metric: DataFrame, rows: DataFrame) -> DataFrame:
    """Merge on (stock, start_date). Merging the same rows again changes nothing."""
    return upsert(metric, rows, STREAK_KEY)


def _stored_spans(stored: DataFrame, key: str, last_days: DataFrame | None) -> DataFrame:
    spans = stored.select("stock", key, "start_date", "end_date", F.lit(True).alias("_stored"))
    if last_days is None:
        return spans.withColumn("_ended", F.lit(False))
    newest = last_days.groupBy("stock").agg(F.max("stock_valuation_date").alias("_last_day"))
    ended = F.coalesce(F.col("_last_day") > F.col("end_date"), F.lit(False))
    return spans.join(newest, "stock", "left").withColumn("_ended", ended).drop("_last_day")


def advance(
    stored: DataFrame | None, new_days: DataFrame, family: BucketFamily, last_days: DataFrame | None = None
) -> DataFrame:
    """Streak rows after any number of new days per stock, with ``is_open`` on each stock's last.

    ``stored`` holds at least the open streak of every stock; each of its rows
    enters as one pseudo-day and new days can only prolong the last. With open
    streaks alone the cost follows the new days and not the history. Days up
    to the stored end are ignored, which makes a rerun harmless. All other
    stored rows pass through unchanged.

    Under ``null_policy="null"`` days without a bucket end a streak. Those
    among ``new_days`` are seen wherever they lie; ``last_days`` (stock and
    newest classified day so far) tells of those after the stored streaks.
    """
    key = family.key_column
    fresh = with_key(new_days, family, keep_missing=True).select(
        "stock",
        key,
        F.col("stock_valuation_date").alias("start_date"),
        F.col("stock_valuation_date").alias("end_date"),
        F.lit(False).alias("_stored"),
        F.col(family.run_column).alias("_day_run"),
        F.lit(False).alias("_ended"),
    )
    spans = fresh if stored is None else place_by_stock(_stored_spans(stored, key, last_days).unionByName(fresh, allowMissingColumns=True))

    by_stock = Window.partitionBy("stock")
    order = by_stock.orderBy("start_date", F.desc("_stored"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stored_end = F.max(F.when(F.col("_stored"), F.col("end_date"))).over(whole)
    later = spans.withColumn("_stored_end", stored_end).where(
        F.col("_stored") | F.col("_stored_end").isNull() | (F.col("start_date") > F.col("_stored_end"))
    )
    before = {name: F.lag(name).over(order) for name in (key, "_day_run", "_ended")}
    unbroken = ~F.coalesce(before["_ended"], F.lit(False)) & F.coalesce(F.col("_day_run") == before["_day_run"], F.lit(True))
    same = ~F.col("_stored") & F.col(key).eqNullSafe(before[key]) & unbroken
    runs = later.withColumn("_changed", (~same).cast("int")).withColumn(
        "_run", F.sum("_changed").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    # Days without a bucket have parted the runs; they are in none themselves.
    folded = (
        runs.where(F.col(key).isNotNull())
        .groupBy("stock", "_run", key)
        .agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))
        .withColumn("day_length", calendar_length(F.col("start_date"), F.col("end_date")))
        .withColumn("is_open", F.lead("_run").over(by_stock.orderBy("_run")).isNull())
    )
    return folded.select(
        surrogate_id(F.col("start_date"), F.col("stock")).alias("id"),
        "stock",
        key,
        "start_date",
        "end_date",
        "day_length",
        "is_open",
    )


def advance_many_days(
    metric: DataFrame | None, new_days: DataFrame, family: BucketFamily, last_days: DataFrame | None = None
) -> DataFrame:
    """The whole mart after ``new_days``, in one pass over its rows and the new days; without a
    mart the full build. A table too large to pass over is kept as a ``StreakStore``.
    ``last_days`` is needed under ``null_policy="null"``, as in ``advance``."""
    if metric is None:
        return metric_full(new_days, family)
    return advance(metric, new_days, family, last_days).drop("is_open")


def _rows_seen(family: BucketFamily, params: IndicatorParams) -> int:
    """How many rows, the day's own included, the family's rolling values look at."""
    return {AVERAGE.name: params.band_rows, MOVING_AVG.name: max(params.short_rows, params.long_rows)}.get(family.name, 1)


def correction_spans(
    days: DataFrame,
    live: DataFrame,
    corrections: DataFrame,
    family: BucketFamily,
    params: IndicatorParams | None = None,
) -> DataFrame:
    """Per corrected stock the days that may have another bucket: from ``from_day`` on, before ``until_day``.

    ``until_day`` is the first day after the last corrected one on which the
    records are what they were and no rolling window reaches a corrected day;
    from there on nothing differs. NULL where that day has not come yet.
    """
    day, close = F.col("stock_valuation_date"), F.col("close_value")
    touched = corrections.groupBy("stock").agg(F.min(day).alias("from_day"), F.max(day).alias("_last"))

    def records(before: Column, name: str) -> list[Column]:
        return [
            F.min(F.when(before, F.col("minimum_value"))).alias(f"_{name}_low"),
            F.max(F.when(before, F.col("maximum_value"))).alias(f"_{name}_high"),
        ]

    stored = days.join(touched, "stock").where(day <= F.col("_last")).groupBy("stock")
    stored = stored.agg(*records(day < F.col("from_day"), "start"), *records(F.lit(True), "old"))
    fresh = live.join(touched, "stock").where(day.between(F.col("from_day"), F.col("_last")))
    fresh = fresh.groupBy("stock").agg(F.min(close).alias("_fresh_low"), F.max(close).alias("_fresh_high"))
    known = touched.join(stored, "stock", "left").join(fresh, "stock", "left")
    # Both functions pass over NULL, as the records do.
    low, high = F.least("_start_low", "_fresh_low"), F.greatest("_start_high", "_fresh_high")
    agree_low = low.eqNullSafe(F.col("_old_low")) | (close <= F.least(low, "_old_low"))
    agree_high = high.eqNullSafe(F.col("_old_high")) | (close >= F.greatest(high, "_old_high"))
    place = F.row_number().over(Window.partitionBy("stock").orderBy("stock_valuation_date"))
    later = live.join(known, "stock").where(day > F.col("_last")).withColumn("_place", place)
    first = later.groupBy("stock").agg(
        F.min(F.when(F.col("_place") >= _rows_seen(family, params or IndicatorParams()), day)).alias("_window"),
        F.min(F.when(agree_low, day)).alias("_low"),
        F.min(F.when(agree_high, day)).alias("_high"),
    )
    met = F.col("_window").isNotNull() & F.col("_low").isNotNull() & F.col("_high").isNotNull()
    until = F.when(met, F.greatest("_window", "_low", "_high")).alias("until_day")
    return touched.join(first, "stock", "left").select("stock", "from_day", until)


def _spliced(rebuilt: DataFrame, rest: DataFrame, last_days: DataFrame, family: BucketFamily) -> DataFrame:
    """Rebuilt streaks, and of each stock the rest of the stored streak in which the rebuild ends: one streak
    with the one before it if that has the same bucket and lasts until the rebuild's last day."""
    key, order = F.col(family.key_column), Window.partitionBy("stock").orderBy("start_date")
    columns = ["stock", family.key_column, "start_date", "end_date"]
    both = rebuilt.select(*columns, F.lit(False).alias("_rest")).unionByName(rest.select(*columns, F.lit(True).alias("_rest")))
    goes_on = F.col("_rest") & (F.lag(key).over(order) == key) & (F.lag("end_date").over(order) == F.col("_last_day"))
    parts = place_by_stock(both).join(last_days, "stock", "left").withColumn("_begins", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    runs = parts.withColumn("_run", F.sum("_begins").over(order))
    folded = runs.groupBy("stock", "_run", family.key_column).agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))
    return metric_columns(folded.withColumn("day_length", calendar_length(F.col("start_date"), F.col("end_date"))), family)


def correct_streaks(
    metric: DataFrame,
    days: DataFrame,
    live: DataFrame,
    corrections: DataFrame,
    family: BucketFamily,
    params: IndicatorParams | None = None,
) -> DataFrame:
    """The mart after corrections of old bars, as a rebuild over ``live`` would give it.

    ``days`` are the classified days so far, ``live`` the bars with the
    corrections in them (changed, added or removed), ``corrections`` tells
    their stocks and days. Stocks without one pass through. The others are
    classified anew within their ``correction_spans`` only: the streak that
    reached into the span is cut there and goes on from it, streaks after the
    span pass through, and the one at its end is joined on.
    """
    params = params or IndicatorParams()
    day, until = F.col("stock_valuation_date"), F.col("until_day")
    spans = correction_spans(days, live, corrections, family, params)
    before = days.join(spans, "stock").where(day < F.col("from_day")).select(*days.columns)
    within = live.join(spans, "stock").where((day >= F.col("from_day")) & (until.isNull() | (day < until))).select(*live.columns)
    again = classify_increment(history_tail(before, params), within, params)
    newest = before.groupBy("stock").agg(F.max(day).alias("_newest"))
    end = F.least("end_date", "_newest")
    touched = metric.join(spans, "stock")
    kept = (
        touched.where(F.col("start_date") < F.col("from_day"))
        .join(newest, "stock")
        .withColumns({"end_date": end, "day_length": calendar_length(F.col("start_date"), end)})
        .select(*metric.columns)
    )
    rebuilt = advance(kept, again, family, before)
    rest = touched.where((F.col("start_date") <= until) & (F.col("end_date") >= until)).withColumn("start_date", until)
    ends = place_by_stock(before.select("stock", day).unionByName(within.select("stock", day))).groupBy("stock").agg(F.max(day).alias("_last_day"))
    corrected = _spliced(rebuilt, rest, ends, family)
    beside = metric.join(spans, "stock", "left")
    untouched = beside.where(F.col("from_day").isNull() | ((F.col("start_date") >= F.col("from_day")) & (F.col("start_date") > until)))
    return untouched.select(*metric.columns).unionByName(corrected)


def build_or_advance(
    metric: DataFrame | None, new_days: DataFrame, family: BucketFamily, last_days: DataFrame | None = None
) -> DataFrame:
    """Picks the full build for a missing or empty mart after looking at one row of it."""
    if metric is None or metric.isEmpty():
        return metric_full(new_days, family)
    return advance_many_days(metric, new_days, family, last_days)
