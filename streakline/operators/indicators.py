"""Record extremes, rolling band, moving averages, and the classified day.

A stock has one bar per calendar day, so its history is bounded by the
calendar (some 37,000 days in a century) however many raw rows stood behind
it; one window partition per stock is safe, and stocks spread over tasks.

Rolling sums are differences of running sums. The sums are exact integers
(prices in units of 1/10000), so a frame of any length costs one subtraction
per row and two averages compare without rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streakline import schemas
from streakline.config import IndicatorParams
from streakline.families import AVERAGE, FAMILIES, HIGH_LOW, MOVING_AVG, BucketFamily
from streakline.functions.classify import classify_average, classify_crossover, classify_high_low
from streakline.functions.keys import surrogate_id
from streakline.operators.spread import place_by_stock

DEFAULTS = IndicatorParams()
UNITS = 10_000

CLASSIFIED_COLUMNS = schemas.CLASSIFIED.names

# Running number, sum and sum of squares of a stock's closes, as whole numbers.
RUNNING = T.StructType(
    [
        T.StructField("_count", T.LongType()),
        T.StructField("_sum", T.LongType()),
        T.StructField("_squares", T.DecimalType(37, 0)),
    ]
)
_HISTORY = {f"{f.name}_history": f.dataType for f in RUNNING}

# One row per stock: its newest day with records, buckets and runs, and the running sums of its last days.
_CARRIED = ("minimum_value", "maximum_value", *(name for f in FAMILIES for name in (f.bucket_column, f.run_column)))
_NEWEST = ("stock_valuation_date", *_CARRIED)
STATE = T.StructType([*(schemas.CLASSIFIED[name] for name in ("stock", *_NEWEST)), *(T.StructField(name, T.ArrayType(kind)) for name, kind in _HISTORY.items())])


def by_day() -> WindowSpec:
    return Window.partitionBy("stock").orderBy("stock_valuation_date")


def so_far() -> WindowSpec:
    return by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def record_extremes(bars: DataFrame, value: str = "close_value") -> DataFrame:
    """Lowest and highest close up to and including each day."""
    return bars.withColumns(
        {"minimum_value": F.min(value).over(so_far()), "maximum_value": F.max(value).over(so_far())}
    )


def _with_running_sums(df: DataFrame, value: str) -> DataFrame:
    units = (F.col(value) * UNITS).cast("bigint")
    square = units.cast("decimal(13,0)") * units.cast("decimal(13,0)")
    return df.withColumns(
        {
            "_count": F.count(value).over(so_far()),
            "_sum": F.coalesce(F.sum(units).over(so_far()), F.lit(0)),
            "_squares": F.coalesce(F.sum(square).over(so_far()), F.lit(0)),
        }
    )


def _lagged(running: str, rows: int) -> Column:
    return F.lag(running, rows).over(by_day())


def _last_rows(running: str, rows: int, before: Callable[[str, int], Column]) -> Column:
    """The sum over the last ``rows`` rows; fewer at the start of a history. ``before`` gives the
    running sum ``rows`` rows earlier."""
    return F.col(running) - F.coalesce(before(running, rows), F.lit(0))


def _mean(total: str, count: str, min_periods: int) -> Column:
    mean = F.try_divide(F.col(total).cast("double"), (F.col(count) * UNITS).cast("double"))
    return F.when(F.col(count) >= min_periods, mean)


def _spread(params: IndicatorParams) -> Column:
    """count * (count - 1) * variance in units, an exact whole number; NULL below two rows."""
    n = F.col("_n_band").cast("decimal(5,0)")
    s = F.col("_s_band").cast("decimal(19,0)")
    return F.when(F.col("_n_band") >= max(2, params.min_periods), n * F.col("_q_band") - s * s)


def _deviation(params: IndicatorParams) -> Column:
    n = F.col("_n_band")
    variance = F.try_divide(_spread(params).cast("double"), (n * (n - 1)).cast("double"))
    return F.sqrt(variance) / F.lit(float(UNITS))


def _band_bucket(params: IndicatorParams) -> Column:
    """The band rule with value, mean and deviation multiplied by the count and squared, signs
    kept. Whole numbers only, so a close exactly on an edge is recognised as such."""
    n = F.col("_n_band")
    gap = n * (F.col("stock_value") * UNITS).cast("bigint") - F.col("_s_band")
    square = gap.cast("decimal(19,0)") * gap.cast("decimal(19,0)")
    signed = F.signum(gap).cast("decimal(1,0)") * square * (n - 1).cast("decimal(5,0)")
    return classify_average(
        signed, F.lit(0).cast("decimal(1,0)"), n.cast("decimal(5,0)") * _spread(params), params.null_policy
    )


def _with_band(df: DataFrame, params: IndicatorParams, before: Callable[[str, int], Column] = _lagged) -> DataFrame:
    rows = params.band_rows
    return (
        df.withColumns(
            {
                "_n_band": _last_rows("_count", rows, before),
                "_s_band": _last_rows("_sum", rows, before),
                "_q_band": _last_rows("_squares", rows, before),
            }
        )
        .withColumns(
            {
                "avg_90": _mean("_s_band", "_n_band", params.min_periods),
                "stddev_90": _deviation(params),
            }
        )
    )


def _with_averages(df: DataFrame, params: IndicatorParams, before: Callable[[str, int], Column] = _lagged) -> DataFrame:
    return (
        df.withColumns(
            {
                "_n_short": _last_rows("_count", params.short_rows, before),
                "_s_short": _last_rows("_sum", params.short_rows, before),
                "_n_long": _last_rows("_count", params.long_rows, before),
                "_s_long": _last_rows("_sum", params.long_rows, before),
            }
        )
        .withColumns(
            {
                "avg_short": _mean("_s_short", "_n_short", params.min_periods),
                "avg_long": _mean("_s_long", "_n_long", params.min_periods),
            }
        )
    )


def rolling_avg_stddev(bars: DataFrame, params: IndicatorParams = DEFAULTS, value: str = "close_value") -> DataFrame:
    """Mean and sample deviation of the last ``band_rows`` closes, NULL closes skipped."""
    banded = _with_band(_with_running_sums(bars, value), params)
    return banded.select(*bars.columns, "avg_90", "stddev_90")


def moving_averages(bars: DataFrame, params: IndicatorParams = DEFAULTS, value: str = "close_value") -> DataFrame:
    """Means of the last ``short_rows`` and ``long_rows`` closes, NULL closes skipped."""
    averaged = _with_averages(_with_running_sums(bars, value), params)
    return averaged.select(*bars.columns, "avg_short", "avg_long")


def with_runs(df: DataFrame, family: BucketFamily) -> DataFrame:
    """Run number per stock, from 1, that grows whenever the bucket differs from the day before."""
    return _with_runs(df, (family,))


def _with_runs(df: DataFrame, families: tuple[BucketFamily, ...], counted_days: Column | None = None) -> DataFrame:
    def changed(family: BucketFamily) -> Column:
        before = F.lag(family.bucket_column).over(by_day())
        first = F.lag(F.lit(1)).over(by_day()).isNull()
        differs = first | ~F.col(family.bucket_column).eqNullSafe(before)
        return (differs if counted_days is None else counted_days & differs).cast("bigint")

    flags = df.withColumns({f"_new_{f.name}": changed(f) for f in families})
    counted = flags.withColumns({f.run_column: F.sum(f"_new_{f.name}").over(so_far()) for f in families})
    return counted.drop(*(f"_new_{f.name}" for f in families))


def _with_buckets(df: DataFrame, params: IndicatorParams) -> DataFrame:
    """The three buckets, from exact numbers; the crossover compares sum/count pairs crosswise."""
    value, policy = F.col("stock_value"), params.null_policy
    full_short = F.when(F.col("_n_short") >= params.min_periods, F.col("_s_short") * F.col("_n_long"))
    full_long = F.when(F.col("_n_long") >= params.min_periods, F.col("_s_long") * F.col("_n_short"))
    return df.withColumns(
        {
            HIGH_LOW.bucket_column: classify_high_low(
                value, F.col("maximum_value"), F.col("minimum_value"), params.position_bounds, policy
            ),
            AVERAGE.bucket_column: _band_bucket(params),
            MOVING_AVG.bucket_column: classify_crossover(full_short, full_long, policy),
        }
    )


def _measured(days: DataFrame, params: IndicatorParams) -> DataFrame:
    return _with_averages(_with_band(_with_running_sums(days, "stock_value"), params), params)


def _looked_back_on(params: IndicatorParams) -> list[tuple[str, int]]:
    """Each running sum with the numbers of rows by which the indicators look back on it."""
    every = sorted({params.band_rows, params.short_rows, params.long_rows})
    return [*((running, rows) for running in ("_count", "_sum") for rows in every), ("_squares", params.band_rows)]


def classified(bars: DataFrame, params: IndicatorParams = DEFAULTS, carry: Sequence[str] = ()) -> DataFrame:
    """Indicators, buckets and runs of every stock-day, plus the bar columns named in ``carry``.

    All windows share one partitioning and order: one shuffle and one sort.
    Columns a caller does not use are pruned together with their windows.
    """
    days = bars.select("stock", "stock_valuation_date", F.col("close_value").alias("stock_value"), *carry)
    measured = _measured(record_extremes(days, "stock_value"), params)
    return _with_runs(_with_buckets(measured, params), FAMILIES).select(*CLASSIFIED_COLUMNS, *carry)


def history_tail(classified_days: DataFrame, params: IndicatorParams = DEFAULTS) -> DataFrame:
    """What the next days' indicators need of each stock: its last closes, and on the newest row
    also the record extremes, buckets and run numbers. Older rows carry NULL there, so the tail
    stays small on disk."""
    newest_first = Window.partitionBy("stock").orderBy(F.desc("stock_valuation_date"))
    ranked = classified_days.withColumn("_rank", F.row_number().over(newest_first))
    carried = [name for name in CLASSIFIED_COLUMNS if name not in ("stock", "stock_valuation_date", "stock_value")]
    return ranked.where(F.col("_rank") <= params.history_rows).select(
        "stock",
        "stock_valuation_date",
        "stock_value",
        *(F.when(F.col("_rank") == 1, F.col(name)).alias(name) for name in carried),
    )


def classify_increment(tail: DataFrame, new_bars: DataFrame, params: IndicatorParams = DEFAULTS) -> DataFrame:
    """Classified rows of ``new_bars`` alone, as a full rebuild would give them.

    ``tail`` is ``history_tail`` of the days so far. New bars lie after their
    stock's tail.
    """
    kept = [name for f in FAMILIES for name in (f.bucket_column, f.run_column)]
    stored = tail.select(
        "stock",
        "stock_valuation_date",
        "stock_value",
        "minimum_value",
        "maximum_value",
        *(F.col(name).alias(f"_{name}") for name in kept),
        F.lit(False).alias("_fresh"),
    )
    close = F.col("close_value")
    fresh = new_bars.select(
        "stock",
        "stock_valuation_date",
        close.alias("stock_value"),
        close.alias("minimum_value"),
        close.alias("maximum_value"),
        F.lit(True).alias("_fresh"),
    )
    days = place_by_stock(stored.unionByName(fresh, allowMissingColumns=True)).withColumns(
        {
            "minimum_value": F.min("minimum_value").over(so_far()),
            "maximum_value": F.max("maximum_value").over(so_far()),
        }
    )
    is_fresh = F.col("_fresh")
    buckets = _with_buckets(_measured(days, params), params).withColumns(
        {f.bucket_column: F.when(is_fresh, F.col(f.bucket_column)).otherwise(F.col(f"_{f.bucket_column}")) for f in FAMILIES}
    )
    runs = _with_runs(buckets, FAMILIES, is_fresh).withColumns(
        {
            f.run_column: F.col(f.run_column) + F.coalesce(F.max(f"_{f.run_column}").over(so_far()), F.lit(0))
            for f in FAMILIES
        }
    )
    return runs.where(is_fresh).select(*CLASSIFIED_COLUMNS)


def classify_onto(state: DataFrame | None, new_bars: DataFrame, params: IndicatorParams = DEFAULTS) -> DataFrame:
    """Classified rows of ``new_bars`` alone, as a full rebuild would give them, with the running sums.

    ``state`` is ``history_state`` of the days so far, or None. New bars lie after their stock's
    state. Windows run over the new days only, which then meet their stock's one row; a sum that
    begins before them is looked up in its arrays.
    """
    days = place_by_stock(new_bars.select("stock", "stock_valuation_date", F.col("close_value").alias("stock_value")))
    sums = _with_running_sums(record_extremes(days, "stock_value"), "stock_value")
    if state is None:
        measured = _with_averages(_with_band(sums, params), params)
        return _with_runs(_with_buckets(measured, params), FAMILIES).select(*CLASSIFIED_COLUMNS, *RUNNING.names)

    looked_back = _looked_back_on(params)
    own = sums.withColumns(
        {
            "_place": F.row_number().over(by_day()),
            **{f"{running}_{rows}": _lagged(running, rows) for running, rows in looked_back},
        }
    )
    stored = state.select("stock", *(F.col(name).alias(f"_old_{name}") for name in _CARRIED), *_HISTORY, F.lit(True).alias("_known"))
    joined = own.join(stored, "stock", "left")

    def last(running: str) -> Column:
        history = F.col(f"{running}_history")
        return F.coalesce(F.get(history, F.size(history) - 1), F.lit(0))

    def total(running: T.StructField) -> Column:
        return (F.col(running.name) + last(running.name)).cast(running.dataType)

    def earlier(running: str, rows: int) -> Column:
        history = F.col(f"{running}_history")
        among_new = F.col(f"{running}_{rows}") + last(running)
        return F.coalesce(among_new, F.get(history, F.size(history) + F.col("_place") - F.lit(rows + 1))).cast(RUNNING[running].dataType)

    summed = joined.select(
        "stock",
        "stock_valuation_date",
        "stock_value",
        F.least("minimum_value", "_old_minimum_value").alias("minimum_value"),
        F.greatest("maximum_value", "_old_maximum_value").alias("maximum_value"),
        *(total(running).alias(running.name) for running in RUNNING),
        *(earlier(running, rows).alias(f"{running}_{rows}") for running, rows in looked_back),
        "_place",
        "_known",
        *(f"_old_{name}" for name in _CARRIED[2:]),
    )

    def before(running: str, rows: int) -> Column:
        return F.col(f"{running}_{rows}")

    buckets = _with_buckets(_with_averages(_with_band(summed, params, before), params, before), params)
    begins = F.col("_place") == 1

    def changed(family: BucketFamily) -> Column:
        stored_or_before = F.when(begins, F.col(f"_old_{family.bucket_column}")).otherwise(F.lag(family.bucket_column).over(by_day()))
        first = begins & F.col("_known").isNull()
        return (first | ~F.col(family.bucket_column).eqNullSafe(stored_or_before)).cast("bigint")

    flags = buckets.withColumns({f"_new_{f.name}": changed(f) for f in FAMILIES})
    runs = flags.withColumns(
        {
            f.run_column: F.sum(f"_new_{f.name}").over(so_far()) + F.coalesce(F.col(f"_old_{f.run_column}"), F.lit(0))
            for f in FAMILIES
        }
    )
    return runs.select(*CLASSIFIED_COLUMNS, *RUNNING.names)


def history_state(state: DataFrame | None, days: DataFrame, params: IndicatorParams = DEFAULTS) -> DataFrame:
    """What the next days' indicators need of each stock of ``days``, as one row: ``classify_onto`` of the
    days taken in last and ``state`` of those before. The arrays are bounded: one entry more than
    ``history_rows``, the sum before the first row a window can reach, and as many squares as the band has rows."""
    entry = F.struct("stock_valuation_date", *RUNNING.names)
    by_stock = place_by_stock(days).groupBy("stock").agg(
        F.sort_array(F.collect_list(entry)).alias("_entries"),
        F.max_by(F.struct(*_NEWEST), "stock_valuation_date").alias("_newest"),
    )
    lengths = {name: params.band_rows if name == "_squares_history" else params.history_rows + 1 for name in _HISTORY}
    known = by_stock.select("stock", "_newest.*", *(F.col("_entries")[f.name].alias(f"{f.name}_history") for f in RUNNING))
    if state is None:
        both = {name: F.col(name) for name in _HISTORY}
    else:
        known = known.join(state.select("stock", *(F.col(name).alias(f"_old{name}") for name in _HISTORY)), "stock", "left")
        both = {name: F.concat(F.coalesce(F.col(f"_old{name}"), F.array().cast(T.ArrayType(kind))), name) for name, kind in _HISTORY.items()}
    last = [F.slice(c, F.greatest(F.size(c) - lengths[name] + 1, F.lit(1)), lengths[name]).alias(name) for name, c in both.items()]
    return known.select("stock", *_NEWEST, *last)


def last_snapshot(classified_days: DataFrame) -> DataFrame:
    """The newest classified row of each stock, in snapshot columns.

    Looks ahead in the order that freshly classified rows already have instead of sorting again;
    ``last_snapshot_of_stored`` is the way for a table.
    """
    following = F.lead("stock_valuation_date").over(by_day())
    newest = classified_days.withColumn("_next", following).where(F.col("_next").isNull())
    return snapshot_columns(newest)


def last_snapshot_of_stored(classified_days: DataFrame) -> DataFrame:
    """The same from a stored table: each task sends one row per stock, nothing is sorted by day."""
    whole = F.struct(*classified_days.columns)
    newest = classified_days.groupBy("stock").agg(F.max_by(whole, "stock_valuation_date").alias("_newest"))
    return snapshot_columns(newest.select("_newest.*"))


def snapshot_columns(days: DataFrame) -> DataFrame:
    return days.select(
        surrogate_id(F.col("stock_valuation_date"), F.col("stock")).alias("id"),
        "stock_valuation_date",
        "stock",
        "stock_value",
        HIGH_LOW.bucket_column,
        F.col("minimum_value").alias("minimum_close"),
        F.col("maximum_value").alias("maximum_close"),
        AVERAGE.bucket_column,
        MOVING_AVG.bucket_column,
    )
