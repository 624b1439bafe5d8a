"""Back-test of the two-bucket strategy on classified days, in set operations.

Buy after two days in ``higher_range``, at the second day's close; sell after
two days in ``near_record_high`` that both lie over the purchase price, at
the second day's close. Each ``higher_range`` streak is bought once, with the
same capital, and each purchase ends with its first better sale.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline import schemas
from streakline.families import HIGH_LOW
from streakline.operators.indicators import by_day
from streakline.operators.streaks import with_key
from streakline.session import scratch_path

KEY = HIGH_LOW.key_column
BUY_KEY, SELL_KEY = 4, 5
CAPITAL = Decimal(10_000)
BLOCK = 32


def streak_days(live: DataFrame, metric: DataFrame, key_column: str = KEY) -> DataFrame:
    """Live days joined with the streak they lie in (``start_date <= day <= end_date``).

    Streaks of a stock do not overlap, so the only candidate for a day is the
    last streak begun by then; overlapping ones are an error, found on the way.
    Both sides are merged in day order in one pass: linear, whatever the
    lengths, where an interval condition would compare every day with every
    streak.
    """
    columns = [key_column, "start_date", "end_date", "day_length"]
    bars = live.select("stock", "stock_valuation_date", "close_value", F.lit(True).alias("_is_bar"))
    begun = metric.select(
        "stock", F.col("start_date").alias("stock_valuation_date"), F.struct(*columns).alias("_begun"), F.lit(False).alias("_is_bar")
    )
    in_order = (
        Window.partitionBy("stock")
        .orderBy("stock_valuation_date", "_is_bar")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    merged = bars.unionByName(begun, allowMissingColumns=True).withColumns(
        {
            "_streak": F.last("_begun", ignorenulls=True).over(in_order),
            "_ended": F.max("_begun.end_date").over(before),
        }
    )
    overlap = ~F.col("_is_bar") & (F.col("_ended") >= F.col("stock_valuation_date"))
    fault = F.raise_error(F.concat(F.lit("streaks overlap: "), F.concat_ws(", ", "stock", F.col("stock_valuation_date").cast("string"))))
    inside = F.when(overlap, fault.cast("boolean")).otherwise(F.col("_is_bar") & (F.col("stock_valuation_date") <= F.col("_streak.end_date")))
    return merged.where(inside).select(
        "stock", "stock_valuation_date", "close_value", *(F.col(f"_streak.{name}") for name in columns)
    )


def streak_running_extremes(days: DataFrame, key_column: str = KEY) -> DataFrame:
    """Streak days with first day, last day, lowest and highest close up to that day."""
    streak = (
        Window.partitionBy("stock", "start_date")
        .orderBy("stock_valuation_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return days.select(
        "stock",
        "stock_valuation_date",
        "close_value",
        F.min("stock_valuation_date").over(streak).alias("start_date"),
        F.max("stock_valuation_date").over(streak).alias("end_date"),
        F.min("close_value").over(streak).alias("running_min_close"),
        F.max("close_value").over(streak).alias("running_max_close"),
        key_column,
        "day_length",
    )


def ticker_filter(days: DataFrame, ticker: str) -> DataFrame:
    return days.where(F.col("stock") == ticker)


def keyed_days(classified_days: DataFrame) -> DataFrame:
    """Classified days in the columns of the back-test; ``streak_run`` tells streaks apart."""
    return with_key(classified_days, HIGH_LOW).select(
        "stock",
        "stock_valuation_date",
        F.col("stock_value").alias("close_value"),
        KEY,
        F.col(HIGH_LOW.run_column).alias("streak_run"),
    )


def next_day_lookup(days: DataFrame) -> DataFrame:
    """Each day with the next day's date, close and bucket; NULL on the last day."""
    return days.withColumns(
        {
            "next_date": F.lead("stock_valuation_date").over(by_day()),
            "next_close": F.lead("close_value").over(by_day()),
            "next_key": F.lead(KEY).over(by_day()),
        }
    )


def _stays_in(key: int) -> Column:
    """Both days in the bucket, both with a price."""
    priced = F.col("close_value").isNotNull() & F.col("next_close").isNotNull()
    return (F.col(KEY) == key) & (F.col("next_key") == key) & priced


def _signal_columns() -> list[Column]:
    return [
        F.col("stock"),
        F.col("stock_valuation_date").alias("signal_date"),
        F.col("next_date").alias("trade_date"),
        F.col("next_close").alias("price"),
        F.col("streak_run"),
    ]


def buy_signals(days: DataFrame) -> DataFrame:
    """Second days in ``higher_range``."""
    return next_day_lookup(days).where(_stays_in(BUY_KEY)).select(*_signal_columns())


def sell_candidates(days: DataFrame, cost: Decimal | None = None) -> DataFrame:
    """Second days in ``near_record_high``; they sell anything that cost less than ``floor_price``."""
    floor = F.least("close_value", "next_close")
    sells = next_day_lookup(days).where(_stays_in(SELL_KEY)).select(*_signal_columns(), floor.alias("floor_price"))
    return sells if cost is None else sells.where(F.col("floor_price") > F.lit(cost))


def signals(days: DataFrame) -> DataFrame:
    """Buy and sell candidates of one pass over the days; buys have no ``floor_price``."""
    floor = F.when(F.col(KEY) == SELL_KEY, F.least("close_value", "next_close"))
    both = next_day_lookup(days).where(_stays_in(BUY_KEY) | _stays_in(SELL_KEY))
    return both.select(*_signal_columns(), (F.col(KEY) == BUY_KEY).alias("is_buy"), floor.alias("floor_price"))


def _numbered(candidates: DataFrame) -> DataFrame:
    """Signals with ``k``: a sell's number in its stock, a buy's number of the next sell; and the numbers of its
    block of ``BLOCK`` sells and of its block of blocks. Written once, because the search reads them several times."""
    earlier = Window.partitionBy("stock").orderBy("signal_date").rowsBetween(Window.unboundedPreceding, -1)
    k = F.coalesce(F.sum((~F.col("is_buy")).cast("int")).over(earlier), F.lit(0))
    numbered = candidates.withColumn("k", k).withColumns({"block": F.floor(F.col("k") / BLOCK), "super": F.floor(F.col("k") / BLOCK**2)})
    path = scratch_path(candidates.sparkSession, "signals")
    numbered.write.parquet(path)
    return candidates.sparkSession.read.schema(numbered.schema).parquet(path)


def _first_better_sale(numbered: DataFrame) -> DataFrame:
    """Buys with ``sale``, the first later sell whose floor beats the price.

    Only the buy's own block, the first later block of the same super-block whose highest floor beats the price, and
    the first such block of the first such super-block can hold it. Each step compares a buy with at most ``BLOCK``
    maxima (37 on the last level: a stock has one sell a day), whatever the length of the history."""
    place = ["stock", "signal_date"]
    buys = numbered.where("is_buy").select("stock", "signal_date", "trade_date", "price", "streak_run", "k", "block", "super")
    sells = numbered.where("not is_buy")
    sold = F.struct("k", "signal_date", "trade_date", "price", "streak_run").alias("sale")
    blocks = sells.groupBy("stock", "super", "block").agg(F.max("floor_price").alias("top"))
    supers = blocks.groupBy("stock", "super").agg(F.max("top").alias("top"))

    ahead = buys.alias("b").join(supers.alias("u"), F.expr("b.stock = u.stock and u.super > b.super and u.top > b.price"))
    next_super = ahead.groupBy("b.stock", "b.signal_date").agg(F.min("u.super").alias("next_super"))
    wide = buys.join(next_super, place, "left").withColumn("look", F.explode(F.array_compact(F.array("super", "next_super"))))
    ahead = wide.alias("b").join(
        blocks.alias("u"), F.expr("b.stock = u.stock and b.look = u.super and u.block > b.block and u.top > b.price")
    )
    next_block = ahead.groupBy("b.stock", "b.signal_date").agg(F.min("u.block").alias("next_block"))
    wide = buys.join(next_block, place, "left").withColumn("look", F.explode(F.array_compact(F.array("block", "next_block"))))
    ahead = wide.alias("b").join(
        sells.select("stock", "block", "floor_price", sold).alias("s"),
        F.expr("b.stock = s.stock and b.look = s.block and s.sale.k >= b.k and s.floor_price > b.price"),
    )
    first = ahead.groupBy("b.stock", "b.signal_date").agg(F.min("s.sale").alias("sale"))
    return buys.join(first, place, "left")


def round_trips(candidates: DataFrame) -> DataFrame:
    """For every buy candidate the first later sell candidate that beats its price. ``candidates`` are ``signals``."""
    return (
        _first_better_sale(_numbered(candidates))
        .where(F.col("sale").isNotNull())
        .select(
            "stock",
            F.col("trade_date").alias("purchased_date"),
            F.col("price").alias("purchased_price"),
            F.col("sale.trade_date").alias("sale_date"),
            F.col("sale.price").alias("sale_unit_price"),
        )
    )


def streak_trades(candidates: DataFrame, capital: Decimal = CAPITAL) -> DataFrame:
    """One trade per ``higher_range`` streak: its first buy signal, and the first better sale after it.

    Every trade starts with ``capital``; shares are rounded half up to three digits. A purchase never
    sold has NULL sale columns."""
    numbered = _numbered(candidates)
    in_streak = Window.partitionBy("stock", "streak_run", "is_buy").orderBy("signal_date")
    first = numbered.withColumn("_nth", F.row_number().over(in_streak)).where("not is_buy or (_nth = 1 and price > 0)").drop("_nth")
    shares = F.round(F.lit(capital).cast("decimal(12,4)") / F.col("price"), 3).cast("decimal(20,3)")
    return _first_better_sale(first).select(
        "stock",
        shares.alias("shares"),
        F.col("signal_date").alias("purchase_signal_date"),
        F.col("trade_date").alias("purchased_date"),
        F.col("price").alias("purchased_price"),
        F.col("streak_run").alias("purchase_run"),
        F.col("sale.signal_date").alias("sale_signal_date"),
        F.col("sale.trade_date").alias("sale_date"),
        F.col("sale.price").alias("sale_unit_price"),
        (shares * F.col("sale.price")).cast("decimal(38,7)").alias("sale_price"),
        F.col("sale.streak_run").alias("sale_run"),
    )


def streak_price_window(days: DataFrame) -> DataFrame:
    """Lowest and highest close of each streak with the first days they occurred."""
    low = F.min(F.struct("close_value", "stock_valuation_date"))
    high = F.min(F.struct((-F.col("close_value")).alias("negated"), F.col("stock_valuation_date")))
    return (
        days.where(F.col("close_value").isNotNull())
        .groupBy("stock", "streak_run")
        .agg(low.alias("low"), high.alias("high"))
        .select(
            "stock",
            "streak_run",
            F.col("low.close_value").alias("min_close"),
            F.col("low.stock_valuation_date").alias("min_date"),
            (-F.col("high.negated")).cast(schemas.PRICE).alias("max_close"),
            F.col("high.stock_valuation_date").alias("max_date"),
        )
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def purchase_breakdown(trades: DataFrame, days: DataFrame) -> DataFrame:
    """Every purchase beside the best and worst price of its ``higher_range`` streak."""
    window = streak_price_window(days.where(F.col(KEY) == BUY_KEY)).withColumnRenamed("streak_run", "purchase_run")
    bought, low = F.col("purchased_price"), F.col("min_close")
    return trades.join(window, ["stock", "purchase_run"]).select(
        "stock",
        "purchase_signal_date",
        "purchased_date",
        "purchased_price",
        low.alias("min_window_price"),
        F.col("min_date").alias("min_price_date"),
        F.col("max_close").alias("max_window_price"),
        F.col("max_date").alias("max_price_date"),
        _percent(bought - low, bought).alias("drawdown_pct"),
    )


def sale_breakdown(trades: DataFrame, days: DataFrame) -> DataFrame:
    """Every sale beside what the same shares were worth at the extremes of its
    ``near_record_high`` streak. The percentage is taken on unit prices, which is the same ratio."""
    window = streak_price_window(days.where(F.col(KEY) == SELL_KEY)).withColumnRenamed("streak_run", "sale_run")
    sold, high = F.col("sale_unit_price"), F.col("max_close")

    def worth(unit_price: str) -> Column:
        return (F.col("shares") * F.col(unit_price)).cast("decimal(38,7)")

    return trades.join(window, ["stock", "sale_run"]).select(
        "stock",
        "sale_signal_date",
        "sale_date",
        "sale_price",
        worth("min_close").alias("min_window_sale"),
        F.col("min_date").alias("min_sale_date"),
        worth("max_close").alias("max_window_sale"),
        F.col("max_date").alias("max_sale_date"),
        _percent(high - sold, sold).alias("potential_increment_pct"),
    )


def _worst(breakdown: DataFrame, percent: str, *ties: str | Column) -> DataFrame:
    order = Window.partitionBy("stock").orderBy(F.desc(percent), *ties)
    return breakdown.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def max_drawdown(purchases: DataFrame) -> DataFrame:
    """Each stock's purchase with the deepest draw-down."""
    return _worst(purchases, "drawdown_pct", "purchased_date")


def max_increment(sales: DataFrame) -> DataFrame:
    """Each stock's sale that left the most on the table; of equal ones the first, then the largest."""
    return _worst(sales, "potential_increment_pct", "sale_date", F.desc("sale_price"))


def stable_stocks(days: DataFrame, months: int = 36) -> DataFrame:
    """Whether each stock spent its last ``months`` in the two upper buckets only.

    Compares two maxima of one aggregation instead of filtering by the
    stock's own last day.
    """
    outside = F.when(~F.col(KEY).isin(BUY_KEY, SELL_KEY), F.col("stock_valuation_date"))
    dates = days.groupBy("stock").agg(
        F.max("stock_valuation_date").alias("last_date"), F.max(outside).alias("last_outside_date")
    )
    since = F.add_months("last_date", -months)
    return dates.withColumn(
        "is_stable", F.col("last_outside_date").isNull() | (F.col("last_outside_date") <= since)
    )
