"""Data-quality checks. Each returns the failing rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from streakline.functions.calendar import calendar_length
from streakline.operators.spread import place_by_stock


def freshness(live: DataFrame, metric: DataFrame) -> DataFrame:
    """Live rows after their stock's newest streak end, or of a stock without streaks."""
    newest = metric.groupBy("stock").agg(F.max("end_date").alias("newest_end_date"))
    stale = F.col("newest_end_date").isNull() | (F.col("stock_valuation_date") > F.col("newest_end_date"))
    return live.join(newest, "stock", "left").where(stale)


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in one of ``columns``, and which columns those are."""
    empty = F.array_compact(F.array(*(F.when(F.col(name).isNull(), F.lit(name)) for name in columns)))
    return df.withColumn("null_columns", F.concat_ws(",", empty)).where(F.col("null_columns") != "")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the domain with their row counts; NULL is not a value."""
    unexpected = df.where(~F.col(column).isin(list(values)))
    return unexpected.groupBy(F.col(column).alias("unexpected_value")).agg(F.count(F.lit(1)).alias("row_count"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    known = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti").select(*child.columns)


def streak_cover(live: DataFrame, metric: DataFrame) -> DataFrame:
    """Live days that do not lie in exactly one streak, and in how many they lie.

    A running count of streaks begun and ended gives the number for any
    intervals, overlapping or not, without listing their days.
    """
    day = F.col("stock_valuation_date")
    bars = live.select("stock", day, F.lit(0).alias("_opens"), F.lit(True).alias("_is_bar"))
    edges = F.array(
        F.struct(F.col("start_date").alias("stock_valuation_date"), F.lit(1).alias("_opens")),
        F.struct(F.date_add("end_date", 1).alias("stock_valuation_date"), F.lit(-1).alias("_opens")),
    )
    steps = metric.select("stock", F.inline(edges), F.lit(False).alias("_is_bar"))
    in_order = (
        Window.partitionBy("stock")
        .orderBy("stock_valuation_date", "_is_bar")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = place_by_stock(bars.unionByName(steps)).withColumn("streak_count", F.sum("_opens").over(in_order))
    return counted.where(F.col("_is_bar") & (F.col("streak_count") != 1)).select("stock", day, "streak_count")


def streak_shape(metric: DataFrame) -> DataFrame:
    """Streaks that overlap the one before, end before they start, or carry a wrong length."""
    before = F.lag("end_date").over(Window.partitionBy("stock").orderBy("start_date"))
    fault = (
        F.when(F.col("start_date") > F.col("end_date"), "reversed")
        .when(F.col("day_length") != calendar_length(F.col("start_date"), F.col("end_date")), "wrong_length")
        .when(F.col("_before") >= F.col("start_date"), "overlap")
    )
    return metric.withColumn("_before", before).withColumn("fault", fault).where(F.col("fault").isNotNull()).drop("_before")


def null_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{name}_not_null": F.col(name).isNull() for name in columns}


def domain_rule(column: str, values: Sequence) -> dict[str, Column]:
    """NULL is not a value."""
    return {f"{column}_accepted": F.col(column).isNotNull() & ~F.col(column).isin(list(values))}


def shape_rules() -> dict[str, Column]:
    """The faults of ``streak_shape`` that a row shows by itself."""
    length = calendar_length(F.col("start_date"), F.col("end_date"))
    return {"not_reversed": F.col("start_date") > F.col("end_date"), "right_length": (F.col("start_date") <= F.col("end_date")) & (F.col("day_length") != length)}


def checked_write(df: DataFrame, path: str, rules: Mapping[str, Column]) -> dict[str, int]:
    """Writes the table and counts, in the same pass, its ``row_count`` and each rule's failing rows. A rule holds for
    the rows that fail; where it is NULL the row passes. Only the counters reach the driver."""
    if "row_count" in rules:
        raise ValueError("row_count is no name for a rule")
    watch = Observation()
    counters = [F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    df.observe(watch, F.count(F.lit(1)).alias("row_count"), *counters).write.mode("overwrite").parquet(path)
    return dict(watch.get)


def failing_rows(df: DataFrame, rules: Mapping[str, Column], counts: Mapping[str, int]) -> DataFrame:
    """The failing rows and the names of their ``failed_rules``; rules whose counter is zero are not looked at again."""
    broken = {name: rule for name, rule in rules.items() if counts[name]}
    names = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in broken.items()))) if broken else F.array().cast("array<string>")
    found = (df if broken else df.limit(0)).withColumn("failed_rules", F.concat_ws(",", names))
    return found.where(F.col("failed_rules") != "")
