"""Rows placed by stock ahead of windows and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame


def place_by_stock(df: DataFrame) -> DataFrame:
    """The rows in one partition more than ``spark.sql.shuffle.partitions``, by stock.

    Adaptive execution fills a task by the compressed bytes it reads, and a sort
    or an aggregation holds many times those in memory; a number that is asked
    for stays, so a task's memory follows the rows over that number. The planner
    leaves an exchange out that a union of sides with the same partitioning seems
    to make needless, but such a union may run side after side, with as many
    partitions as both have. The odd number keeps the exchange.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1, "stock")
