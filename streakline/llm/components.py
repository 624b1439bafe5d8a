"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streakline.llm.common import stored


def _oriented(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the least node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of these."""
    least = links.groupBy("a").agg(F.min("b").alias("root"))
    moved = links.join(least, "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.unionByName(least.select("a", F.col("root").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for each node of ``links(a bigint, b bigint)``
    that is not a root itself. Loops and repeated links are ignored; no links give no rows.

    Each round is written to the scratch folder. Only the count and the checksum of a round reach the driver.
    A hub's links are split by the adaptive skew join, its minimum is combined before the shuffle.
    """
    state, links = None, stored(_oriented(links), "links")
    while True:
        check = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if check == state or check[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state, links = check, stored(_small_star(_large_star(links)), "links")
