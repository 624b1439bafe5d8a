"""Catalog tables: creation, registration, replacement, and layout on write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streakline import schemas
from streakline.config import LandingConfig
from streakline.families import FAMILIES
from streakline.sources.dims import dim


def create_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def create_landing_table(spark: SparkSession, config: LandingConfig) -> None:
    create_table(spark, config.table, schemas.staging_wide(config.tickers))


def register_sources(spark: SparkSession, landing: DataFrame, config: LandingConfig) -> None:
    """The landing table and the three dimensions as temporary views."""
    landing.createOrReplaceTempView(config.table)
    for family in FAMILIES:
        dim(spark, family).createOrReplaceTempView(family.dim)


def rebuild_and_swap(spark: SparkSession, name: str, rebuilt: DataFrame) -> None:
    """Replace table ``name`` by ``rebuilt``, which may read the table itself.

    The new content is complete before the first rename. A run lost between the
    renames leaves the old content as ``<name>_old``; the next one, or
    ``restore``, brings it back first.
    """
    fresh, old = f"{name}_rebuilt", f"{name}_old"
    restore(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    rebuilt.write.format("parquet").saveAsTable(fresh)
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.sql(f"DROP TABLE {old}")


def restore(spark: SparkSession, name: str) -> None:
    """Ends a swap that was lost half-way: without table ``name`` its old content returns under
    that name, with it the leftover goes."""
    old = f"{name}_old"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def write_by_stock(df: DataFrame, path: str, day: str = "stock_valuation_date", mode: str = "overwrite") -> None:
    """Range layout on (stock, day): neighbours share files, row-group statistics prune both
    columns, and a long history is cut by day instead of filling one file."""
    df.repartitionByRange("stock", day).sortWithinPartitions("stock", day).write.mode(mode).parquet(path)


def save_clustered(df: DataFrame, table: str, buckets: int, day: str = "stock_valuation_date") -> None:
    """A table bucketed by stock and sorted by day: windows, streaks and joins on the stock read it
    without a shuffle. One file per bucket."""
    (
        df.repartition(buckets, "stock")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "stock")
        .sortBy("stock", day)
        .saveAsTable(table)
    )


def write_by_year(df: DataFrame, path: str, day: str = "stock_valuation_date") -> None:
    """Year partitions; with dynamic overwrite only the years present in ``df`` are replaced, each as a whole: ``df``
    holds every row of its years."""
    (
        df.withColumn("year", F.year(day))
        .repartitionByRange("year", "stock", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
        .parquet(path)
    )
