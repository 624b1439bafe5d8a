"""The wide landing table: text columns per field and ticker, CSV in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streakline import schemas
from streakline.config import FIELDS


def pivot_wide(bars: DataFrame, tickers: tuple[str, ...]) -> DataFrame:
    """Long bars to one text row per day. A missing ticker-day becomes ``''``.

    The ticker list is given, so no job has to discover it.
    """
    pivoted = (
        bars.where(F.col("stock").isin(list(tickers)))
        .groupBy(F.col("stock_valuation_date").cast("string").alias("date"))
        .pivot("stock", list(tickers))
        .agg(*(F.max(f"{field}_value").alias(field) for field in FIELDS))
    )
    columns = [
        F.coalesce(F.col(f"`{ticker}_{field}`").cast("string"), F.lit("")).alias(schemas.wide_column(field, ticker))
        for field in FIELDS
        for ticker in tickers
    ]
    return pivoted.select("date", *columns)


def write_wide_csv(wide: DataFrame, path: str) -> None:
    wide.write.mode("overwrite").option("header", True).csv(path)


def read_wide_csv(spark: SparkSession, path: str, tickers: tuple[str, ...], with_sequence: bool = False) -> DataFrame:
    """CSV load under the declared schema; a header that differs from it is an error."""
    return (
        spark.read.schema(schemas.staging_wide(tickers, with_sequence))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_wide_csv_apart(
    spark: SparkSession, path: str, tickers: tuple[str, ...], with_sequence: bool = False, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)``: every line of the files is in one of the two.

    A line with too few or too many fields is kept apart, as ``file``, ``line``
    (its text) and ``n_fields``, and not read as a row. Quoted fields may hold
    commas, and not line breaks. Blank lines are no lines.
    """
    schema = schemas.staging_wide(tickers, with_sequence)
    corrupt = "_corrupt_line"
    read = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]))
        .options(header=header, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt, columnPruning=False)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("_file"))
    )
    # Always true; Spark wants a query of a CSV's corrupt lines to name another column too.
    read = read.where(F.length(F.concat_ws("", corrupt, schema.fieldNames()[0])) >= 0)
    rows = read.where(F.col(corrupt).isNull()).drop(corrupt, "_file")
    outside_quotes = F.regexp_replace(corrupt, r'"(?:[^"]|"")*"', "")
    bad = read.where(F.col(corrupt).isNotNull())
    return rows, bad.select(F.col("_file").alias("file"), F.col(corrupt).alias("line"), F.size(F.split(outside_quotes, ",", -1)).alias("n_fields"))


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """All new rows, matched by column name."""
    return target.unionByName(rows)
