"""Bucket dimensions: fixed rows, small enough to broadcast by definition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streakline.families import BucketFamily


def dim(spark: SparkSession, family: BucketFamily) -> DataFrame:
    rows = ", ".join(f"({i}, '{name}', '{text}')" for i, name, text in family.buckets)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS dim(id, bucket_name, bucket_description)")
