"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_id(day: Column, stock: Column) -> Column:
    """md5 of ``yyyy-MM-dd-stock``."""
    return F.md5(F.concat_ws("-", day.cast("string"), stock))
