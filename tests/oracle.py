"""Runs a query and its SQL counterpart and compares columns, types and rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return str(value.normalize())
    if isinstance(value, datetime | date):
        return value.isoformat()[:10]
    return str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


SPARK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def compare(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences in words; an empty list means equal. Doubles compare bit by bit."""
    result = connection.execute(sql)
    duck_types = {column[0]: str(column[1]) for column in result.description}
    theirs = _rows(list(duck_types), result.fetchall())
    ours = _rows(df.columns, df.collect())
    if sorted(df.columns) != sorted(duck_types):
        return [f"columns {sorted(df.columns)} != {sorted(duck_types)}"]
    found = []
    for name, kind in df.dtypes:
        expected = SPARK_TYPES.get(kind, kind.upper())
        if duck_types[name].replace(" ", "") != expected:
            found.append(f"type of {name}: {kind} != {duck_types[name]}")
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows != {len(theirs)}")
    if ours != theirs:
        left, right = set(ours) - set(theirs), set(theirs) - set(ours)
        found.append(f"{len(left)} rows only here, e.g. {sorted(left)[:2]}; {len(right)} only there, e.g. {sorted(right)[:2]}")
    return found
