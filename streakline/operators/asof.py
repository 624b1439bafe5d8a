"""As-of join: each event meets the value that was (or will be) known at its time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIRECTIONS = ("backward", "forward", "nearest")


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def asof_join(
    events: DataFrame,
    values: DataFrame,
    by: Sequence[str],
    on: str,
    tolerance: str | None = None,
    direction: str = "backward",
    slice_: str = "30 days",
) -> DataFrame:
    """Every event and, as ``matched`` (a struct of the other columns of ``values`` and its ``on``), the row of
    ``values`` with the same ``by`` whose ``on`` is the last one up to the event's (``backward``), the first one from
    it on (``forward``), or the closer of both (``nearest``; ties: the earlier one). Equal times count as known. A
    match further away than ``tolerance`` (an interval) is none; ``matched`` is NULL then.

    Of several values at one time, the greatest row counts. Events with a NULL key or time stay, unmatched; such
    values are ignored. ``on`` is a date or timestamp of one type on both sides; columns of ``values`` can be ordered.

    Both sides meet by merging in time order, without a range join, and travel once whatever the direction. A key's time
    is cut into slices of the fixed width ``slice_``; what a slice with events starts with is carried over from the slices
    before it, unless it is too old, which takes at most one row per key, slice and side. So a key that holds a third of
    all rows spreads over as many tasks as it has slices. Both tables are read twice: store what is dear to derive.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction is one of {', '.join(DIRECTIONS)}")
    keys = list(by)
    names = [f"_k{i}" for i in range(len(keys))]
    payload = [c for c in values.columns if c not in keys]
    # The key of a row stands beside its struct.
    event, value = (F.struct(*[F.col(f"`{c}`") for c in columns]) for columns in ([c for c in events.columns if c not in keys], payload))
    key = [F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)]
    comparable = reduce(lambda a, b: a & b, (F.col(f"`{c}`").isNotNull() for c in [*keys, on]))
    left = events.where(comparable).select(*key, _micros(F.col(on)).alias("_t"), event.alias("_event"))
    known = values.where(comparable).select(*key, _micros(F.col(on)).alias("_t"), value.alias("_value"))
    rows = left.unionByName(known, allowMissingColumns=True)
    rows = rows.withColumn("_slice", F.col("_t") - F.pmod("_t", _length(slice_)))
    sides = {"backward": ["_before"], "forward": ["_after"], "nearest": ["_before", "_after"]}[direction]
    rows = _carried(rows, names, sides, _length(slice_), None if tolerance is None else _length(tolerance))

    def near(side: str) -> Column:
        away = F.abs(F.col(f"{side}.t") - F.col("_t"))
        close = F.lit(True) if tolerance is None else away <= _length(tolerance)
        return F.when(close, F.struct(away.alias("away"), F.col(f"{side}.value").alias("value")))

    matched = near(sides[0])
    if direction == "nearest":
        after = near("_after")
        matched = F.when(after.isNull() | (matched["away"] <= after["away"]), matched).otherwise(after)
    place = dict(zip(keys, names, strict=True))
    own = [F.col(place[c]).alias(c) if c in place else F.col("_event")[c].alias(c) for c in events.columns]
    found = rows.where(F.col("_event").isNotNull()).select(*own, matched["value"].alias("matched"))
    rest = events.where(~F.coalesce(comparable, F.lit(False))).withColumn("matched", F.lit(None).cast(found.schema["matched"].dataType))
    return found.unionByName(rest)


def _length(interval: str) -> Column:
    """An interval of days or less in microseconds."""
    epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    return F.expr(f"unix_micros(CAST({epoch} + INTERVAL {interval} AS TIMESTAMP)) - unix_micros(CAST({epoch} AS TIMESTAMP))")


def _carried(rows: DataFrame, names: list[str], sides: list[str], width: Column, tolerance: Column | None) -> DataFrame:
    """Adds ``_before`` (``_after``): the nearest value at or before (at or after) each row, as a struct of its time ``t`` and
    ``value``. Both look along one partitioning; what is carried into a slice lies outside of it, on its own side."""
    signs = {side: -1 if side == "_after" else 1 for side in sides}
    is_value, is_event = F.col("_value").isNotNull(), F.col("_event").isNotNull()
    # What a slice hands on: the value nearest to the border, the greatest of its time; combined before the shuffle.
    handed = [F.max(F.when(is_value, F.struct((sign * F.col("_t")).alias("t"), F.col("_value").alias("value")))).alias(side) for side, sign in signs.items()]
    edges = rows.groupBy(*names, "_slice").agg(*handed, F.max(is_event).alias("_asks"))
    for side, sign in signs.items():
        earlier = Window.partitionBy(*names).orderBy(sign * F.col("_slice")).rowsBetween(Window.unboundedPreceding, -1)
        edges = edges.withColumn(f"{side}_edge", F.last(side, ignorenulls=True).over(earlier))
    received = []
    for side, sign in signs.items():
        edge = F.col(f"{side}_edge")
        border = F.col("_slice") if sign == 1 else -(F.col("_slice") + width - 1)
        useful = edge.isNotNull() if tolerance is None else border - edge["t"] <= tolerance
        received.append(F.when(useful, F.struct((sign * edge["t"]).alias("t"), edge["value"].alias("value"))))
    carried = edges.where("_asks").select(*names, "_slice", F.explode(F.array_compact(F.array(*received))).alias("_edge"))
    extra = carried.select(*names, "_slice", F.col("_edge.t").alias("_t"), F.col("_edge.value").alias("_value"), F.lit(True).alias("_extra"))
    both = rows.unionByName(extra, allowMissingColumns=True)
    newest = F.when(is_value, F.struct(F.col("_t").alias("t"), F.col("_value").alias("value")))
    for side, sign in signs.items():
        # Values come before the events of their time, the greatest one last.
        along = Window.partitionBy(*names, "_slice").orderBy(sign * F.col("_t"), is_event, "_value")
        both = both.withColumn(side, F.last(newest, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return both.where(F.col("_extra").isNull()).drop("_extra")
