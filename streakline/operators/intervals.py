"""Days and the intervals they lie in, for intervals that may overlap.

An interval of days is cut at the borders of aligned blocks of 64 and 4,096
days: whole blocks of both sizes in between, and a block of 64 days at each
end. A day lies in one block of each size and meets an interval in one of its
blocks at most, so the join is an equi-join. Only in the blocks at the ends
can they meet in vain, and there an interval meets no other days than those
of at most 126 dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks have 2^6 and 2^12 days. A longer interval has more blocks of the larger size.
SMALL, LARGE = 6, 12


def _place(block: Column, bits: int) -> Column:
    """A number for the block, different for both sizes."""
    return block * 2 + (1 if bits == LARGE else 0)


def _block(day: Column, bits: int) -> Column:
    return F.shiftright(F.unix_date(day), bits)


def _blocks(start: Column, end: Column) -> Column:
    """Places of the blocks that cover the days from ``start`` to ``end``: whole large blocks, small ones before and after them."""
    first, last = _block(start, SMALL), _block(end, SMALL)
    per_large = 1 << (LARGE - SMALL)
    # Large blocks that lie between the small ones at both ends.
    low, behind = F.shiftright(first, LARGE - SMALL) + 1, F.shiftright(last, LARGE - SMALL)
    small = F.when(low < behind, F.concat(F.sequence(first, low * per_large - 1), F.sequence(behind * per_large, last))).otherwise(F.sequence(first, last))
    large = F.when(low < behind, F.sequence(low, behind - 1)).otherwise(F.array().cast("array<int>"))
    return F.concat(F.transform(small, lambda b: _place(b, SMALL)), F.transform(large, lambda b: _place(b, LARGE)))


def days_in_intervals(
    days: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str] = ("stock",),
    day: str = "stock_valuation_date",
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """The days' columns beside the other columns of every interval of the same keys with ``start <= day <= end``.

    Overlapping, nested and repeated intervals give a row each, repeated days
    too. A NULL key or day is in no interval; an interval with a NULL border
    or one that ends before it starts holds no day. Both tables may not share
    other column names.
    """
    shared = (set(days.columns) & set(intervals.columns)) - set(keys)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    whole = F.struct(*[F.col(f"`{c}`") for c in intervals.columns if c not in keys]).alias("_interval")
    sizes = F.struct(F.col(f"`{start}`").alias("start"), F.col(f"`{end}`").alias("end"))
    cut = intervals.select(*[F.col(f"`{k}`") for k in keys], whole, sizes.alias("_span")).where("_span.start <= _span.end")
    blocks = cut.select(*[F.col(f"`{k}`") for k in keys], "_interval", F.explode(_blocks(F.col("_span.start"), F.col("_span.end"))).alias("_place"))
    places = F.array(*(_place(_block(F.col("_day"), bits), bits) for bits in (SMALL, LARGE)))
    row = F.struct(*[F.col(f"`{c}`") for c in days.columns if c not in keys]).alias("_row")
    known = days.select(*[F.col(f"`{k}`") for k in keys], row, F.col(f"`{day}`").alias("_day")).where("_day is not null")
    placed = known.select(*[F.col(f"`{k}`") for k in keys], "_row", F.explode(places).alias("_place"))
    met = placed.join(blocks, [*keys, "_place"]).where(F.col("_row")[day].between(F.col("_interval")[start], F.col("_interval")[end]))
    return met.select(
        *[F.col(f"`{c}`") if c in keys else F.col("_row")[c].alias(c) for c in days.columns],
        *[F.col("_interval")[c].alias(c) for c in intervals.columns if c not in keys],
    )
