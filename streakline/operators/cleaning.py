"""Landing rows to typed live bars: dedup, unpivot, cast, key, high-water mark, upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline import schemas
from streakline.config import FIELDS
from streakline.functions.keys import surrogate_id

LIVE_KEY = ("stock", "stock_valuation_date")


def newest_per_key(df: DataFrame, keys: Sequence[Column], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key. Spark limits every key to one row per task before the
    shuffle, so a hot key does not travel whole."""
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def _same_day(values: Sequence[str]) -> list[Column]:
    """What makes two landing rows one: their day as a date, an unreadable date as text, without any date all values."""
    day = F.coalesce(F.col("date").try_cast("date").cast("string"), F.col("date"))
    dateless = F.when(_stripped("date").isNull(), F.struct(*(F.col(f"`{name}`") for name in values)))
    return [day, dateless]


def dedup_by_date(wide: DataFrame) -> DataFrame:
    """One landing row per day: the latest ingest, ties broken by all other columns.

    Days compare as dates, so two spellings of a day are one; unreadable
    spellings compare as text, rows without a date by all their values, and
    stay apart for ``rejected_rows``.
    """
    values = [name for name in wide.columns if name not in ("date", "ingest_seq")]
    return newest_per_key(wide, _same_day(values), [F.desc("ingest_seq"), *(F.desc(f"`{name}`") for name in values)])


def dedup_long(long_text: DataFrame) -> DataFrame:
    """One text row per stock and day: the latest ingest, as ``dedup_by_date`` for the long form."""
    rest = [F.desc(name) for name in FIELDS]
    return newest_per_key(long_text, [F.col("stock"), *_same_day(FIELDS)], [F.desc("ingest_seq"), *rest]).select("date", "stock", *FIELDS)


def unpivot_live(wide: DataFrame, tickers: tuple[str, ...]) -> DataFrame:
    """Wide to long, still text: a row per day and ticker, in one pass and without a shuffle."""
    rows = [
        F.struct(
            F.lit(ticker).alias("stock"),
            *(F.col(f"`{schemas.wide_column(field, ticker)}`").alias(field) for field in FIELDS),
        )
        for ticker in tickers
    ]
    return wide.select("date", F.inline(F.array(*rows)))


def _number(name: str) -> Column:
    target = schemas.VOLUME if name == "volume" else schemas.PRICE
    return _stripped(name).try_cast(target)


def _stripped(name: str) -> Column:
    return F.nullif(F.trim(name), F.lit(""))


def typed_bars(long_text: DataFrame) -> DataFrame:
    """Text to declared types. Unreadable text becomes NULL here and shows up in
    ``rejected_rows``; a row without a readable day is not a bar."""
    day = F.col("date").try_cast("date")
    return long_text.where(day.isNotNull()).select(
        surrogate_id(day, F.col("stock")).alias("id"),
        day.alias("stock_valuation_date"),
        "stock",
        *(_number(f).alias(f"{f}_value") for f in ("close", "high", "low", "open", "volume")),
    )


def rejected_rows(long_text: DataFrame) -> DataFrame:
    """Every non-empty text that does not cast, and every date that is missing, one row each."""

    def fault(name: str, found: Column) -> Column:
        return F.when(found, F.struct(F.lit(name).alias("field"), F.col(name).alias("raw_value")))

    dateless = fault("date", F.col("date").try_cast("date").isNull())
    faults = F.array(dateless, *(fault(f, _stripped(f).isNotNull() & _number(f).isNull()) for f in FIELDS))
    return long_text.select("date", "stock", F.inline(F.array_compact(faults)))


def _high_water(target: DataFrame) -> DataFrame:
    return target.groupBy("stock").agg(F.max("stock_valuation_date").alias("_high_water"))


def _with_high_water(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.join(_high_water(target), "stock", "left")


def incremental_filter(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows after the stock's newest target day."""
    floor = F.coalesce("_high_water", F.lit("1900-01-01").cast("date"))
    return _with_high_water(source, target).where(F.col("stock_valuation_date") > floor).select(*source.columns)


def outcomes(source: DataFrame, target: DataFrame) -> DataFrame:
    """The source and what becomes of each row, ``outcome``: ``new`` after its stock's newest target day; else
    ``unchanged`` if the target holds the key with the same values, ``restated`` with others, ``behind`` if it lacks the
    key. Values are the columns both sides have, NULL equals NULL. The target's keys are unique."""
    values = [name for name in source.columns if name in target.columns and name not in (*LIVE_KEY, "id")]
    known = target.select(*LIVE_KEY, F.struct(*values).alias("_known"))
    kind = (
        F.when(F.col("_high_water").isNull() | (F.col("stock_valuation_date") > F.col("_high_water")), "new")
        .when(F.col("_known").isNull(), "behind")
        .when(F.struct(*values).eqNullSafe(F.col("_known")), "unchanged")
        .otherwise("restated")
    )
    joined = _with_high_water(source, target).join(known, list(LIVE_KEY), "left")
    return joined.select(*source.columns, kind.alias("outcome"))


def late_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """What ``incremental_filter`` leaves out and the target does not hold with the same values: missing days, and
    known days whose values are restated."""
    return outcomes(source, target).where(F.col("outcome").isin("behind", "restated")).drop("outcome")


def landed_balance(long_text: DataFrame, live: DataFrame) -> DataFrame:
    """``outcome`` and ``n``: how many landed rows (``landed``) came to each of the ``outcomes`` or have no readable date
    (``dateless``); these add up to those."""
    of_bars = outcomes(typed_bars(long_text), live).groupBy("outcome").agg(F.count("*").alias("n"))
    readable = F.col("date").try_cast("date").isNotNull()
    counts = long_text.agg(F.count("*").alias("landed"), F.count_if(~readable).alias("dateless"))
    of_text = counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("outcome"), F.col(c).alias("n")) for c in ("landed", "dateless")))))
    return of_bars.unionByName(of_text)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge on ``keys``: matched rows are replaced, others inserted. A key that ``source`` has
    twice is an error; NULL keys match nothing.

    One pass over both sides: they meet in one window per key, and each source row counts once."""
    both = target.withColumn("_new", F.lit(0)).unionByName(source.select(*target.columns).withColumn("_new", F.lit(1)))
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    incoming = F.when(known, F.sum("_new").over(Window.partitionBy(*keys))).otherwise(0)
    twice = F.concat(F.lit("the source has twice the key "), F.concat_ws(", ", *(F.col(k).cast("string") for k in keys)))
    kept = F.when(F.col("_incoming") > 1, F.raise_error(twice).cast("boolean")).otherwise((F.col("_new") == 1) | (F.col("_incoming") == 0))
    return both.withColumn("_incoming", incoming).where(kept).select(*target.columns)


def upsert_live(target: DataFrame, source: DataFrame, allow_corrections: bool = True) -> DataFrame:
    """Merge bars into live; without corrections only days after the high-water mark enter."""
    if not allow_corrections:
        return target.unionByName(incremental_filter(source, target).select(*target.columns))
    return upsert(target, source, LIVE_KEY)
