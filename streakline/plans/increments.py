"""A folder of streak tables that grows batch by batch.

Each batch writes its own subfolders and reads state only from the batch
before it. A batch that is run again therefore overwrites its own output with
the same content, and closed streaks are written once and never touched
again. A batch writes the tail and the open streak of the stocks it brings new
days of; the state of a stock is what its newest batch wrote. Every
``compact_every`` batches all stocks are written, so no read goes back further.
Windows run over the new days alone: the tail is one row per stock, with the
running sums of its last days in arrays of bounded length.

Closed streaks lie in levels: the last of every ``merge_every`` batches writes
the closed streaks of all of them once more as one sorted table, the last of
every ``merge_every`` such tables those, and so on. Which tables hold the
batches up to a given one is arithmetic, so an earlier state stays readable, a
batch run again writes the same merges, and a read opens a number of folders
that grows with the logarithm of the batches.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streakline import schemas
from streakline.config import IndicatorParams
from streakline.families import FAMILIES, BucketFamily
from streakline.operators.cleaning import incremental_filter, late_rows
from streakline.operators.incremental import advance
from streakline.operators.indicators import CLASSIFIED_COLUMNS, RUNNING, STATE, classify_onto, history_state
from streakline.operators.spread import place_by_stock

_BAR_COLUMNS = ("stock", "stock_valuation_date", "close_value")
_BARS = T.StructType([schemas.LIVE[name] for name in _BAR_COLUMNS])
_DAYS = T.StructType([*schemas.CLASSIFIED.fields, *RUNNING.fields])


def _plus(schema: T.StructType, partition: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(partition, T.IntegerType())])


def _summary(family: BucketFamily) -> str:
    return f"{family.mart}_summary"


def _partial(streaks: DataFrame, family: BucketFamily) -> DataFrame:
    """Number, sum and maximum of the streaks' lengths, which merge with those of other streaks."""
    length = F.col("day_length")
    return streaks.groupBy("stock", family.key_column).agg(
        F.count(F.lit(1)).alias("streak_count"), F.sum(length).alias("total_days"), F.max(length).alias("longest_days")
    )


def _merged(partial: DataFrame, family: BucketFamily) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("streak_count", "total_days")]
    return partial.groupBy("stock", family.key_column).agg(*sums, F.max("longest_days").alias("longest_days"))


@dataclass(frozen=True)
class StreakStore:
    spark: SparkSession
    root: str
    families: tuple[BucketFamily, ...] = FAMILIES
    params: IndicatorParams = IndicatorParams()
    compact_every: int = 16
    merge_every: int = 8

    def __post_init__(self) -> None:
        if self.compact_every < 1 or self.merge_every < 2:
            raise ValueError("compact_every must be at least 1 and merge_every at least 2")

    def _path(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def _write(self, df: DataFrame, table: str, batch: int, *partitions: str) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(self._path(table, batch))

    def _read(self, table: str, schema: T.StructType, batch: int | None = None) -> DataFrame:
        path = f"{self.root}/{table}" if batch is None else self._path(table, batch)
        return self.spark.read.schema(schema).parquet(path)

    def _newest(self, table: str, schema: T.StructType, batch: int, condition: str = "true", place: bool = False) -> DataFrame:
        """The rows of each stock from the newest batch up to ``batch`` that wrote some; batches
        before the last compaction are not read."""
        base = batch // self.compact_every * self.compact_every
        rows = self._read(table, _plus(schema, "batch")).where(F.col("batch").between(base, batch)).where(condition)
        rows = place_by_stock(rows) if place else rows
        newest = F.max("batch").over(Window.partitionBy("stock"))
        return rows.withColumn("_newest", newest).where("batch = _newest").drop("_newest", "batch")

    def state(self, batch: int) -> DataFrame:
        """The bounded history of every stock as of ``batch``, one row each. It is placed as new bars are, so that
        the two meet without another exchange."""
        return self._newest("tail", STATE, batch, place=True)

    def _streak_schema(self, family: BucketFamily) -> T.StructType:
        return _plus(schemas.metric(family), "is_open")

    def apply(self, batch: int, bars: DataFrame) -> None:
        """Takes in one batch of bars, unique on (stock, day). Bars at or before their stock's
        newest stored day, missing or with another price, go to the ``late`` table instead of changing history."""
        self._write(bars.select(*_BAR_COLUMNS), "incoming", batch)
        incoming = self._read("incoming", _BARS, batch)

        state = None if batch == 0 else self.state(batch - 1)
        if state is None:
            fresh = incoming
            self._write(incoming.limit(0), "late", batch)
        else:
            newest = state.select("stock", "stock_valuation_date")
            fresh = incremental_filter(place_by_stock(incoming), newest)
            self._write(self._late_bars(batch, incoming, newest), "late", batch)
        self._write(classify_onto(state, fresh, self.params), "days", batch)
        with_sums = self._read("days", _DAYS, batch)
        days = with_sums.select(*CLASSIFIED_COLUMNS)
        touched = days.select("stock").distinct()

        compacts = batch > 0 and batch % self.compact_every == 0
        history = history_state(state, with_sums, self.params)
        if compacts:
            history = history.unionByName(state.join(touched, "stock", "left_anti"))
        self._write(history, "tail", batch)
        for family in self.families:
            if state is None:
                changed = advance(None, days, family)
            else:
                last_days = newest.join(touched, "stock", "left_semi") if self.params.null_policy == "null" else None
                open_ = self.open_streaks(family, batch - 1)
                changed = advance(open_.join(touched, "stock", "left_semi"), days, family, last_days)
                if compacts:
                    idle = open_.join(touched, "stock", "left_anti").withColumn("is_open", F.lit(True))
                    changed = changed.unionByName(idle)
            changed = changed.withColumn("is_open", F.col("is_open").cast("int"))
            self._write(changed, family.mart, batch, "is_open")
            self._add_to_summary(family, batch, None if batch == 0 else touched, compacts)
            self._merge_closed(family, batch)

    def _late_bars(self, batch: int, incoming: DataFrame, newest: DataFrame) -> DataFrame:
        """Only bars at or before their stock's newest stored day are compared, with the days from the oldest bar on.
        Two fixed days spare most rows the way there: bars after all stored days are not late, and the oldest lets
        the files of older batches be skipped."""
        oldest = incoming.agg(F.min("stock_valuation_date")).first()[0]
        last = newest.agg(F.max("stock_valuation_date")).first()[0]
        behind = incoming.where(F.col("stock_valuation_date") <= F.lit(last).cast("date"))
        behind = behind.join(newest.withColumnRenamed("stock_valuation_date", "_newest"), "stock")
        behind = behind.where(F.col("stock_valuation_date") <= F.col("_newest")).select(*_BAR_COLUMNS)
        days = self.days(batch - 1).where(F.col("stock_valuation_date") >= F.lit(oldest).cast("date"))
        known = days.select("stock", "stock_valuation_date", F.col("stock_value").alias("close_value"))
        return late_rows(behind, known)

    def closed_tables(self, batch: int) -> list[tuple[int, int]]:
        """Level and last batch of the tables that together hold the closed streaks of all batches up to ``batch``;
        a table of level n holds ``merge_every ** n`` batches, one of level 0 is what the batch itself wrote."""
        tables, level, begin = [], 0, 0
        while self.merge_every ** (level + 1) <= batch + 1:
            level += 1
        for n in range(level, -1, -1):
            size = self.merge_every**n
            while begin + size <= batch + 1:
                begin += size
                tables.append((n, begin - 1))
        return tables

    def _closed(self, family: BucketFamily, tables: list[tuple[int, int]]) -> DataFrame:
        """The closed streaks of the tables. Paths of one folder are read with it as their base, so that all have the same partition columns."""
        schema, found = schemas.metric(family), []
        own = [self._path(family.mart, last) for level, last in tables if level == 0]
        if own:
            reader = self.spark.read.schema(_plus(self._streak_schema(family), "batch")).option("basePath", f"{self.root}/{family.mart}")
            found.append(reader.parquet(*own).where("is_open = 0").select(*schema.names))
        merged = [f"{self.root}/{family.mart}_closed/level={level}/batch={last}" for level, last in tables if level > 0]
        if merged:
            reader = self.spark.read.schema(_plus(_plus(schema, "level"), "batch")).option("basePath", f"{self.root}/{family.mart}_closed")
            found.append(reader.parquet(*merged).select(*schema.names))
        return reduce(DataFrame.unionByName, found)

    def _merge_closed(self, family: BucketFamily, batch: int) -> None:
        """The merges that end with this batch. Rows lie in order of stock, so that a stock's streaks are found by the
        minima and maxima in the files; the number of files follows their size."""
        level, size = 1, self.merge_every
        while (batch + 1) % size == 0:
            step = size // self.merge_every
            parts = [(level - 1, batch - i * step) for i in range(self.merge_every)]
            ordered = self._closed(family, parts).repartitionByRange("stock", "start_date").sortWithinPartitions("stock", "start_date")
            ordered.write.mode("overwrite").parquet(f"{self.root}/{family.mart}_closed/level={level}/batch={batch}")
            level, size = level + 1, size * self.merge_every

    def _summary_schema(self, family: BucketFamily) -> T.StructType:
        counts = [T.StructField("streak_count", T.LongType()), T.StructField("total_days", T.LongType())]
        return T.StructType([*(schemas.metric(family)[c] for c in ("stock", family.key_column)), *counts, T.StructField("longest_days", T.IntegerType())])

    def _add_to_summary(self, family: BucketFamily, batch: int, touched: DataFrame | None, compacts: bool) -> None:
        """The touched stocks' sums over closed streaks: those of the batch before and what this batch has closed."""
        closed = self._read(family.mart, self._streak_schema(family), batch).where("is_open = 0")
        sums = _partial(closed, family)
        if touched is not None:
            known = self._newest(_summary(family), self._summary_schema(family), batch - 1)
            sums = _merged(sums.unionByName(known.join(touched, "stock", "left_semi")), family)
            if compacts:
                sums = sums.unionByName(known.join(touched, "stock", "left_anti"))
        self._write(sums, _summary(family), batch)

    def summary(self, family: BucketFamily, batch: int) -> DataFrame:
        """``bucket_summary`` as of ``batch``, from the stored sums and the open streaks; no closed streak is read."""
        stored = self._newest(_summary(family), self._summary_schema(family), batch)
        merged = _merged(stored.unionByName(_partial(self.open_streaks(family, batch), family)), family)
        average = F.col("total_days").cast("double") / F.col("streak_count").cast("double")
        return merged.select("stock", family.key_column, "streak_count", "total_days", average.alias("average_days"), "longest_days")

    def metric(self, family: BucketFamily, batch: int) -> DataFrame:
        """The family's mart as of ``batch``: all closed streaks, and each stock's open one."""
        return self._closed(family, self.closed_tables(batch)).unionByName(self.open_streaks(family, batch))

    def opened(self, family: BucketFamily, batch: int) -> DataFrame:
        """The current streaks that began with ``batch``: their stocks changed bucket or are new."""
        now = self._read(family.mart, self._streak_schema(family), batch).where("is_open = 1").drop("is_open")
        if batch == 0:
            return now
        return now.join(self.open_streaks(family, batch - 1).select("stock", "start_date"), ["stock", "start_date"], "left_anti").select(*now.columns)

    def open_streaks(self, family: BucketFamily, batch: int) -> DataFrame:
        """Each stock's current streak as of ``batch``."""
        return self._newest(family.mart, self._streak_schema(family), batch, "is_open = 1").drop("is_open")

    def newest_day(self, batch: int) -> date | None:
        """The newest day taken in by ``batch``, from the tail alone."""
        return self.state(batch).agg(F.max("stock_valuation_date").alias("day")).first()["day"]

    def days(self, batch: int) -> DataFrame:
        schema = _plus(schemas.CLASSIFIED, "batch")
        return self._read("days", schema).where(F.col("batch") <= batch).select(*CLASSIFIED_COLUMNS)

    def late(self, batch: int) -> DataFrame:
        schema = _plus(_BARS, "batch")
        return self._read("late", schema).where(F.col("batch") <= batch).select(*_BAR_COLUMNS)
