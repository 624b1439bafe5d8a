from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from streakline import schemas
from streakline.config import LandingConfig
from streakline.operators import cleaning
from streakline.plans import marts
from streakline.sources import bars as bar_source
from streakline.sources import landing, tables

TICKERS = ("AAPL", "NVDA")


def _landing(spark, *rows_):
    """(date, ingest_seq, close_aapl, volume_aapl, close_nvda) rows; other columns are empty text."""
    schema = schemas.staging_wide(TICKERS)
    out = []
    for day, sequence, close, volume, other in rows_:
        values = {"date": day, "ingest_seq": sequence, "close_aapl": close, "volume_aapl": volume, "close_nvda": other}
        out.append(tuple(values.get(name, "") for name in schema.names))
    return spark.createDataFrame(out, schema)


def _live(spark, *rows_):
    return cleaning.typed_bars(cleaning.unpivot_live(_landing(spark, *rows_), TICKERS))


def test_text_becomes_numbers_or_is_rejected(spark):
    wide = _landing(
        spark,
        ("2024-01-02", 1, "1.00005", "12345.0", ""),
        ("2024-01-03", 1, "nan", "12345.5", " 7 "),
        ("soon", 1, "5", "1", "6"),
    )
    text = cleaning.unpivot_live(wide, TICKERS)
    live = cleaning.typed_bars(text)
    assert rows(live, "stock_valuation_date", "stock", "close_value", "volume_value") == [
        (date(2024, 1, 2), "AAPL", Decimal("1.0001"), Decimal(12345)),
        (date(2024, 1, 2), "NVDA", None, None),
        (date(2024, 1, 3), "AAPL", None, Decimal(12346)),
        (date(2024, 1, 3), "NVDA", Decimal("7.0000"), None),
    ]
    assert rows(cleaning.rejected_rows(text)) == [
        ("2024-01-03", "AAPL", "close", "nan"),
        ("soon", "AAPL", "date", "soon"),
        ("soon", "NVDA", "date", "soon"),
    ]


def test_latest_ingest_survives_and_unreadable_days_stay(spark):
    wide = _landing(
        spark,
        ("2024-01-02", 1, "1", "", ""),
        ("2024-01-02 00:00:00", 2, "2", "", ""),
        ("x", 1, "3", "", ""),
        ("y", 1, "4", "", ""),
        ("2024-01-03", 5, "6", "", ""),
        ("2024-01-03", 5, "7", "", ""),
    )
    kept = rows(cleaning.dedup_by_date(wide), "close_aapl")
    assert kept == [("2",), ("3",), ("4",), ("7",)]


def test_pivot_and_unpivot_are_inverse(spark):
    live = _live(spark, ("2024-01-02", 1, "1", "5", "2"), ("2024-01-03", 1, "3", "6", "4"))
    again = cleaning.typed_bars(cleaning.unpivot_live(landing.pivot_wide(live, TICKERS), TICKERS))
    assert rows(again) == rows(live)


def test_csv_round_trip_and_header_check(spark, tmp_path):
    wide = _landing(spark, ("2024-01-02", 1, "1", "5", "")).drop("ingest_seq")
    path = str(tmp_path / "wide")
    landing.write_wide_csv(wide, path)
    assert rows(landing.read_wide_csv(spark, path, TICKERS).na.fill("")) == rows(wide)
    with pytest.raises(Exception, match="header|schema"):
        landing.read_wide_csv(spark, path, tuple(reversed(TICKERS))).collect()


def test_append_matches_by_name(spark):
    wide = _landing(spark, ("2024-01-02", 1, "1", "5", "2"))
    both = landing.append_rows(wide, wide.select(*reversed(wide.columns)))
    assert both.distinct().count() == 1 and both.count() == 2


def test_incremental_filter_and_late_rows(spark):
    target = _live(spark, ("2024-01-02", 1, "1", "", "2"), ("2024-01-04", 1, "1", "", "2")).where(
        "stock = 'AAPL' or stock_valuation_date = '2024-01-02'"
    )
    source = _live(spark, *((f"2024-01-0{d}", 1, "9", "", "9") for d in (2, 3, 4, 5)))
    fresh = rows(cleaning.incremental_filter(source, target), "stock", "stock_valuation_date")
    assert fresh == [("AAPL", date(2024, 1, 5)), *(("NVDA", date(2024, 1, d)) for d in (3, 4, 5))]
    late = rows(cleaning.late_rows(source, target), "stock", "stock_valuation_date")
    assert late == [*(("AAPL", date(2024, 1, d)) for d in (2, 3, 4)), ("NVDA", date(2024, 1, 2))]
    same = rows(cleaning.late_rows(target.unionByName(source.where("stock_valuation_date = '2024-01-03'")), target), "stock", "stock_valuation_date")
    assert same == [("AAPL", date(2024, 1, 3))]
    assert cleaning.incremental_filter(source, target.limit(0)).count() == source.count()


def test_upsert_replaces_inserts_and_repeats(spark):
    target = _live(spark, ("2024-01-02", 1, "1", "", "2"))
    source = _live(spark, ("2024-01-02", 1, "5", "", "6"), ("2024-01-03", 1, "7", "", "8"))
    once = cleaning.upsert_live(target, source)
    assert rows(once) == rows(source)
    assert rows(cleaning.upsert_live(once, source)) == rows(once)
    appended = cleaning.upsert_live(target, source, allow_corrections=False)
    assert rows(appended, "close_value") == [(Decimal(n).quantize(Decimal("0.0001")),) for n in (1, 2, 7, 8)]


def test_ingest_twice_changes_nothing(spark):
    wide = _landing(spark, ("2024-01-02", 1, "1", "", "2"), ("2024-01-02", 2, "3", "", "4"))
    live = marts.ingest(wide, TICKERS).live
    assert rows(live, "close_value") == [(Decimal("3.0000"),), (Decimal("4.0000"),)]
    again = marts.ingest(wide, TICKERS, live)
    assert rows(again.live) == rows(live) and again.late.count() == again.rejected.count() == 0


def test_nothing_that_lands_is_lost(spark):
    """Every landed bar is in live or late, every text that does not cast among the rejected."""
    first = _landing(spark, ("2024-01-02", 1, "1", "", "2"), ("2024-01-04", 1, "2", "", "3"))
    live = marts.ingest(first, TICKERS).live
    second = _landing(
        spark, ("2024-01-02", 1, "9", "", "9"), ("2024-01-03", 1, "5", "", "6"), ("2024-01-05", 1, "oops", "", "7"), ("no day", 1, "1", "", "1")
    )
    out = marts.ingest(second, TICKERS, live)
    assert rows(out.live, "stock_valuation_date").count((date(2024, 1, 2),)) == 2
    assert {r[0].day for r in rows(out.live, "stock_valuation_date")} == {2, 4, 5}
    assert {r[0].day for r in rows(out.late, "stock_valuation_date")} == {2, 3}
    assert {(r[0], r[1]) for r in rows(out.rejected, "field", "raw_value")} == {("close", "oops"), ("date", "no day")}


def test_restated_and_dateless_rows_are_kept(spark):
    """Another price of a known day is late, a row without a date rejected; rows without a date stay apart."""
    live = marts.ingest(_landing(spark, ("2024-01-02", 1, "1", "", "2"), ("2024-01-04", 1, "2", "", "3")), TICKERS).live
    second = _landing(spark, ("2024-01-02", 1, "8", "", "2"), ("2024-01-04", 1, "2", "", ""), (None, 1, "1", "", "1"), (None, 2, "2", "", "2"), (" ", 3, "1", "", "1"))
    out = marts.ingest(second, TICKERS, live)
    assert rows(out.live) == rows(live)
    late = {(r["stock"], r["stock_valuation_date"].day, r["close_value"]) for r in out.late.collect()}
    assert late == {("AAPL", 2, Decimal("8.0000")), ("NVDA", 4, None)}
    assert rows(out.rejected, "date", "field").count((None, "date")) == 4 and rows(out.rejected, "date", "field").count((" ", "date")) == 2
    long_text = cleaning.unpivot_live(cleaning.dedup_by_date(second), TICKERS)
    balance = {r["outcome"]: r["n"] for r in cleaning.landed_balance(long_text, live).collect()}
    assert balance == {"landed": 10, "unchanged": 2, "restated": 2, "dateless": 6}


def test_empty_landing(spark):
    empty = _landing(spark, ("2024-01-02", 1, "1", "", "2")).limit(0)
    assert marts.ingest(empty, TICKERS).live.count() == 0
    with pytest.raises(ValueError, match="no rows"):
        bar_source.require_rows(empty)


def test_ranges(make_bars):
    bars = make_bars([(s, f"2024-01-0{d}", 1) for s in "AB" for d in range(1, 10)])
    assert bar_source.bars_in_range(bars, "2024-01-03", "2024-01-05", ["A"]).count() == 2
    assert bar_source.bars_in_range(bars).count() == 18
    assert bar_source.bars_full_history(bars).count() == 18
    old_and_new = make_bars([("A", "1904-01-04", 1), ("A", "2126-09-01", 1)])
    assert bar_source.bars_full_history(old_and_new).count() == 2
    assert rows(bar_source.bars_yesterday(bars, "2024-01-05").select("stock_valuation_date").distinct()) == [(date(2024, 1, 4),)]


def test_next_business_day_slice(make_bars):
    bars = make_bars([("A", f"2024-01-{d:02}", 1) for d in range(1, 13)])
    saved = bar_source.last_saved_date(bars.where("stock_valuation_date <= '2024-01-05'"), "stock_valuation_date")
    assert rows(bar_source.next_business_day_slice(bars, saved), "stock_valuation_date") == [(date(2024, 1, 8),)]
    holiday = bars.where("stock_valuation_date <> '2024-01-08'")
    assert rows(bar_source.next_business_day_slice(holiday, saved), "stock_valuation_date") == [(date(2024, 1, 9),)]
    with pytest.raises(Exception, match="out of bounds"):
        bar_source.next_business_day_slice(bars, saved, as_of="2024-01-04").collect()
    nothing = bar_source.last_saved_date(bars.limit(0), "stock_valuation_date")
    with pytest.raises(Exception, match="no last date"):
        bar_source.next_business_day_slice(bars, nothing).collect()


def test_catalog_tables(spark):
    config = LandingConfig(TICKERS, "landing_test")
    tables.create_landing_table(spark, config)
    tables.create_landing_table(spark, config)
    wide = _landing(spark, ("2024-01-02", 1, "1", "", "2"), ("2024-01-02", 2, "3", "", "4"))
    wide.write.mode("append").insertInto("landing_test")
    tables.rebuild_and_swap(spark, "landing_test", cleaning.dedup_by_date(spark.table("landing_test")))
    assert rows(spark.table("landing_test"), "close_aapl") == [("3",)]
    names = {t.name for t in spark.catalog.listTables()}
    assert "landing_test" in names and not {"landing_test_old", "landing_test_rebuilt"} & names

    # Lost after the first rename, and before the last drop: the next run mends both.
    spark.sql("ALTER TABLE landing_test RENAME TO landing_test_old")
    tables.restore(spark, "landing_test")
    assert rows(spark.table("landing_test"), "close_aapl") == [("3",)]
    spark.sql("CREATE TABLE landing_test_old USING parquet AS SELECT 1 AS x")
    tables.rebuild_and_swap(spark, "landing_test", spark.table("landing_test"))
    assert rows(spark.table("landing_test"), "close_aapl") == [("3",)] and not spark.catalog.tableExists("landing_test_old")

    tables.register_sources(spark, wide, LandingConfig(TICKERS, "landing_view"))
    assert spark.table("landing_view").count() == 2
    assert spark.table("highest_lowest_valuation_dim").schema.names == schemas.DIM.names
    spark.sql("DROP TABLE landing_test")


@pytest.mark.parametrize("file_format", ["parquet", "orc", "csv", "json"])
def test_bars_from_files(spark, tmp_path, file_format):
    live = _live(spark, ("2024-01-02", 1, "1", "5", "2"))
    path = str(tmp_path / file_format)
    live.write.format(file_format).save(path)
    assert rows(bar_source.read_bars(spark, path, file_format)) == rows(live)


def test_layouts(spark, make_bars, tmp_path):
    bars = make_bars([(s, f"{y}-01-02", y) for s in "AB" for y in (2020, 2021)])
    tables.write_by_stock(bars, str(tmp_path / "stock"))
    assert spark.read.parquet(str(tmp_path / "stock")).count() == 4

    path = str(tmp_path / "year")
    tables.write_by_year(bars, path)
    corrected = bars.where(F.year("stock_valuation_date") == 2021).withColumn("volume_value", F.lit(7).cast("decimal(18,0)"))
    tables.write_by_year(corrected, path)
    assert rows(spark.read.parquet(path).groupBy("year").agg(F.sum("volume_value").cast("int").alias("v"))) == [
        (2020, 2),
        (2021, 14),
    ]


def test_bars_of_a_hot_stock_combine_before_the_shuffle(spark):
    ticks = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("day"),
        (F.col("id") % 101).cast("double").alias("price"),
        "id",
    )
    bars = bar_source.daily_bars(ticks, F.col("symbol"), F.col("day"), F.col("price"), F.col("id"))
    assert bars.agg(F.sum("volume_value")).first()[0] == 30_000
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
