from __future__ import annotations

import pytest

from datetime import date

from pyspark.sql import functions as F

from streakline.families import HIGH_LOW
from streakline.operators import alerts, quality, streaks
from streakline.plans import marts
from streakline.sources.dims import dim
from tests.conftest import rows

D = date.fromisoformat


def _metric(spark, *rows_):
    return spark.createDataFrame(
        [(s, k, D(a), D(b), n) for s, k, a, b, n in rows_],
        f"stock string, {HIGH_LOW.key_column} int, start_date date, end_date date, day_length int",
    )


def test_freshness_per_stock(spark, make_bars):
    live = make_bars([("A", "2024-01-02", 1), ("A", "2024-01-03", 1), ("B", "2024-01-02", 1), ("C", "2024-01-02", 1)])
    metric = _metric(spark, ("A", 1, "2024-01-02", "2024-01-02", 1), ("B", 1, "2024-01-02", "2024-01-02", 1))
    found = rows(quality.freshness(live, metric), "stock", "stock_valuation_date", "newest_end_date")
    assert found == [("A", D("2024-01-03"), D("2024-01-02")), ("C", D("2024-01-02"), None)]


def test_unique_not_null_accepted(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "name string, n int")
    assert rows(quality.unique(df, ["name", "n"])) == [("a", 1, 2)]
    assert sorted(r[2] for r in rows(quality.not_null(df, ["name", "n"]))) == ["n", "name"]
    assert rows(quality.accepted_values(df, "name", ["b"])) == [("a", 2)]


def test_relationships_both_ways(spark):
    names = dim(spark, HIGH_LOW)
    metric = _metric(spark, ("A", 5, "2024-01-02", "2024-01-02", 1), ("A", 9, "2024-01-03", "2024-01-03", 1))
    assert rows(quality.relationships(metric, HIGH_LOW.key_column, names, "id"), HIGH_LOW.key_column) == [(9,)]
    days = spark.createDataFrame([("mid_range",), ("sideways",), (None,)], f"{HIGH_LOW.bucket_column} string")
    missing = quality.relationships(days, HIGH_LOW.bucket_column, names, "bucket_name")
    assert rows(missing) == [("sideways",)]
    assert streaks.with_key(days.where("highest_lowest_valuation <> 'sideways'"), HIGH_LOW).count() == 1
    with pytest.raises(Exception, match="lacks sideways"):
        streaks.with_key(days, HIGH_LOW).collect()


def test_cover_counts_gaps_and_overlaps(spark, make_bars):
    live = make_bars([("A", f"2024-01-0{d}", 1) for d in range(1, 7)] + [("B", "2024-01-01", 1)])
    metric = _metric(
        spark,
        ("A", 1, "2024-01-01", "2024-01-03", 3),
        ("A", 2, "2024-01-03", "2024-01-04", 2),
        ("A", 3, "2024-01-06", "2024-01-06", 1),
    )
    assert rows(quality.streak_cover(live, metric)) == [
        ("A", D("2024-01-03"), 2),
        ("A", D("2024-01-05"), 0),
        ("B", D("2024-01-01"), 0),
    ]


def test_shape_faults(spark):
    metric = _metric(
        spark,
        ("A", 1, "2024-01-01", "2024-01-03", 3),
        ("A", 2, "2024-01-03", "2024-01-04", 2),
        ("A", 3, "2024-01-06", "2024-01-07", 1),
        ("B", 3, "2024-01-06", "2024-01-05", 0),
        ("B", 3, "2024-01-08", "2024-01-08", 1),
    )
    assert [r[-1] for r in rows(quality.streak_shape(metric))] == ["overlap", "wrong_length", "reversed"]


def test_alerts(spark, tmp_path):
    metric = _metric(
        spark,
        ("A", 4, "2024-01-01", "2024-01-03", 3),
        ("A", 5, "2024-01-04", "2024-01-04", 1),
        ("A", 3, "2024-01-05", "2024-01-05", 1),
        ("B", 1, "2024-01-02", "2024-01-02", 1),
    )
    latest = alerts.latest_streak_alerts(metric)
    assert rows(latest, "stock", HIGH_LOW.key_column) == [("A", 3), ("B", 1)]
    events = rows(alerts.bucket_break_events(metric), "event_date", "from_key", "to_key", "left_after_days", "direction")
    assert events == [(D("2024-01-04"), 4, 5, 3, "up"), (D("2024-01-05"), 5, 3, 1, "down")]
    path = str(tmp_path / "alerts")
    alerts.write_alerts(alerts.alert_payload(latest), path)
    text = '{"stock":"B","valuation_key":1,"start_date":"2024-01-02","end_date":"2024-01-02","day_length":1}'
    assert text in [r.value for r in spark.read.text(path).collect()]
    assert rows(marts.daily_alerts(metric)) == rows(spark.read.text(path))


def test_reconcile_counts_copies_and_nulls(spark):
    schema = "stock string, key int"
    ours = spark.createDataFrame([("A", 1), ("A", 1), ("B", None), ("C", 3)], schema)
    theirs = spark.createDataFrame([("A", 1), ("B", None), ("C", 4)], schema)
    assert rows(alerts.reconcile(ours, theirs, ["stock", "key"])) == [("A", 1, 2, 1), ("C", 3, 1, 0), ("C", 4, 0, 1)]
    assert alerts.reconcile(ours, ours, ["stock", "key"]).count() == 0


def test_summary_and_tracking(spark, make_bars):
    metric = _metric(spark, ("A", 4, "2024-01-01", "2024-01-03", 3), ("A", 4, "2024-01-09", "2024-01-12", 4))
    assert rows(streaks.bucket_summary(metric, HIGH_LOW)) == [("A", 4, 2, 7, 3.5, 4)]
    tracked = streaks.daily_tracking(make_bars([("A", "2024-01-01", 2), ("A", "2024-01-02", 5)]))
    assert [(r.previous_close, r.day_change) for r in tracked.orderBy("stock_valuation_date").collect()] == [
        (None, None),
        (2, 3),
    ]


def test_record_max_per_bucket(spark):
    days = spark.createDataFrame(
        [("A", D("2024-01-01"), "x", 5), ("A", D("2024-01-02"), "y", 1), ("A", D("2024-01-03"), "x", 3)],
        f"stock string, stock_valuation_date date, {HIGH_LOW.bucket_column} string, stock_value int",
    )
    assert [r[-1] for r in rows(streaks.bucket_record_max(days, HIGH_LOW))] == [5, 1, 5]


def test_dims_are_whole(spark):
    assert rows(dim(spark, HIGH_LOW), "id", "bucket_name") == [(i, n) for i, n, _ in HIGH_LOW.buckets]
    assert dim(spark, HIGH_LOW).where(F.col("bucket_description") == "").count() == 0
