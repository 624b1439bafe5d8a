from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from streakline.config import IndicatorParams
from streakline.families import AVERAGE, FAMILIES, HIGH_LOW, MOVING_AVG
from streakline.operators import incremental, indicators, quality, streaks
from streakline.plans.increments import StreakStore
from tests.conftest import rows, weekdays

PARAMS = IndicatorParams(band_rows=5, short_rows=2, long_rows=6)


@pytest.fixture(scope="module")
def days(make_bars):
    chance = random.Random(7)
    calendar = weekdays("2024-01-01", 14)
    bars = [(s, d, chance.randint(1, 50)) for s in ("A", "B", "C") for d in calendar if chance.random() < 0.85]
    return indicators.classified(make_bars(bars), PARAMS).persist()


def _metric(spark, *rows_):
    """(stock, key, start, end) rows."""
    df = spark.createDataFrame(
        [(s, k, date.fromisoformat(a), date.fromisoformat(b)) for s, k, a, b in rows_],
        f"stock string, {HIGH_LOW.key_column} int, start_date date, end_date date",
    )
    return streaks.metric_columns(df.withColumn("day_length", F.datediff("end_date", "start_date") + 1), HIGH_LOW)


def _snapshot(spark, *rows_):
    """(stock, day, bucket id) rows."""
    return spark.createDataFrame(
        [(s, date.fromisoformat(d), HIGH_LOW.bucket_names[k - 1]) for s, d, k in rows_],
        f"stock string, stock_valuation_date date, {HIGH_LOW.bucket_column} string",
    ).withColumn("stock_value", F.lit(1).cast("decimal(12,4)"))


def _short(df):
    return rows(df, "stock", HIGH_LOW.key_column, "start_date", "end_date", "day_length")


D = date.fromisoformat


@pytest.mark.parametrize("day", ["2024-01-08", "2024-01-09"])  # a Monday; a Tuesday after a holiday
def test_streak_goes_on_after_weekend_and_holiday(spark, day):
    metric = _metric(spark, ("A", 4, "2024-01-03", "2024-01-05"))
    after = incremental.advance_one_day(metric, _snapshot(spark, ("A", day, 4)), HIGH_LOW)
    assert _short(after) == [("A", 4, D("2024-01-03"), D(day), (D(day) - D("2024-01-03")).days + 1)]
    assert rows(after, "id") == rows(metric, "id")


def test_switch_keeps_the_old_streak_and_opens_one(spark):
    metric = _metric(spark, ("A", 4, "2024-01-03", "2024-01-05"))
    snapshot = _snapshot(spark, ("A", "2024-01-08", 5), ("N", "2024-01-08", 2))
    expected = [
        ("A", 4, D("2024-01-03"), D("2024-01-05"), 3),
        ("A", 5, D("2024-01-08"), D("2024-01-08"), 1),
    ]
    keyed, open_ = incremental.snapshot_with_key(snapshot, HIGH_LOW), incremental.trailing_streaks(metric)
    assert _short(incremental.switch_streaks(open_, keyed, HIGH_LOW)) == expected
    assert _short(incremental.extend_streaks(open_, keyed, HIGH_LOW)) == []
    new_stock = [("N", 2, D("2024-01-08"), D("2024-01-08"), 1)]
    assert _short(incremental.open_streaks(metric, keyed, HIGH_LOW)) == new_stock
    assert _short(incremental.advance_one_day(metric, snapshot, HIGH_LOW)) == expected + new_stock


def test_same_day_again_changes_nothing(spark):
    metric = _metric(spark, ("A", 4, "2024-01-03", "2024-01-05"), ("B", 1, "2024-01-05", "2024-01-05"))
    snapshot = _snapshot(spark, ("A", "2024-01-08", 5), ("B", "2024-01-08", 1))
    once = incremental.upsert_streaks(metric, incremental.advance_one_day(metric, snapshot, HIGH_LOW))
    twice = incremental.upsert_streaks(once, incremental.advance_one_day(once, snapshot, HIGH_LOW))
    assert rows(once) == rows(twice) and once.count() == 3


def test_trailing_and_closed_by_snapshot_day(spark):
    metric = _metric(spark, ("A", 4, "2024-01-03", "2024-01-05"), ("B", 1, "2024-01-02", "2024-01-04"))
    monday = _snapshot(spark, ("A", "2024-01-08", 5))
    assert [r[0] for r in _short(incremental.trailing_streaks(metric, monday))] == ["A"]
    assert [r[0] for r in _short(incremental.trailing_streaks(metric))] == ["A", "B"]
    assert [r[0] for r in _short(incremental.closed_streaks(metric, monday))] == ["A", "B"]
    assert [r[0] for r in _short(incremental.closed_streaks(metric, _snapshot(spark, ("A", "2024-01-06", 5))))] == ["B"]


@pytest.mark.parametrize("family", FAMILIES, ids=lambda f: f.name)
def test_day_by_day_equals_rebuild(spark, days, family, tmp_path):
    metric = None
    for i, (day,) in enumerate(sorted(days.select("stock_valuation_date").distinct().collect())):
        today = days.where(F.col("stock_valuation_date") == F.lit(day))
        if metric is None:
            metric = streaks.metric_full(today, family)
        else:
            snapshot = indicators.snapshot_columns(today)
            metric = incremental.upsert_streaks(metric, incremental.advance_one_day(metric, snapshot, family))
        metric.write.parquet(str(tmp_path / f"day{i}"))
        metric = spark.read.parquet(str(tmp_path / f"day{i}"))
    assert rows(metric) == rows(streaks.metric_full(days, family))


@pytest.mark.parametrize("cut", ["2024-01-02", "2024-01-06", "2024-01-12"])
def test_many_days_at_once_equal_rebuild(days, cut):
    day = F.col("stock_valuation_date")
    old = streaks.metric_full(days.where(day < cut), HIGH_LOW)
    new = days.where(day >= cut)
    whole = rows(streaks.metric_full(days, HIGH_LOW))
    once = incremental.advance_many_days(old, new, HIGH_LOW)
    assert rows(once) == whole
    assert rows(incremental.advance_many_days(once, new, HIGH_LOW)) == whole
    assert rows(incremental.build_or_advance(old, new, HIGH_LOW)) == whole


def test_empty_or_missing_mart_is_built(days):
    whole = rows(streaks.metric_full(days, MOVING_AVG))
    assert rows(incremental.build_or_advance(None, days, MOVING_AVG)) == whole
    assert rows(incremental.build_or_advance(streaks.metric_full(days, MOVING_AVG).limit(0), days, MOVING_AVG)) == whole


def test_advance_ignores_late_days_and_passes_idle_stocks(spark, days):
    trailing = incremental.trailing_streaks(streaks.metric_full(days, HIGH_LOW))
    again = incremental.advance(trailing, days.where("stock = 'A'"), HIGH_LOW)
    assert rows(again.drop("is_open")) == rows(trailing)
    assert again.where("not is_open").count() == 0


def test_streaks_cover_every_day_once(make_bars, days):
    live = days.select("stock", "stock_valuation_date")
    for family in FAMILIES:
        metric = streaks.metric_full(days, family)
        assert quality.streak_cover(live, metric).count() == 0
        assert quality.streak_shape(metric).count() == 0
        assert quality.unique(metric, ["stock", "start_date"]).count() == 0
        assert quality.freshness(live, metric).count() == 0


def test_extremes_count_trading_days(make_bars):
    bars = make_bars([("A", d, p) for d, p in zip(weekdays("2024-01-04", 4), (10, 10, 10, 20), strict=True)])
    found = streaks.streak_extremes(indicators.classified(bars, carry=("high_value", "low_value")), HIGH_LOW)
    assert rows(found, "start_date", "trading_days", "day_length") == [
        (D("2024-01-04"), 3, 5),
        (D("2024-01-09"), 1, 1),
    ]
    assert sum(r[1] for r in rows(found, "start_date", "trading_days")) == bars.count()


def test_store_in_batches_equals_rebuild(spark, make_bars, tmp_path):
    chance = random.Random(3)
    calendar = weekdays("2024-01-01", 20)
    all_rows = [(s, d, chance.randint(1, 50)) for s in ("A", "B", "C") for d in calendar if chance.random() < 0.9]
    store = StreakStore(spark, str(tmp_path / "store"), params=PARAMS)
    cuts = [[], calendar[:8], [], calendar[8:9], calendar[9:]]
    for batch, part in enumerate(cuts):
        bars = make_bars([r for r in all_rows if r[1] in part] or all_rows[:1])
        store.apply(batch, bars if part else bars.limit(0))

    whole = indicators.classified(make_bars(all_rows), PARAMS)
    last = len(cuts) - 1
    assert rows(store.days(last).drop("stddev_90")) == rows(whole.drop("stddev_90"))
    expected = {f.mart: rows(streaks.metric_full(whole, f)) for f in FAMILIES}
    for family in FAMILIES:
        assert rows(store.metric(family, last)) == expected[family.mart]

    # A batch run again, as after a lost driver, leaves the same tables.
    store.apply(last, make_bars([r for r in all_rows if r[1] in cuts[last]]))
    assert rows(store.metric(HIGH_LOW, last)) == expected[HIGH_LOW.mart]
    # An earlier state is still there to read.
    assert store.metric(HIGH_LOW, 1).agg(F.max("end_date")).first()[0] <= calendar[7]


@pytest.mark.parametrize("every", [1, 2, 3, 16])
def test_touched_stocks_and_compaction(spark, make_bars, tmp_path, every):
    """One stock trades in each batch, one only in the first, one comes and goes."""
    calendar = weekdays("2024-01-01", 12)
    chance = random.Random(8)
    closes = {s: [chance.randint(1, 9) for _ in calendar] for s in "ABC"}
    store = StreakStore(spark, str(tmp_path / "touched"), (HIGH_LOW,), PARAMS, compact_every=every)
    taken = []
    for batch in range(6):
        present = "ABC" if batch == 0 else "AC" if batch % 2 else "A"
        fresh = [(s, calendar[i], closes[s][i]) for s in present for i in (2 * batch, 2 * batch + 1)]
        taken += fresh
        store.apply(batch, make_bars(fresh))
        written = spark.read.parquet(f"{store.root}/tail/batch={batch}").select("stock").distinct()
        assert {r[0] for r in written.collect()} == set("ABC" if batch % every == 0 else present)
    whole = indicators.classified(make_bars(taken), PARAMS)
    assert rows(store.metric(HIGH_LOW, 5)) == rows(streaks.metric_full(whole, HIGH_LOW))
    assert rows(store.open_streaks(HIGH_LOW, 5), "stock") == [("A",), ("B",), ("C",)]


def test_days_without_bucket_end_streaks_in_batches_too(spark, make_bars, tmp_path):
    calendar = weekdays("2024-01-01", 9)
    closes = (1, 9, 9, None, 9, None, 9, 9, 9)
    all_rows = [("A", d, c) for d, c in zip(calendar, closes, strict=True)]
    params = IndicatorParams(null_policy="null")
    whole = rows(streaks.metric_full(indicators.classified(make_bars(all_rows), params), HIGH_LOW))
    assert len(whole) == 4
    for cuts in ((3, 4), (3, 6), (5, 8), (6, 7)):
        store = StreakStore(spark, str(tmp_path / f"null{cuts}"), (HIGH_LOW,), params)
        for batch, (start, end) in enumerate(zip((0, *cuts), (*cuts, 9), strict=True)):
            store.apply(batch, make_bars(all_rows[start:end]))
        assert rows(store.metric(HIGH_LOW, 2)) == whole, cuts
    assert store.late(0).count() == 0


def test_any_cuts_give_the_rebuild_under_the_null_policy(spark, make_bars):
    """All pairs of cuts of nine days, a stock for each, so that one plan tries them all at once."""
    calendar = weekdays("2024-01-01", 9)
    closes = (1, 9, 9, None, 9, None, 9, 9, 9)
    pairs = [(a, b) for a in range(1, 9) for b in range(a, 9)]
    bars = make_bars([(f"{a}-{b}", d, c) for a, b in pairs for d, c in zip(calendar, closes, strict=True)])
    days = indicators.classified(bars, IndicatorParams(null_policy="null")).cache()
    place = F.datediff("stock_valuation_date", F.lit(calendar[0])) - 2 * (F.datediff("stock_valuation_date", F.lit(calendar[0])) >= 7).cast("int")
    first, second = (F.split("stock", "-")[i].cast("int") for i in (0, 1))
    parts = [days.where(place < first), days.where((place >= first) & (place < second)), days.where(place >= second)]
    for family in FAMILIES:
        whole = rows(streaks.metric_full(days, family))
        by_steps = incremental.advance_many_days(streaks.metric_full(parts[0], family), parts[1], family, parts[0])
        by_steps = incremental.advance_many_days(by_steps, parts[2], family, parts[0].unionByName(parts[1]))
        assert rows(by_steps) == whole
        open_ = incremental.advance(None, parts[0], family)
        then = incremental.advance(open_.drop("is_open"), parts[1], family, parts[0])
        last = incremental.advance(then.drop("is_open"), parts[2], family, parts[0].unionByName(parts[1]))
        assert rows(last.drop("is_open")) == whole
    days.unpersist()


def test_store_keeps_late_bars_apart(spark, make_bars, tmp_path):
    store = StreakStore(spark, str(tmp_path / "late"), (HIGH_LOW,), PARAMS)
    store.apply(0, make_bars([("A", "2024-01-02", 5), ("A", "2024-01-04", 6)]))
    store.apply(1, make_bars([("A", "2024-01-03", 9), ("A", "2024-01-04", 6), ("A", "2024-01-05", 6), ("B", "2024-01-02", 1)]))
    assert rows(store.late(1), "stock", "stock_valuation_date") == [("A", D("2024-01-03"))]
    assert store.days(1).count() == 4


@pytest.mark.parametrize("policy", ["else", "null"])
def test_corrections_equal_a_rebuild(spark, make_bars, policy):
    """Changed, added and removed bars, a stock per case; NULL closes among them."""
    params = IndicatorParams(band_rows=5, short_rows=2, long_rows=6, null_policy=policy)
    calendar, chance = weekdays("2024-01-01", 30), random.Random(13)
    old, live, wrong = [], [], []
    for case in range(60):
        closes = {d: chance.choice([None, *range(1, 12)]) if chance.random() < 0.3 else chance.randint(1, 12) for d in calendar if chance.random() < 0.9}
        first = chance.randrange(25)
        fixed = dict(closes)
        for d in chance.sample(calendar[first : first + 4], 2):
            kind = chance.randrange(4)
            if kind == 0:
                fixed.pop(d, None)
            else:
                fixed[d] = chance.choice([0, 20, None, *range(1, 12)])
            wrong.append((f"s{case}", d))
        old += [(f"s{case}", d, c) for d, c in closes.items()]
        live += [(f"s{case}", d, c) for d, c in fixed.items()]
    bars = make_bars(live + [("still", d, 5) for d in calendar]).cache()
    days = indicators.classified(make_bars(old + [("still", d, 5) for d in calendar]), params).cache()
    corrections = spark.createDataFrame(wrong, "stock string, stock_valuation_date date")
    again = indicators.classified(bars, params).cache()
    for family in FAMILIES:
        corrected = incremental.correct_streaks(streaks.metric_full(days, family), days, bars, corrections, family, params)
        assert rows(corrected) == rows(streaks.metric_full(again, family))
        stops = incremental.correction_spans(days, bars, corrections, family, params).where("until_day IS NOT NULL").count()
        assert stops > 10


def test_corrections_where_no_table_is_broadcast(spark, make_bars):
    """Larger tables meet by shuffles on both sides."""
    calendar = weekdays("2024-01-01", 40)
    old = [(f"s{k}", d, 10 + (i * 7 + k * 3) % 11) for k in range(12) for i, d in enumerate(calendar)]
    live = [(s, d, c + 4 if s in ("s1", "s5") and d == calendar[20] else c) for s, d, c in old]
    days, bars = indicators.classified(make_bars(old)), make_bars(live)
    corrections = spark.createDataFrame([(s, calendar[20]) for s in ("s1", "s5")], "stock string, stock_valuation_date date")
    expected = rows(streaks.metric_full(indicators.classified(bars), HIGH_LOW))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(incremental.correct_streaks(streaks.metric_full(days, HIGH_LOW), days, bars, corrections, HIGH_LOW)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_corrections_stop_where_all_agrees(spark, make_bars):
    """A corrected price inside the records concerns one day of the record family and a window's length of the others;
    a new record high until the old one is passed."""
    calendar = weekdays("2024-01-01", 60)
    closes = [1, 50, *[10 + i % 7 for i in range(48)], 90, *[20] * 9]
    days = indicators.classified(make_bars([(s, d, c) for s in "AB" for d, c in zip(calendar, closes, strict=True)]), PARAMS)
    wrong = [("A", calendar[5], 30), ("B", calendar[5], 80)]
    fixed = [(s, d, next((c for t, e, c in wrong if (t, e) == (s, d)), c)) for s in "AB" for d, c in zip(calendar, closes, strict=True)]
    corrections = make_bars(wrong)
    expected = {HIGH_LOW: (6, 50), AVERAGE: (10, 50), MOVING_AVG: (11, 50)}
    for family, stops in expected.items():
        spans = incremental.correction_spans(days, make_bars(fixed), corrections, family, PARAMS)
        assert rows(spans) == sorted((s, calendar[5], calendar[i]) for s, i in zip("AB", stops, strict=True))


def test_closed_streaks_lie_in_levels(spark, make_bars, tmp_path):
    """64 batches: few tables hold any number of them, each batch once."""
    for every in (2, 4, 8):
        store = StreakStore(spark, str(tmp_path), (HIGH_LOW,), PARAMS, merge_every=every)
        for batch in range(64):
            tables = store.closed_tables(batch)
            held = [b for level, last in tables for b in range(last - every**level + 1, last + 1)]
            assert held == list(range(batch + 1))
            levels = len([n for n in range(1, 7) if every**n <= batch + 1]) + 1
            assert len(tables) <= (every - 1) * levels


def test_merged_levels_equal_a_rebuild(spark, make_bars, tmp_path):
    """Every state reads as rebuilt, also after a batch in the middle has run again."""
    calendar, chance = weekdays("2024-01-01", 9), random.Random(21)
    all_rows = [(s, d, chance.randint(1, 50)) for s in "AB" for d in calendar]
    store = StreakStore(spark, str(tmp_path / "levels"), (HIGH_LOW,), PARAMS, merge_every=2)
    for batch, day in enumerate(calendar):
        store.apply(batch, make_bars([r for r in all_rows if r[1] == day]))
    store.apply(8, make_bars([r for r in all_rows if r[1] == calendar[8]]))
    whole = indicators.classified(make_bars(all_rows), PARAMS).cache()
    for batch in (0, 1, 2, 3, 6, 8):
        expected = streaks.metric_full(whole.where(F.col("stock_valuation_date") <= calendar[batch]), HIGH_LOW)
        assert rows(store.metric(HIGH_LOW, batch)) == rows(expected), batch
    assert store.closed_tables(8) == [(3, 7), (0, 8)]
    begun = streaks.metric_full(whole, HIGH_LOW).where(F.col("start_date") == calendar[8])
    assert rows(store.opened(HIGH_LOW, 8)) == rows(begun)


def test_batches_meet_one_row_per_stock(spark, make_bars, tmp_path):
    """The stored history is one bounded row per stock; sums that begin before a batch come from its arrays, also
    where closes are missing or a batch is longer than the windows."""
    params = IndicatorParams(band_rows=5, short_rows=2, long_rows=6)
    calendar, chance = weekdays("2024-01-01", 30), random.Random(5)
    all_rows = [(s, d, chance.choice([None, *range(1, 12)])) for s in "ABCD" for d in calendar if chance.random() < 0.8]
    cuts = [calendar[:4], calendar[4:6], calendar[6:7], calendar[7:20], calendar[20:]]
    store = StreakStore(spark, str(tmp_path / "rows"), params=params)
    for batch, part in enumerate(cuts):
        fresh = [r for r in all_rows if r[1] in part and not (r[0] == "D" and batch < 2)]
        store.apply(batch, make_bars(fresh))
        stored = spark.read.parquet(f"{store.root}/tail/batch={batch}")
        assert stored.count() == len({r[0] for r in fresh})
        longest = stored.agg(*(F.max(F.size(f"{c}_history")) for c in ("_count", "_sum", "_squares"))).first()
        assert longest[0] <= params.history_rows + 1 and longest[1] <= params.history_rows + 1 and longest[2] <= params.band_rows
    taken = [r for r in all_rows if r[0] != "D" or r[1] >= calendar[6]]
    whole = indicators.classified(make_bars(taken), params)
    assert rows(store.days(4).drop("stddev_90")) == rows(whole.drop("stddev_90"))
    for family in FAMILIES:
        assert rows(store.metric(family, 4)) == rows(streaks.metric_full(whole, family))
        assert rows(store.summary(family, 4)) == rows(streaks.bucket_summary(streaks.metric_full(whole, family), family))
    assert store.newest_day(4) == max(r[1] for r in taken)
