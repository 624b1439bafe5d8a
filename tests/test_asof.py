"""As-of joins against a look at every value."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from streakline.operators.asof import asof_join
from tests.conftest import rows

START = datetime(2024, 1, 1)
EVENTS = "`key` string, at timestamp, n int, matched_before string"
VALUES = "`key` string, at timestamp, price int, note string"


def _plain(event, values, tolerance, direction):
    key, at, *_ = event
    if key is None or at is None:
        return None
    side = {"backward": lambda t: t <= at, "forward": lambda t: t >= at, "nearest": lambda t: True}[direction]
    known = [v for v in values if v[0] == key and v[1] is not None and side(v[1]) and abs(at - v[1]) <= tolerance]
    if not known:
        return None
    order = lambda v: (v[2] is not None, v[2] or 0, v[3] is not None, v[3] or "")
    best = min(abs(at - v[1]) for v in known)
    times = sorted({v[1] for v in known if abs(at - v[1]) == best})
    return max((v for v in known if v[1] == times[0]), key=order)[1:]


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("slice_", ["7 minutes", "1 hour", "30 days"])
def test_as_defined(spark, direction, slice_):
    rnd = random.Random(direction + slice_)
    keys = ["hot"] * 6 + ["a", "b", None]

    def at():
        return None if rnd.random() < 0.05 else START + timedelta(minutes=rnd.randrange(240))

    events = [(rnd.choice(keys), at(), i, "x") for i in range(300)]
    values = [(rnd.choice([*keys, "only"]), at(), rnd.choice([None, 1, 2, 3]), rnd.choice([None, "u"])) for _ in range(150)]
    df = asof_join(spark.createDataFrame(events, EVENTS).repartition(3), spark.createDataFrame(values, VALUES), ["key"], "at", "25 minutes", direction, slice_)
    assert df.columns == ["key", "at", "n", "matched_before", "matched"]
    found = {r["n"]: None if r["matched"] is None else tuple(r["matched"]) for r in df.collect()}
    assert found == {e[2]: _plain(e, values, timedelta(minutes=25), direction) for e in events}


def test_without_tolerance_and_with_empty_sides(spark):
    events = spark.createDataFrame([("a", START, 1, ""), ("a", START + timedelta(days=900), 2, "")], EVENTS)
    values = spark.createDataFrame([("a", START, 5, None), ("a", START, 7, None)], VALUES)
    found = asof_join(events, values, ["key"], "at")
    assert rows(found, "n", "matched.price") == [(1, 7), (2, 7)]
    assert rows(asof_join(events, values.limit(0), ["key"], "at"), "n", "matched.price") == [(1, None), (2, None)]
    assert asof_join(events.limit(0), values, ["key"], "at").count() == 0
    with pytest.raises(ValueError, match="direction"):
        asof_join(events, values, ["key"], "at", direction="sideways")


def test_no_range_join_and_a_hot_key_is_spread(spark):
    events = spark.range(1000).select(F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id") * 86_400).alias("at"))
    plan = asof_join(events, events.withColumn("price", F.lit(1)), ["key"], "at")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan and "_slice" in plan


def test_both_directions_share_one_shuffle(spark):
    events = spark.range(100).select(F.lit("a").alias("key"), F.timestamp_seconds(F.col("id") * 86_400).alias("at"))
    values = events.withColumn("price", F.lit(1))
    exchanges = [
        asof_join(events, values, ["key"], "at", direction=d)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(")
        for d in ("backward", "nearest")
    ]
    assert exchanges[0] == exchanges[1]


def test_slices_without_events_receive_nothing_and_old_values_do_not_travel(spark):
    """The same rows, whether values are carried over empty slices or have grown too old on the way."""
    events = [("a", START + timedelta(days=d), i, "") for i, d in enumerate((0, 89, 91, 400))]
    values = [("a", START + timedelta(days=d), d, None) for d in (1, 35, 70, 180, 330)]
    for direction in ("backward", "forward", "nearest"):
        df = asof_join(spark.createDataFrame(events, EVENTS), spark.createDataFrame(values, VALUES), ["key"], "at", "90 days", direction)
        found = {r["n"]: None if r["matched"] is None else tuple(r["matched"]) for r in df.collect()}
        assert found == {e[2]: _plain(e, values, timedelta(days=90), direction) for e in events}
