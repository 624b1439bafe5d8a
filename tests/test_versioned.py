"""Versions of a table: merges by touched files, reading back, lost and rival writers."""

from __future__ import annotations

from pathlib import Path

import pytest

from streakline.sources import versioned
from streakline.sources.versioned import Conflict, VersionedTable
from tests.conftest import rows

SCHEMA = "stock string, day int, price int"


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema)
    whole = spark.createDataFrame([(s, d, 1) for s in "ABCD" for d in range(10)], SCHEMA)
    made.replace(whole.repartitionByRange(4, "stock"))
    return made


def _stamps(table, version=None):
    return {f: Path(f.removeprefix("file:")).stat().st_mtime_ns for f in table.files(version)}


def test_a_merge_rewrites_touched_files_only(spark, table):
    before = _stamps(table)
    assert len(before) == 4
    source = spark.createDataFrame([("B", 3, 7), ("B", 99, 8)], SCHEMA)
    assert table.merge(source, ["stock", "day"]) == 1
    after = _stamps(table)
    assert len(set(before) & set(after)) == 3
    assert all(after[f] == before[f] for f in set(before) & set(after))
    expected = {(s, d, 1) for s in "ABCD" for d in range(10)} - {("B", 3, 1)} | {("B", 3, 7), ("B", 99, 8)}
    assert set(rows(table.as_of())) == expected and table.as_of().count() == 41


def test_new_keys_touch_no_file(spark, table):
    before = table.files()
    table.merge(spark.createDataFrame([("E", 1, 1), (None, 2, 2), ("C", 50, 5)], SCHEMA), ["stock", "day"])
    assert set(before) < set(table.files())
    assert table.as_of().count() == 43


def test_readers_stay_on_their_version(spark, table):
    pinned = table.as_of(0)
    table.merge(spark.createDataFrame([("A", 0, 5)], SCHEMA), ["stock", "day"])
    table.replace(table.as_of().where("stock = 'A'"))
    assert pinned.count() == 40 and pinned.agg({"price": "max"}).first()[0] == 1
    assert [table.as_of(v).count() for v in table.versions()] == [40, 40, 10]
    table.append(spark.createDataFrame([("Z", 1, 1)], SCHEMA))
    assert table.as_of().count() == 11 and table.as_of(2).count() == 10
    with pytest.raises(ValueError, match="no version 9"):
        table.as_of(9)


def test_empty_and_doubled_sources(spark, table):
    assert table.merge(table.as_of().limit(0), ["stock", "day"]) == 0 and table.versions() == [0]
    with pytest.raises(Exception, match="twice"):
        table.merge(spark.createDataFrame([("A", 1, 1), ("A", 1, 2)], SCHEMA), ["stock", "day"])
    assert table.versions() == [0] and table.as_of().count() == 40


def test_an_empty_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "new"), spark.createDataFrame([], SCHEMA).schema)
    assert table.versions() == [] and table.as_of().count() == 0
    assert table.merge(spark.createDataFrame([("A", 1, 1)], SCHEMA), ["stock", "day"]) == 0
    assert rows(table.as_of()) == [("A", 1, 1)]


@pytest.mark.parametrize("step", ["_written", "_publish", "upsert"])
def test_a_run_lost_at_any_step_leaves_the_table_whole(spark, table, monkeypatch, step):
    source = spark.createDataFrame([("A", 0, 5)], SCHEMA)

    def lost(*args, **kwargs):
        raise KeyboardInterrupt

    if step == "upsert":
        monkeypatch.setattr(versioned, "upsert", lost)
    else:
        monkeypatch.setattr(VersionedTable, step, lost)
    with pytest.raises(KeyboardInterrupt):
        table.merge(source, ["stock", "day"])
    monkeypatch.undo()
    assert table.versions() == [0] and table.as_of().agg({"price": "sum"}).first()[0] == 40
    assert table.merge(source, ["stock", "day"]) == 1
    assert table.as_of().agg({"price": "sum"}).first()[0] == 44


def test_the_second_of_two_writers_is_told(spark, table):
    files = table.files()
    assert table._publish(files, 0) == 1
    with pytest.raises(Conflict, match="version 1"):
        table._publish(files[:1], 0)
    assert table.versions() == [0, 1] and table.files() == files


def test_vacuum_keeps_what_versions_use(spark, table):
    table.merge(spark.createDataFrame([("A", 0, 5)], SCHEMA), ["stock", "day"])
    table._written(table.as_of().limit(1))  # of a lost run
    assert table.vacuum(keep=2) == 1
    table.replace(table.as_of().where("stock = 'B'"))
    assert table.vacuum() == 2
    assert table.versions() == [2] and table.as_of().count() == 10
