"""Malformed lines kept apart, and checks that ride on a write."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from streakline import schemas
from streakline.operators import quality
from streakline.sources.landing import read_wide_csv_apart


@pytest.mark.parametrize("header", [True, False])
def test_every_line_is_a_row_or_in_quarantine(spark, tmp_path, header):
    names = schemas.staging_wide(("A",), False).fieldNames()
    width = len(names)
    good = ["2024-01-02," + ",".join("1.5" for _ in range(width - 1)), "2024-01-03," + '"1,5"' + ",x" * (width - 2), "2024-01-04" + "," * (width - 1)]
    bad = ["2024-01-05", "2024-01-06" + ",1" * (width - 2), "2024-01-07" + ",1" * width, '2024-01-08,"a,b"' + ",1" * width]
    for k in range(2):
        lines = ([",".join(names)] if header else []) + good + bad
        (tmp_path / f"{k}.csv").write_text("\n".join(lines) + "\n")
    rows, quarantine = read_wide_csv_apart(spark, str(tmp_path), ("A",), header=header)
    assert rows.columns == names and rows.count() == 6
    assert sorted(r["date"] for r in rows.select("date").collect()) == sorted(["2024-01-02", "2024-01-03", "2024-01-04"] * 2)
    got = quarantine.collect()
    assert sorted((r["line"], r["n_fields"]) for r in got) == sorted([(bad[0], 1), (bad[1], width - 1), (bad[2], width + 1), (bad[3], width + 2)] * 2)
    assert {r["file"].rsplit("/", 1)[1] for r in got} == {"0.csv", "1.csv"}


def test_checks_in_one_pass(spark, tmp_path):
    d = date(2024, 1, 1)
    table = [("a", 1, d, date(2024, 1, 3), 3), ("a", 9, d, d, 1), (None, None, date(2024, 1, 2), d, 0), ("b", 2, d, d, 5), ("c", 2, d, None, None)]
    df = spark.createDataFrame(table, "stock string, key int, start_date date, end_date date, day_length int").repartition(3)
    rules = quality.null_rules(["stock", "end_date"]) | quality.domain_rule("key", [1, 2]) | quality.shape_rules()
    counts = quality.checked_write(df, str(tmp_path / "out"), rules)
    assert counts == {"row_count": 5, "stock_not_null": 1, "end_date_not_null": 1, "key_accepted": 1, "not_reversed": 1, "right_length": 1}
    written = spark.read.parquet(str(tmp_path / "out"))
    listed = quality.failing_rows(written, rules, counts)
    assert sorted((str(r["stock"]), r["failed_rules"]) for r in listed.collect()) == [("None", "stock_not_null,not_reversed"), ("a", "key_accepted"), ("b", "right_length"), ("c", "end_date_not_null")]
    clean = {name: 0 for name in rules}
    assert quality.failing_rows(written, rules, clean).collect() == []
    assert quality.checked_write(df.limit(0), str(tmp_path / "none"), rules) == {name: 0 for name in counts}
    assert quality.not_null(df, ["stock"]).count() == counts["stock_not_null"]
    assert quality.accepted_values(df, "key", [1, 2]).agg(F.sum("row_count")).first()[0] == counts["key_accepted"]
    with pytest.raises(ValueError, match="row_count"):
        quality.checked_write(df, str(tmp_path / "x"), {"row_count": F.lit(True)})
