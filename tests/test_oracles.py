"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from catalog.oracles import ORACLES as SQL
from catalog.queries import QUERIES
from tests.oracle import compare, duck



@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, connection):
    assert compare(QUERIES[name](spark, sf_dir), connection, SQL[name]) == []


def test_entry(spark):
    assert entry(spark).columns == ["id", "stock", "highest_lowest_valuation_key", "start_date", "end_date", "day_length"]
