"""The registered queries against their SQL."""

from __future__ import annotations

import pytest

from streakline.llm.oracles import ORACLES
from streakline.llm.queries import QUERIES
from tests.oracle import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, sf_dir):
    assert compare(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) == []
