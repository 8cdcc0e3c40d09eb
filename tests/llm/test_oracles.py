"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest
from oracle import difference, duck

from tidegauge.llm.oracles import ORACLES
from tidegauge.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf, name):
    diff, n = difference(spark, duck(sf), sf, name, QUERIES[name], ORACLES[name])
    assert diff is None and n > 0
