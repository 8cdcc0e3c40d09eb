"""Every registered query against its SQL on DuckDB, and plan properties that matter at scale."""

from __future__ import annotations

import pytest
from conftest import SF
from oracle import difference, duck

from pyspark.sql import functions as F

from tidegauge.operators.parse import parse_events
from tidegauge.registry import ORACLES, QUERIES
from tidegauge.registry.core import Model


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    diff, n = difference(spark, con, SF, name, lambda *_: df, ORACLES.get(name))
    assert diff is None and n >= 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_adapter_equals_its_own_json(spark):
    """The directly derived rows are what parsing the derived JSON gives."""
    m = Model(spark, SF)
    direct = m.parsed.drop("source_file")
    parsed = parse_events(m.bronze).drop("source_file")
    parsed = parsed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))
    assert direct.select(*parsed.columns).exceptAll(parsed).count() == 0


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["alt1_silver_gap"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in text
