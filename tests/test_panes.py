"""Windows merged from panes against windows over the events."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from events import T0, raw, write_lines
from pyspark.sql import functions as F

from tidegauge.model import contracts as c
from tidegauge.operators.panes import page_activity, page_panes, windows_of_panes
from tidegauge.operators.windows import page_metrics, sliding_page_metrics
from tidegauge.sources.tables import Tables
from tidegauge.streaming.flows import Medallion

START = datetime(2024, 5, 1)
SCHEMA = "event_timestamp timestamp, title string, namespace int, user string, byte_delta int, minor boolean"


@pytest.fixture
def events(spark):
    rng = random.Random(2)
    data = [(START + timedelta(seconds=rng.randrange(7200)), f"p{rng.randrange(3)}", 0, rng.choice(["a", "b", "c", None]),
             rng.choice([None, 5, -7]), rng.random() < 0.5) for _ in range(400)]
    return spark.createDataFrame([*data, (None, "p0", 0, "a", 1, True), (START, "quiet", 1, None, None, None)], SCHEMA)


def test_windows_equal_those_of_the_events(events):
    panes = page_panes(events)
    assert rows(windows_of_panes(panes, 5), *page_metrics(events).columns) == rows(page_metrics(events, exact=True))
    sliding = sliding_page_metrics(events, exact=True)
    assert rows(windows_of_panes(panes, 15, 1), *sliding.columns) == rows(sliding)
    assert rows(windows_of_panes(panes, 60), "title", "edit_count") == rows(page_metrics(events, "1 hour"), "title", "edit_count")
    with pytest.raises(ValueError):
        windows_of_panes(panes, 15, 4)


def test_editors_of_a_span_count_once(events):
    got = {r.title: (r.edit_count, r.unique_editors) for r in page_activity(page_panes(events), START + timedelta(hours=2), "2 HOURS").collect()}
    want = {r.title: (r.n, r.e) for r in events.filter("event_timestamp IS NOT NULL").groupBy("title").agg(
        F.count("*").alias("n"), F.countDistinct("user").alias("e")).collect()}
    assert got == want and got["quiet"] == (1, 0)
    top = page_activity(page_panes(events), START + timedelta(hours=2), "2 HOURS", 1).collect()
    assert len(top) == 1 and top[0].edit_count == max(n for n, _ in want.values())


def test_error_of_many_editors(spark):
    many = spark.range(60_000).select(
        (F.lit(START).cast("timestamp") + F.make_dt_interval(secs=F.col("id") % 600)).alias("event_timestamp"), F.lit("p").alias("title"),
        F.lit(0).alias("namespace"), F.concat(F.lit("u"), F.col("id") % 20_000).alias("user"), F.lit(1).alias("byte_delta"),
        F.lit(False).alias("minor"))
    found = page_activity(page_panes(many), START + timedelta(minutes=10), "1 HOUR").first()
    assert found.edit_count == 60_000 and abs(found.unique_editors - 20_000) < 20_000 * 0.05


def test_exact_panes_count_every_editor(spark, events):
    many = spark.range(60_000).select(
        (F.lit(START).cast("timestamp") + F.make_dt_interval(secs=F.col("id") % 600)).alias("event_timestamp"), F.lit("p").alias("title"),
        F.lit(0).alias("namespace"), F.concat(F.lit("u"), F.col("id") % 20_000).alias("user"), F.lit(1).alias("byte_delta"),
        F.lit(False).alias("minor"))
    found = page_activity(page_panes(many, exact=True), START + timedelta(minutes=10), "1 HOUR").first()
    assert (found.edit_count, found.unique_editors, found.total_byte_delta) == (60_000, 20_000, 60_000)
    panes = page_panes(events, exact=True)
    sliding = sliding_page_metrics(events, exact=True)
    assert rows(windows_of_panes(panes, 15, 1), *sliding.columns) == rows(sliding)
    assert rows(windows_of_panes(panes, 5), *page_metrics(events).columns) == rows(page_metrics(events, exact=True))


def test_panes_of_a_stream(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "lake"))
    flow = Medallion(tables, str(tmp_path / "landing"))
    lines = [raw(f"e{i}", T0 + 20 * i, title=f"P{i % 2}") for i in range(60)] + [raw("far", T0 + 7200)]
    write_lines(tmp_path / "landing" / "year=2024" / "month=01" / "day=01" / "hour=00" / "a.jsonl", lines)
    flow.catch_up(panes=True)
    flow.close()
    panes = tables.read(c.PANES)
    assert panes.agg(F.sum("edit_count")).first()[0] == 60
    merged = windows_of_panes(panes, 5)
    columns = ["window_start", "title", "edit_count", "unique_editors", "total_byte_delta"]
    assert rows(merged, *columns) == rows(tables.read(c.GOLD_5MIN), *columns)
