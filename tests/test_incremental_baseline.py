"""The incremental baseline against the one over all windows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.model import contracts as c
from tidegauge.operators import baseline
from tidegauge.plans import jobs
from tidegauge.sources.tables import Tables

START = datetime(2024, 3, 1)


def gold(spark, days=12, pages=4, scale=1):
    rng = random.Random(5)
    rows = []
    for day in range(days):
        for page in range(pages):
            for _ in range(rng.randrange(0, 9)):
                at = START + timedelta(days=day, minutes=5 * rng.randrange(288))
                n = scale + rng.randrange(1, 30)
                rows.append((at, at + timedelta(minutes=5), at.date(), f"p{page}", page % 2, n, rng.randrange(1, 9),
                             rng.choice([None, n * 3]), 1.0, n, 0))
    return spark.createDataFrame(rows, c.GOLD_DDL)


def state(df):
    names = ["title", "namespace", "window_count", "data_from", "data_through", "lookback_days"]
    floats = ["mean_edit_count", "stddev_edit_count", "mean_unique_editors", "mean_total_byte_delta"]
    return {tuple(r[n] for n in names): [r[f] for f in floats] for r in df.collect()}


def same(a, b, tolerance=1e-9):
    assert a.keys() == b.keys() and a
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=tolerance, abs=tolerance)


@pytest.mark.parametrize("scale", [1, 10**6])  # a mean far above the deviations
def test_every_day_equals_the_whole(spark, tmp_path, scale):
    tables, windows = Tables(spark, str(tmp_path)), gold(spark, scale=scale)
    tables.append(c.GOLD_5MIN, windows)
    for day, hour in ((6, 0.25), (7, 3), (7, 3), (11, 23)):  # before a day has settled; again; days left out
        at = START + timedelta(days=day, hours=hour)
        jobs.run_baseline_incremental(tables, at, lookback_days=5, min_windows=3)
        found = tables.read(c.BASELINE).filter(F.col("baseline_date") == F.lit(at.date()))
        same(state(found), state(baseline.rolling_baseline(windows, at, 5, 3)))
    assert tables.read(c.BASELINE).select("baseline_date").distinct().count() == 3
    assert max(tables.days(c.MOMENTS)) == date(2024, 3, 11)


def test_a_run_reads_the_days_without_moments_only(spark, tmp_path):
    tables, windows = Tables(spark, str(tmp_path)), gold(spark)
    tables.append(c.GOLD_5MIN, windows)
    at = START + timedelta(days=10, hours=12)
    jobs.run_baseline_incremental(tables, at, lookback_days=8)
    # what a day with moments holds no longer matters
    changed = windows.filter("window_date = DATE '2024-03-06'").withColumn("edit_count", F.lit(10**6).cast("bigint"))
    tables.replace_partitions(c.GOLD_5MIN, changed)
    jobs.run_baseline_incremental(tables, at + timedelta(minutes=1), lookback_days=8)
    found = tables.read(c.BASELINE).filter(F.col("baseline_date") == F.lit(at.date()))
    same(state(found), state(baseline.rolling_baseline(windows, at + timedelta(minutes=1), 8)))
    plan = baseline.incremental_baseline(
        tables.read(c.GOLD_5MIN), tables.read(c.MOMENTS), tables.days(c.MOMENTS), at, 8
    )._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in plan.splitlines() if "FileScan" in s]
    assert len(scans) == 2 and all("window_date" in s.split("PartitionFilters: ")[1].split("]")[0] for s in scans)


def test_single_windows_and_empty_tables(spark, tmp_path):
    one = gold(spark, days=1, pages=1).limit(1)
    merged = baseline.merged_baseline(baseline.daily_moments(one), min_windows=1).first()
    assert merged["window_count"] == 1 and merged["stddev_edit_count"] is None
    tables = Tables(spark, str(tmp_path))
    tables.append(c.GOLD_5MIN, one.limit(0))
    jobs.run_baseline_incremental(tables, START, lookback_days=3)
    assert tables.read(c.BASELINE).count() == 0
