"""Windows, baselines, z-scores, detection."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from tidegauge.model import contracts as c
from tidegauge.operators import anomaly, baseline, windows
from tidegauge.plans import jobs
from tidegauge.sources.tables import Tables

NOW = datetime(2024, 2, 1, 12, 0)


def gold_row(title, start, count, ns=0, editors=1, delta=10):
    return (start, start + timedelta(minutes=5), start.date(), title, ns, count, editors, delta, 1.0, 5, 0)


def gold(spark, *items):
    return spark.createDataFrame(list(items), c.GOLD_DDL)


def base_row(title, mean, sd, day=date(2024, 1, 31), ns=0):
    return (title, ns, 20, mean, sd, 1.0, 1.0, NOW, NOW, day, NOW, 30)


def base(spark, *items):
    return spark.createDataFrame(list(items), c.BASELINE_DDL)


def test_window_edges_and_null_times(spark):
    silver = spark.createDataFrame(
        [
            (datetime(2024, 1, 1, 0, 5), "p", 0, "a", 10, True), (datetime(2024, 1, 1, 0, 9, 59), "p", 0, "a", None, False),
            (datetime(2024, 1, 1, 0, 10), "p", 0, "b", -4, None), (None, "p", 0, "c", 1, False),
        ],
        "event_timestamp timestamp, title string, namespace int, user string, byte_delta int, minor boolean")
    got = rows(
        windows.page_metrics(silver), "window_start", "edit_count", "unique_editors", "total_byte_delta", "avg_byte_delta",
        "max_byte_delta", "minor_edit_count")
    assert got == [
        (datetime(2024, 1, 1, 0, 10), 1, 1, -4, -4.0, -4, 0), (datetime(2024, 1, 1, 0, 5), 2, 1, 10, 10.0, 10, 1)]
    assert windows.page_metrics(silver).dtypes == spark.createDataFrame([], c.GOLD_DDL).dtypes
    sliding = windows.sliding_page_metrics(silver.limit(1))
    assert sliding.count() == 15


def test_baseline_needs_ten_windows(spark):
    items = [gold_row("nine", NOW - timedelta(hours=i), 2) for i in range(9)]
    items += [gold_row("ten", NOW - timedelta(hours=i), i) for i in range(10)]
    items += [gold_row("old", NOW - timedelta(days=31, hours=i), 2) for i in range(10)]
    got = baseline.rolling_baseline(gold(spark, *items), NOW).collect()
    assert [r["title"] for r in got] == ["ten"]
    r = got[0]
    assert r["mean_edit_count"] == 4.5 and round(r["stddev_edit_count"], 6) == 3.02765
    assert r["baseline_date"] == NOW.date() and r["lookback_days"] == 30 and r["data_through"] == NOW


def detect(spark, g, b, flags=None, **kw):
    return anomaly.detect_anomalies(g, b, flags, NOW, **kw)


def test_thresholds(spark):
    t = NOW - timedelta(minutes=10)
    g = gold(
        spark, gold_row("exact", t, 13), gold_row("below", t, 12), gold_row("flat", t, 50), gold_row("few", t, 2),
        gold_row("unknown", t, 50), gold_row("stale", t, 50), gold_row("rounded", t, 1005))
    b = base(
        spark, base_row("exact", 10.0, 1.0), base_row("below", 10.0, 1.0), base_row("flat", 10.0, 0.0),
        base_row("few", 0.1, 0.1), base_row("stale", 1.0, 1.0, date(2024, 1, 30)), base_row("rounded", 406.0, 200.0))
    # (1005 - 406) / 200 = 2.995, which rounds to 3.0
    assert rows(detect(spark, g, b), "title", "z_score") == [("exact", 3.0), ("rounded", 3.0)]
    preview = anomaly.surge_preview(g, b, NOW)
    assert rows(preview, "title") == [("few",)]  # unrounded, strictly above, no minimum count


def test_lookback_edge_and_no_repeats(spark):
    edge, outside = NOW - timedelta(minutes=60), NOW - timedelta(minutes=61)
    g = gold(spark, gold_row("p", edge, 9), gold_row("p", outside, 9), gold_row("p", edge, 9, ns=1))
    b = base(spark, base_row("p", 1.0, 1.0), base_row("p", 1.0, 1.0, ns=1))
    first = detect(spark, g, b)
    assert rows(first, "window_start", "namespace") == [(edge, 0), (edge, 1)]
    known = first.filter("namespace = 0")
    assert detect(spark, g, b, known).count() == 0  # the key has no namespace
    assert detect(spark, g, b, known, flag_key=("title", "namespace", "window_start")).count() == 1
    assert first.dtypes == spark.createDataFrame([], c.FLAGS_DDL).dtypes


def test_jobs_write_once_and_keep_history(spark, tmp_path):
    t = Tables(spark, str(tmp_path / "lake"))
    hist = [gold_row("p", NOW - timedelta(days=2, hours=i), 2 + i % 2) for i in range(12)]
    t.replace_partitions(c.GOLD_5MIN, gold(spark, *hist, gold_row("p", NOW - timedelta(minutes=20), 30)))
    yesterday = NOW - timedelta(days=1)
    # As of yesterday the future window is not excluded by the baseline, as it looks back only.
    assert jobs.run_baseline(t, yesterday).first()[0] == 1
    assert jobs.run_baseline(t, NOW).first()[0] == 1
    jobs.run_baseline(t, NOW)
    per_day = rows(t.read(c.BASELINE).groupBy("baseline_date").count())
    assert per_day == [(date(2024, 1, 31), 1), (date(2024, 2, 1), 1)]
    quiet = t.read(c.BASELINE).withColumn("mean_edit_count", F.lit(2.5)).withColumn("stddev_edit_count", F.lit(0.5))
    t.replace_partitions(c.BASELINE, spark.createDataFrame(quiet.collect(), quiet.schema))
    assert jobs.run_detection(t, NOW).count() == 1
    assert jobs.run_detection(t, NOW + timedelta(minutes=15)).count() == 0
    assert t.read(c.FLAGS).count() == 1
