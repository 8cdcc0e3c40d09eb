"""Queue, context, generation, marking, alerts."""

from __future__ import annotations

import hashlib
from datetime import datetime, timedelta

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidegauge.model import contracts as c
from tidegauge.operators import summaries as s
from tidegauge.plans import alerts, jobs
from tidegauge.sources.tables import Tables

W = datetime(2024, 1, 1, 10, 0)
NOW = datetime(2024, 1, 1, 11, 0)


def flag(title, z=4.0, start=W, done=False, ns=0):
    return (title, ns, start, start + timedelta(minutes=5), 9, 3, 120, 1.5, 0.5, z, NOW, done)


def flags(spark, *items):
    return spark.createDataFrame(list(items), c.FLAGS_DDL)


def silver(spark, *items):
    return spark.createDataFrame(
        list(items), "event_id string, title string, event_timestamp timestamp, comment string, byte_delta int")


def test_one_row_per_page_and_twenty_pages(spark):
    df = flags(spark, *[flag(f"p{i:02}", 3.0 + i) for i in range(25)], flag("p24", 9.0), flag("done", 99.0, done=True))
    queue = s.pending_queue(df)
    assert [r["title"] for r in queue.collect()] == [f"p{i:02}" for i in range(24, 4, -1)]
    tied = flags(spark, flag("p", 5.0), flag("p", 5.0, W + timedelta(minutes=5)), flag("p", 3.0))
    assert rows(s.pending_queue(tied), "window_start") == [(W + timedelta(minutes=5),)]


def test_cooldown(spark):
    df = flags(spark, flag("hot"), flag("cold"))
    said = spark.createDataFrame(
        [("hot", W, 4.0, 9, "x", 0, "m", NOW - timedelta(minutes=5), "i")], c.SUMMARIES_DDL)
    assert rows(s.pending_queue(df, said, NOW, 10), "title") == [("cold",)]
    assert rows(s.pending_queue(df, said, NOW, 4), "title") == [("cold",), ("hot",)]
    assert rows(s.pending_queue(df, said, NOW, 0), "title") == [("cold",), ("hot",)]


@pytest.mark.parametrize("bounded", [True, False])
def test_context(spark, bounded):
    at = lambda sec: W + timedelta(seconds=sec)
    df = flags(spark, flag("busy"), flag("mute"), flag("busy", start=W + timedelta(minutes=5)))
    said = silver(
        spark, ("3", "busy", at(9), "third", -5), ("1", "busy", at(0), "first", 12), ("2", "busy", at(4), "second", None),
        ("4", "busy", at(5), "", 1), ("5", "busy", at(6), None, 1), ("6", "busy", at(300), "next window", 0),
        ("7", "mute", at(-1), "early", 1), ("8", "other", at(1), "x", 1))
    found = (s.comments_for_queue if bounded else s.comments_in_windows)(df, said)
    got = dict(((r[0], r[1]), r[2]) for r in rows(s.with_context(df, s.comment_context(found)), "title", "window_start", "context"))
    assert got == {
        ("busy", W): "- (+12 bytes) first\n- (n/a bytes) second\n- (-5 bytes) third",
        ("busy", W + timedelta(minutes=5)): "- (+0 bytes) next window",
        ("mute", W): s.NO_COMMENTS,
    }


def test_event_date_prunes_nothing_that_counts(spark):
    said = silver(spark, ("1", "busy", W, "kept", 1), ("2", "busy", W - timedelta(days=1), "before", 1))
    said = said.withColumn("event_date", F.col("event_timestamp").cast("date"))
    df = flags(spark, flag("busy"))
    assert rows(s.comments_for_queue(df, said), "comment") == [("kept",)]


def test_context_keeps_the_first_25(spark):
    said = silver(spark, *[(f"{i:02}", "p", W + timedelta(seconds=i), f"c{i}", i) for i in range(30)])
    df = flags(spark, flag("p"))
    text = s.comment_context(s.comments_in_windows(df, said)).first()["context"].split("\n")
    assert text == [f"- (+{i} bytes) c{i}" for i in range(25)]


def test_interval_join_spans_buckets(spark):
    """A bucket width that does not divide the window still finds every comment once."""
    df = flags(spark, flag("p"))
    said = silver(spark, *[(str(i), "p", W + timedelta(seconds=i), "c", 0) for i in range(-30, 330, 10)])
    for width in (7, 60, 300, 4000):
        assert s.comments_in_windows(df, said, width).count() == 30


def asked(spark, *titles):
    return s.with_context(flags(spark, *[flag(t) for t in titles]), s.comment_context(
        s.comments_in_windows(flags(spark, *[flag(t) for t in titles]), silver(
            spark, ("1", titles[0], W, "reverted vandalism", 1)))))


def test_default_summary_and_id(spark):
    df = s.summarize(asked(spark, "a", "b"), as_of=NOW)
    got = {r["title"]: r for r in df.collect()}
    assert "vandalism and reverts" in got["a"]["summary"] and "unclear" in got["b"]["summary"]
    assert got["a"]["id"] == hashlib.md5(b"a|2024-01-01 10:00:00").hexdigest()
    assert df.dtypes == spark.createDataFrame([], c.SUMMARIES_DDL).dtypes


def make_fickle():
    def fickle(batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["title"] == "raises").any():
            raise RuntimeError("no answer")
        text = batch["title"].mask(batch["title"] == "empty", "  ")
        return pd.DataFrame({"summary": text, "searches_used": 2})

    return fickle  # a local function is shipped by value


fickle = make_fickle()


def test_failed_and_empty_rows_are_left_out(spark):
    got = s.summarize(asked(spark, "fine", "raises", "empty", "good").coalesce(1), fickle, NOW, "m").collect()
    assert sorted(r["title"] for r in got) == ["fine", "good"]
    assert {r["searches_used"] for r in got} == {2} and {r["model_used"] for r in got} == {"m"}


def test_request_mentions_everything(spark):
    text = asked(spark, "a").select(s.request_text()).first()[0]
    for part in ("a", "9", "1.5", "4.0", "3", "120", "- (+1 bytes) reverted vandalism"):
        assert part in text


def test_marking_covers_all_windows_of_a_page(spark):
    df = flags(spark, flag("p"), flag("p", start=W + timedelta(minutes=5)), flag("q"), flag("r", done=True))
    got = s.mark_summarized(df, df.filter("title = 'p'"))
    assert rows(got, "title", "summarized") == [("p", True), ("p", True), ("q", False), ("r", True)]
    assert got.columns == df.columns


def test_summary_job_marks_only_what_it_wrote(spark, tmp_path):
    t = Tables(spark, str(tmp_path / "lake"))
    t.append(c.FLAGS, flags(spark, flag("raises"), flag("fine"), flag("fine", 3.5, W + timedelta(minutes=5))))
    written = jobs.run_summaries(t, NOW, fickle, "m", tasks=2)
    assert rows(written, "title") == [("fine",)]
    assert rows(jobs.flag_state(t), "title", "summarized") == [("fine", True), ("fine", True), ("raises", False)]
    t.append(c.FLAGS, flags(spark, flag("later")).withColumn("detected_at", F.lit(NOW + timedelta(minutes=14))))
    assert jobs.run_summaries(t, NOW + timedelta(minutes=15)).count() == 2
    assert jobs.flag_state(t).filter("not summarized").count() == 0 and t.read(c.FLAGS).count() == 4
    before = sorted(p.name for p in (tmp_path / "lake").rglob("*.parquet"))
    assert jobs.run_summaries(t, NOW + timedelta(minutes=30)).count() == 0
    assert sorted(p.name for p in (tmp_path / "lake").rglob("*.parquet")) == before  # nothing pending: nothing written
    assert t.read(c.SUMMARIES).count() == 3
    jobs.run_index_sync(t)
    jobs.run_index_sync(t)
    assert t.read(c.INDEX).count() == 3
    jobs.backfill_ids(t)
    assert t.read(c.SUMMARIES).filter("id is null").count() == 0


def test_id_backfill(spark):
    df = spark.createDataFrame([("a", W, None), ("b", W, "kept")], "title string, window_start timestamp, id string")
    assert [r[1] for r in rows(s.with_summary_id(df), "title", "id")] == [
        hashlib.md5(b"a|2024-01-01 10:00:00").hexdigest(), "kept"]
    assert "id" in s.with_summary_id(df.drop("id")).columns


def test_alerts(spark):
    def state(values, operator):
        df = spark.createDataFrame([(v,) for v in values], "n bigint")
        return alerts.evaluate(df, "x", operator, 0).first()["state"]

    assert state([0], "EQUAL") == "TRIGGERED"
    assert state([3], "EQUAL") == "OK"
    assert state([1], "GREATER_THAN") == "TRIGGERED"
    assert state([0], "GREATER_THAN") == "OK"
    assert state([], "GREATER_THAN") == "ERROR"
    fresh = flags(spark, flag("p"), flag("q", done=True))
    assert alerts.new_anomalies(fresh, NOW).first()[0] == 1
    assert alerts.new_anomalies(fresh, NOW + timedelta(hours=1)).first()[0] == 0
