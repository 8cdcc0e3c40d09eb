"""Streaming flows: several files, duplicates, late and malformed lines, restarts."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import rows
from events import T0, raw, write_lines
from pyspark.sql import functions as F

from tidegauge.model import contracts as c
from tidegauge.operators import anomaly, quality
from tidegauge.operators.parse import parse_events
from tidegauge.operators.summaries import comments_for_queue
from tidegauge.operators.windows import page_metrics
from tidegauge.plans import alerts, checks, served
from tidegauge.sources.landing import bronze_batch, bronze_stream, expire_landed, land_lines, land_stream
from tidegauge.sources.tables import Tables, by_title, rows_to_table
from tidegauge.streaming.flows import Medallion, closed, deduplicated, late_rows, start

START = datetime(2024, 1, 1)


def folder(base, hour=0):
    return base / "year=2024" / "month=01" / "day=01" / f"hour={hour:02}"


def lake(spark, tmp_path, **options):
    tables = Tables(spark, str(tmp_path / "lake"))
    return tables, Medallion(tables, str(tmp_path / "landing"), **options)


def test_medallion_end_to_end(spark, tmp_path):
    land = tmp_path / "landing"
    write_lines(folder(land) / "a.jsonl", [
        raw("a", T0 + 10), raw("a", T0 + 10), raw("b", T0 + 20, bot=True), raw("b", T0 + 20, bot=True), "{bad",
        raw("t", T0 + 30, drop=["title"]), raw("n1", T0 + 40, drop=["meta.id"]), raw("n2", T0 + 41, drop=["meta.id"]),
        raw("no-time", drop=["timestamp"])])
    tables, flow = lake(spark, tmp_path)
    flow.catch_up(sliding=True)
    assert tables.read(c.BRONZE).count() == 9
    assert rows(tables.read(c.SILVER), "event_id") == [("a",), ("no-time",), (None,)]
    assert rows(tables.read(c.QUARANTINE), "quarantine_reason") == [("bot",), ("bot",), ("parse_failure",)]
    assert tables.read(c.GOLD_5MIN).count() == 0  # the window is still open

    stored = tables.read(c.METRICS).filter("kind <> 'late'").groupBy("expectation").agg(F.sum("passed"), F.sum("failed"))
    assert rows(stored) == [("byte_delta_plausible", 4, 0), ("title_not_null", 3, 1), ("user_not_null", 4, 0)]
    assert rows(quality.failures(tables.read(c.METRICS)), "expectation", "failed") == [("title_not_null", 1)]

    # A later file closes the first window; the copy of "a" is still known; an edge event opens its window.
    write_lines(folder(land, 1) / "b.jsonl", [
        raw("a", T0 + 3600), raw("edge", T0 + 3600), raw("far", T0 + 7200)])
    flow.catch_up(sliding=True)
    assert rows(tables.read(c.SILVER), "event_id") == [("a",), ("edge",), ("far",), ("no-time",), (None,)]
    gold = tables.read(c.GOLD_5MIN)
    assert rows(gold, "window_start", "edit_count") == [(START, 2), (START + timedelta(hours=1), 1)]
    assert tables.read(c.GOLD_15MIN).count() == 30

    # Nothing new: nothing happens. Older than the watermark: dropped.
    flow.catch_up()
    assert tables.read(c.SILVER).count() == 5
    write_lines(folder(land, 2) / "c.jsonl", [raw("late", T0 + 60)])
    flow.catch_up()
    late = dict(tuple(r) for r in late_rows(tables.read(c.METRICS)).collect())
    assert tables.read(c.SILVER).count() == 5 and late[c.SILVER] == 1

    t = tables
    got = quality.conservation(t.read(c.BRONZE), t.read(c.SILVER), t.read(c.QUARANTINE)).first().asDict()
    assert got == {"bronze": 13, "silver": 5, "quarantine": 3, "duplicates": 3, "dropped": 1, "unexplained": 1}
    agree = checks.reconcile(t.read(c.SILVER), gold, START + timedelta(hours=2), hours=None).first()
    assert agree["windows_compared"] == 2 and agree["total_edit_count_diff"] == 0
    t.register_views()
    assert spark.sql(f"SELECT count(*) FROM {c.SILVER} WHERE event_id IS NULL").first()[0] == 1
    assert by_title(t.read(c.SILVER), "Page").count() == 5


def test_restart_equals_one_run(spark, tmp_path):
    """Two stops on the way, files paced one per micro-batch; against one batch over everything."""
    land = tmp_path / "landing"
    tables, flow = lake(spark, tmp_path, max_files=1)
    lines = []
    for i in range(4):
        part = [raw(f"e{i}-{j}", T0 + i * 900 + j * 7, title=f"P{j % 3}") for j in range(40)]
        part += part[:5]
        write_lines(folder(land, i) / f"f{i}.jsonl", part)
        lines += part
        if i in (1, 3):
            flow.catch_up()
    silver = tables.read(c.SILVER)
    assert silver.count() == 160 and checks.repeated_id_count(silver).first()[0] == 0
    whole = page_metrics(quality.clean(parse_events(bronze_batch(spark, str(land)))))
    latest = F.lit(datetime.fromtimestamp(T0 + 2700 + 39 * 7)).cast("timestamp")
    assert rows(tables.read(c.GOLD_5MIN)) == rows(closed(whole, latest))


def event_files(spark, tmp_path, *files):
    schema = "event_id string, event_timestamp timestamp, source_file string"
    for i, part in enumerate(files):
        data = [(k, START + timedelta(minutes=m), f"f{i}") for k, m in part]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return schema


def test_metrics_of_more_batches_than_spark_remembers(spark, tmp_path):
    """Eight micro-batches with one dropped row each, while Spark keeps the progress of three."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        land = tmp_path / "landing"
        for i in range(8):
            write_lines(folder(land, i) / f"f{i}.jsonl", [raw(f"e{i}", T0 + i), raw(f"t{i}", T0 + i, drop=["title"])])
        tables, flow = lake(spark, tmp_path, max_files=1)
        flow.catch_up()
        flow.catch_up()
        flow.close()
        dropped = tables.read(c.METRICS).filter("flow = 'silver_recentchange_enwiki' AND expectation = 'title_not_null'")
        assert dropped.agg(F.sum("passed"), F.sum("failed")).first() == (8, 8)
        assert dropped.filter("failed > 0").count() == 8
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_poison_lines_through_a_stream(spark, tmp_path):
    land = tmp_path / "landing"
    wide = raw("wide", length={"old": -2147483648, "new": 2147483647})
    write_lines(folder(land) / "a.jsonl", ["", "{bad", "null", "[]", '{"meta": 3}', raw("ok", T0), raw("huge", 9 * 10**18), wide])
    tables, flow = lake(spark, tmp_path)
    flow.catch_up()
    flow.close()
    held = [tables.read(t).count() for t in (c.BRONZE, c.SILVER, c.QUARANTINE)]
    assert held[0] == held[1] + held[2] and held[1] >= 2


@pytest.mark.parametrize("mode, spread, kept", [
    ("global", None, 4), ("bounded", None, 5), ("global", "source_file", 4), ("keyed_time", None, 5)])
def test_dedupe_modes(spark, tmp_path, mode, spread, kept):
    """The last copy of "a" comes long after the watermark has passed the first."""
    base = tmp_path

    def step(part):
        schema = event_files(spark, base, part)
        src = spark.readStream.schema(schema).parquet(str(base / "in"))
        q = start(deduplicated(src, mode, spread=spread), str(base / "out"), str(base / "cp"))
        q.awaitTermination()

    step([("a", 0), ("a", 0), ("b", 1)])
    step([("c", 60)])
    step([("d", 120)])
    step([("a", 121)])
    assert spark.read.parquet(str(base / "out")).count() == kept


def test_null_keys_and_null_times(spark, tmp_path):
    spark.createDataFrame(
        [(None, START), (None, START), ("x", None), ("x", None)], "event_id string, event_timestamp timestamp"
    ).coalesce(1).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema("event_id string, event_timestamp timestamp").parquet(str(tmp_path / "in"))
    start(deduplicated(src), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "event_id") == [("x",), (None,)]


def test_landing_layout_and_retention(spark, tmp_path):
    path = str(tmp_path / "landing")
    lines = [(raw(f"e{h}"), START + timedelta(hours=h)) for h in range(30)]
    df = spark.createDataFrame(lines, "raw_json string, at timestamp")
    land_lines(df, path, F.col("at"), max_lines=1)
    assert (tmp_path / "landing" / "year=2024" / "month=01" / "day=02" / "hour=05").is_dir()
    back = bronze_batch(spark, path)
    assert back.count() == 30 and back.filter("source_file like '%hour=05%'").count() == 2
    assert "year" not in back.columns
    now = START + timedelta(hours=29)
    assert len(expire_landed(spark, path, now, 1, dry_run=True)) == 5
    assert len(expire_landed(spark, path, now, 1)) == 5
    assert bronze_batch(spark, path).count() == 25
    assert expire_landed(spark, path, now, 1) == []


def test_landing_stream(spark, tmp_path):
    spark.createDataFrame([(raw("a"),), (raw("b"),)], "raw_json string").write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema("raw_json string").parquet(str(tmp_path / "in"))
    q = land_stream(src, str(tmp_path / "landing"), str(tmp_path / "cp"), F.lit(START).cast("timestamp"), every_seconds=1)
    q.processAllAvailable()
    q.stop()
    assert rows(bronze_batch(spark, str(tmp_path / "landing")), "event_id") == [("a",), ("b",)]


def test_continuous_run(spark, tmp_path):
    land = tmp_path / "landing"
    write_lines(folder(land) / "a.jsonl", [raw("a", T0)])
    tables, flow = lake(spark, tmp_path)
    flow.catch_up()
    running = flow.start_all(every="0 seconds")
    try:
        write_lines(folder(land, 1) / "b.jsonl", [raw("b", T0 + 5000), raw("z", bot=True)])
        for name in (c.BRONZE, c.SILVER, c.QUARANTINE):
            running[name].processAllAvailable()
    finally:
        for q in running.values():
            q.stop()
    assert rows(tables.read(c.SILVER), "event_id") == [("a",), ("b",)]
    assert tables.read(c.QUARANTINE).count() == 1


def test_rewrites_keep_the_last_committed_state(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "lake"))
    one = spark.createDataFrame([], c.SUMMARIES_DDL)
    tables.append(c.SUMMARIES, one)
    tables.rewrite(c.SUMMARIES, one)
    (tmp_path / "lake" / c.SUMMARIES / "v=3").mkdir()  # a writer that died: no _SUCCESS
    assert tables.path(c.SUMMARIES).endswith("v=2")
    assert tables.read(c.SUMMARIES).count() == 0
    assert rows_to_table(spark, [], c.SUMMARIES_DDL).columns == one.columns
    tables.rewrite(c.SUMMARIES, one)
    assert tables.path(c.SUMMARIES).endswith("v=4")
    assert tables.drop_old(c.SUMMARIES, keep=1) == [1, 2, 3] and tables.read(c.SUMMARIES).count() == 0


def test_source_files_are_removed_once_captured(spark, tmp_path):
    land = tmp_path / "landing"
    for i in range(3):
        write_lines(folder(land, i) / f"f{i}.jsonl", [raw(f"e{i}")])
        df = bronze_stream(spark, str(land), clean="delete")
        start(df, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert len(list(land.rglob("*.jsonl"))) < 3


def test_stored_tables_are_pruned_by_partition(spark, tmp_path):
    tables, _ = lake(spark, tmp_path)
    tables.append(c.BRONZE, spark.createDataFrame([("{}", START, "f", None, START.date())], c.BRONZE_DDL))
    tables.append(c.GOLD_5MIN, spark.createDataFrame(
        [(START, START, START.date(), "p", 0, 9, 1, 1, 1.0, 1, 0)], c.GOLD_DDL))
    tables.replace_partitions(c.BASELINE, spark.createDataFrame(
        [("p", 0, 10, 1.0, 1.0, 1.0, 1.0, START, START, (START - timedelta(days=1)).date(), START, 30)], c.BASELINE_DDL))

    def scans(df):
        text = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in text.splitlines() if "FileScan" in line]

    assert served.staleness(tables.read(c.BRONZE), START).first()["minutes_stale"] == 0
    assert checks.latest_windows(tables.read(c.GOLD_5MIN)).first()["total_edits"] == 9
    for df in (served.staleness(tables.read(c.BRONZE), START), checks.latest_windows(tables.read(c.GOLD_5MIN))):
        assert any("PartitionFilters: [" in line and "Subquery" in line for line in scans(df))
    for df, part in [
        (served.ingest_per_hour(tables.read(c.BRONZE), START), "ingest_date"),
        (served.top_pages(tables.read(c.GOLD_5MIN), START), "window_date"),
        (alerts.silver_gap(tables.read(c.BRONZE), START), "ingest_date"),
    ]:
        assert all(f"PartitionFilters: [isnotnull({part}" in line and f"({part}#" in line for line in scans(df))
    silver = spark.createDataFrame([], c.SILVER_DDL)
    tables.append(c.SILVER, silver.unionByName(spark.createDataFrame([(START,)], "event_timestamp timestamp").select(
        *[F.col("event_timestamp").cast(f.dataType).alias(f.name) if f.name in ("event_timestamp", "event_date", "ingest_date")
          else F.lit(None).cast(f.dataType).alias(f.name) for f in silver.schema])))
    flag = spark.createDataFrame([], c.FLAGS_DDL)
    for df in (
        served.largest_edits(tables.read(c.SILVER), START), checks.busiest_pages(tables.read(c.SILVER), START),
        checks.reconcile(tables.read(c.SILVER), tables.read(c.GOLD_5MIN), START), comments_for_queue(flag, tables.read(c.SILVER)),
    ):
        assert any("PartitionFilters: [isnotnull(event_date" in line for line in scans(df))
    found = anomaly.detect_anomalies(tables.read(c.GOLD_5MIN), tables.read(c.BASELINE), None, START)
    gold, base = scans(found)
    assert "window_date" in gold and "PushedFilters: [IsNotNull(" in gold and "GreaterThanOrEqual(window_start" in gold
    assert "(baseline_date#" in base and "= 2023-12-31" in base
    assert found.count() == 1
