"""Tables written by micro-batches: files, failures, days put together, metrics."""

from __future__ import annotations

from datetime import date, timedelta
from types import SimpleNamespace

import pytest
from conftest import rows
from events import T0, raw, write_lines
from pyspark.sql import functions as F

from tidegauge.model import contracts as c
from tidegauge.sources.tables import Tables
from tidegauge.streaming.flows import BatchMetrics, Medallion

DAY = 86_400


def land(base, n, *lines):
    write_lines(base / "landing" / "year=2024" / "month=01" / "day=01" / f"hour={n:02}" / f"f{n}.jsonl", list(lines))


def lake(spark, base):
    tables = Tables(spark, str(base / "lake"))
    return tables, Medallion(tables, str(base / "landing"))


def test_a_batch_gives_one_file_per_partition(spark, tmp_path):
    land(tmp_path, 0, *[raw(f"e{i}", T0 + i % 3 * DAY + i * 11, title=f"P{i % 5}") for i in range(300)])
    tables, flow = lake(spark, tmp_path)
    flow.catch_up()
    land(tmp_path, 1, *[raw(f"g{i}", T0 + 2 * DAY + 40_000 + i) for i in range(50)])
    flow.catch_up()
    flow.close()
    batches = lambda t: sorted(p.parent.as_posix() for p in (tmp_path / "lake" / f"{t}__stream").rglob("*.parquet"))
    for table in (c.BRONZE, c.SILVER, c.GOLD_5MIN):
        assert batches(table) and len(set(batches(table))) == len(batches(table))
    assert len([p for p in batches(c.SILVER) if "batch=0" in p]) == 3  # three days of events, one of ingest
    assert tables.read(c.SILVER).count() == 350 and tables.read(c.SILVER).select("event_id").distinct().count() == 350


def test_a_batch_cut_short_or_repeated_is_stored_once(spark, tmp_path, monkeypatch):
    land(tmp_path, 0, *[raw(f"e{i}", T0 + i) for i in range(20)])
    tables, flow = lake(spark, tmp_path)
    write = Tables.write_batch

    def half(self, name, df, batch_id):
        """Dies after some files of the batch are there, before it is committed."""
        df.limit(5).write.mode("overwrite").partitionBy("ingest_date").parquet(f"{self.stream_path(name)}/batch={batch_id}")
        (tmp_path / "lake" / f"{name}__stream" / f"batch={batch_id}" / "_SUCCESS").unlink()
        raise RuntimeError("lost")

    monkeypatch.setattr(Tables, "write_batch", half)
    with pytest.raises(Exception, match="lost"):
        flow.start(c.BRONZE).awaitTermination()
    monkeypatch.setattr(Tables, "write_batch", write)
    flow.catch_up()
    assert tables.read(c.BRONZE).count() == 20
    # the last commit of the checkpoint is lost, the data is not: the batch runs again and changes nothing
    commits = tmp_path / "lake" / "_checkpoints" / c.BRONZE / "commits"
    last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (commits / f".{last.name}.crc").unlink(missing_ok=True)
    flow.catch_up()
    flow.close()
    assert tables.read(c.BRONZE).count() == 20 and tables.read(c.SILVER).count() == 20


def test_days_are_put_together(spark, tmp_path):
    tables, flow = lake(spark, tmp_path)
    for n in range(3):
        land(tmp_path, n, *[raw(f"e{n}-{i}", T0 + n * DAY + i * 60, title=f"P{i % 2}") for i in range(30)])
        flow.catch_up()
    first = date(2024, 1, 1)
    before = rows(tables.read(c.GOLD_5MIN))
    assert len({r[2] for r in before}) > 1
    assert tables.closed_through(c.GOLD_5MIN) is None
    assert tables.close_days(c.GOLD_5MIN, first) == first == tables.closed_through(c.GOLD_5MIN)
    assert rows(tables.read(c.GOLD_5MIN)) == before
    stream = tmp_path / "lake" / f"{c.GOLD_5MIN}__stream"
    assert list(stream.glob("batch=*/window_date=2024-01-01"))  # still there for whoever is reading it
    assert tables.close_days(c.GOLD_5MIN, first) == first
    assert not list(stream.glob("batch=*/window_date=2024-01-01"))
    assert rows(tables.read(c.GOLD_5MIN)) == before
    closed = tmp_path / "lake" / f"{c.GOLD_5MIN}__closed"
    assert len(list(closed.rglob("*.parquet"))) == 1
    # a run that died after writing and before saying so is done again
    tables.close_days(c.GOLD_5MIN, first + timedelta(days=1))
    (closed / "_through" / "2024-01-02").unlink()
    assert rows(tables.read(c.GOLD_5MIN)) == before and tables.closed_through(c.GOLD_5MIN) == first
    tables.close_days(c.GOLD_5MIN, first + timedelta(days=1))
    assert rows(tables.read(c.GOLD_5MIN)) == before
    # the streams go on
    land(tmp_path, 5, *[raw(f"z{i}", T0 + 3 * DAY + i * 60) for i in range(30)], raw("far", T0 + 4 * DAY))
    flow.catch_up()
    flow.close()
    assert len(rows(tables.read(c.GOLD_5MIN))) > len(before)
    assert tables.read(c.SILVER).select("event_id").distinct().count() == tables.read(c.SILVER).count() == 121
    assert Tables(spark, str(tmp_path / "none")).close_days(c.GOLD_5MIN, first) is None


def progress(name, batch, at, passed, failed):
    return SimpleNamespace(progress=SimpleNamespace(
        name=name, batchId=batch, timestamp=at, numInputRows=passed + failed, observedMetrics=None,
        stateOperators=[SimpleNamespace(numRowsDroppedByWatermark=failed)]))


def test_metrics_are_stored_together_and_the_last_report_counts(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    metrics = BatchMetrics(tables, flush_seconds=1000)
    name = metrics.name_for("flow")
    for batch in range(40):
        metrics.onQueryProgress(progress(name, batch, f"2024-01-0{1 + batch // 20}T10:00:00.000Z", 10, 1))
    metrics.flush()
    metrics.onQueryProgress(progress(name, 39, "2024-01-02T11:00:00.000Z", 7, 4))  # the batch again
    metrics.flush()
    folder = tmp_path / c.METRICS
    assert len(list(folder.rglob("*.parquet"))) == 3
    total = lambda: tables.read(c.METRICS).agg(F.count("*"), F.sum("passed"), F.sum("failed")).first()
    assert tuple(total()) == (40, 39 * 10 + 7, 39 + 4)
    tables.compact_metrics(date(2024, 1, 3))
    assert len(list(folder.rglob("*.parquet"))) == 2 and tuple(total()) == (40, 397, 43)
    assert tables.read(c.METRICS).columns == ["flow", "batch_id", "expectation", "kind", "passed", "failed", "at"]


def test_problems_of_one_flow_are_told_once_and_to_it_alone(spark, tmp_path):
    metrics = BatchMetrics(Tables(spark, str(tmp_path)))
    bad, good = metrics.name_for("bad"), metrics.name_for("good")
    metrics.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(name=bad, batchId=0, timestamp="no time")))
    query = lambda name: SimpleNamespace(runId=name, name=name)
    for name in (bad, good):
        metrics.onQueryStarted(SimpleNamespace(name=name, runId=name))
        metrics.onQueryTerminated(SimpleNamespace(runId=name))
    metrics.wait(query(good))
    with pytest.raises(RuntimeError, match="bad"):
        metrics.wait(query(bad))
    metrics.wait(query(bad))


