"""The streaming half: bronze, silver, quarantine and gold as Structured Streaming queries."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidegauge.model import contracts as c
from tidegauge.operators import quality
from tidegauge.operators.panes import page_panes
from tidegauge.operators.parse import parse_events
from tidegauge.operators.windows import page_metrics, sliding_page_metrics
from tidegauge.sources.landing import bronze_stream
from tidegauge.sources.tables import Tables

OBSERVED = "silver_expectations"
LATE = "within_watermark"


def deduplicated(
    df: DataFrame,
    mode: str = "global",
    key: str = "event_id",
    ts: str = "event_timestamp",
    watermark: str = c.WATERMARK,
    spread: str | None = None,
) -> DataFrame:
    """First row of each ``key`` on a stream; rows behind the watermark are dropped.

    ``global`` removes copies however late they come (the state keeps every key for good);
    ``bounded`` forgets a key once the watermark has passed it, so a later copy gets through;
    ``keyed_time`` takes (key, event time) as the identity: copies that are redeliveries carry the same
    event time, so they never get through, and their state goes once the watermark has passed it. It keeps
    rows of one key with different event times, which ``global`` does not, and is the mode for large feeds.
    A NULL key counts as one key in the first two; with ``keyed_time`` it is spread by its event times.

    ``spread`` names a column that differs between copies (e.g. ``source_file``). Copies are then
    first removed per (key, spread value) with expiring state, so a key that holds a large share of
    the rows is worked off by many tasks before the final step sees it.
    """
    df = df.withWatermark(ts, watermark)
    if spread:
        df = df.dropDuplicatesWithinWatermark([key, spread])
    if mode == "keyed_time":
        return df.dropDuplicates([key, ts])
    return df.dropDuplicates([key]) if mode == "global" else df.dropDuplicatesWithinWatermark([key])


def silver_flow(
    bronze: DataFrame,
    dedupe: str = "global",
    watermark: str = c.WATERMARK,
    expectations=quality.SILVER_EXPECTATIONS,
    spread: str | None = None,
) -> DataFrame:
    """Accepted events, once each, with the expectations counted on and applied to the result."""
    passed = quality.accepted(parse_events(bronze))
    once = deduplicated(passed, dedupe, watermark=watermark, spread=spread)
    return quality.enforce(quality.with_event_date(once), expectations, observe_as=OBSERVED)


def quarantine_flow(bronze: DataFrame) -> DataFrame:
    """Everything else, with its reason; stateless, so copies are kept."""
    return quality.rejected(parse_events(bronze))


def gold_flow(silver: DataFrame, watermark: str = c.WATERMARK, exact: bool = False) -> DataFrame:
    """Tumbling page metrics. In append mode a window is written once, when the watermark passes its end."""
    return page_metrics(silver.withWatermark("event_timestamp", watermark), exact=exact)


def gold_sliding_flow(silver: DataFrame, watermark: str = c.WATERMARK) -> DataFrame:
    return sliding_page_metrics(silver.withWatermark("event_timestamp", watermark))


def panes_flow(silver: DataFrame, watermark: str = c.WATERMARK) -> DataFrame:
    """Minutes of each page, written once the watermark has passed them; longer windows are merged from the table."""
    return page_panes(silver.withWatermark("event_timestamp", watermark))


def closed(windows: DataFrame, latest, watermark: str = c.WATERMARK) -> DataFrame:
    """The windows of a batch result that a stream would have written by event time ``latest``."""
    return windows.filter(F.col("window_end") <= latest - F.expr(f"INTERVAL {watermark}"))


def start(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet folder: continuously at an interval (``every``), or, without
    one, work off what is there and stop. A restart on the same checkpoint resumes where it ended."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_batches(
    df: DataFrame, tables: Tables, table: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Append a stream to a table of the lake, one folder for each micro-batch (:meth:`Tables.write_batch`): a batch that
    is run again after a failure is stored once, and a partition gets one file of each batch and not one of each task."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", tables.checkpoint(table))
    writer = writer.foreachBatch(lambda batch, n: tables.write_batch(table, batch, n))
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


class BatchMetrics(StreamingQueryListener):
    """Stores the outcome of every micro-batch: the expectations counted on the way, and the rows dropped behind the
    watermark. Outcomes are gathered and appended together, after ``flush_seconds`` and whenever a query ends, so a
    day of short batches is some hundred files; what a driver that dies has not stored yet is lost with it. A batch that
    is repeated counts as it was last."""

    def __init__(self, tables: Tables, expectations=quality.SILVER_EXPECTATIONS, flush_seconds: float = 60):
        self.tables, self.expectations, self.flush_seconds = tables, expectations, flush_seconds
        self.flows: dict[str, str] = {}
        self.ended: dict[str, threading.Event] = {}
        self.problems: dict[str, list[str]] = {}
        self.waiting: list[tuple] = []
        self.flushed = time.monotonic()
        self.lock = threading.Lock()

    def name_for(self, flow: str) -> str:
        """A query name under which the batches of ``flow`` are recognised."""
        name = f"{flow}-{uuid.uuid4().hex}"
        self.flows[name] = flow
        return name

    def onQueryStarted(self, event) -> None:  # noqa: N802
        if event.name in self.flows:
            self.ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.name not in self.flows:
            return
        self.guarded(p.name, lambda: self.gather(self.flows[p.name], p))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if str(event.runId) in self.ended:
            self.guarded("", self.flush)
            self.ended[str(event.runId)].set()

    def guarded(self, name: str, step) -> None:
        """A listener must not raise; the run that waits for it does."""
        try:
            step()
        except Exception as e:
            self.problems.setdefault(name, []).append(f"{self.flows.get(name, 'metrics')}: {e}")

    def gather(self, flow: str, p) -> None:
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        rows, seen = [], (p.observedMetrics or {}).get(OBSERVED)
        if seen is not None:
            counts = seen.asDict()
            rows += [
                (flow, p.batchId, e.name, e.kind, counts[f"{e.name}__passed"] or 0, counts[f"{e.name}__failed"] or 0, at)
                for e in self.expectations
            ]
        if p.stateOperators:
            late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
            rows.append((flow, p.batchId, LATE, "late", max(p.numInputRows - late, 0), late, at))
        with self.lock:
            self.waiting += rows
        if time.monotonic() - self.flushed >= self.flush_seconds:
            self.flush()

    def flush(self) -> None:
        """Store what is gathered."""
        with self.lock:
            rows, self.waiting, self.flushed = self.waiting, [], time.monotonic()
        try:
            if rows:
                self.tables.append_metrics(rows)
        except Exception:
            with self.lock:
                self.waiting = rows + self.waiting
            raise

    def wait(self, query: StreamingQuery, seconds: float = 120) -> None:
        """Until everything a stopped query reported is stored. Raises what went wrong with its own reports, once."""
        if not self.ended[str(query.runId)].wait(seconds):
            raise TimeoutError("the listener did not see the end of the query")
        own = self.problems.pop(query.name, []) + self.problems.pop("", [])
        if own:
            raise RuntimeError("; ".join(own))


def late_rows(metrics: DataFrame) -> DataFrame:
    """Rows dropped behind the watermark, by flow."""
    return metrics.filter(F.col("kind") == "late").groupBy("flow").agg(F.sum("failed").alias("late"))


class Medallion:
    """The streaming tables of one lake, each an independent query with its own checkpoint and state."""

    def __init__(
        self, tables: Tables, landing: str, dedupe: str = "global", max_files: int | None = None,
        spread: str | None = None, expectations=quality.SILVER_EXPECTATIONS,
    ):
        self.tables, self.landing, self.max_files = tables, landing, max_files
        self.dedupe, self.spread, self.expectations = dedupe, spread, expectations
        self.metrics = BatchMetrics(tables, expectations)
        tables.spark.streams.addListener(self.metrics)

    def _flow(self, name: str) -> DataFrame:
        t, n = self.tables, self.max_files
        if name == c.BRONZE:
            return bronze_stream(t.spark, self.landing, n)
        if name == c.SILVER:
            return silver_flow(
                t.stream(c.BRONZE, n), self.dedupe, expectations=self.expectations, spread=self.spread
            )
        if name == c.QUARANTINE:
            return quarantine_flow(t.stream(c.BRONZE, n))
        if name == c.GOLD_5MIN:
            return gold_flow(t.stream(c.SILVER, n))
        if name == c.GOLD_15MIN:
            return gold_sliding_flow(t.stream(c.SILVER, n))
        if name == c.PANES:
            return panes_flow(t.stream(c.SILVER, n))
        raise ValueError(name)

    def start(self, name: str, every: str | None = None) -> StreamingQuery:
        t = self.tables
        return start_batches(self._flow(name), t, name, every, self.metrics.name_for(name))

    def close(self) -> None:
        """No longer store metrics of this lake's queries."""
        self.metrics.flush()
        self.tables.spark.streams.removeListener(self.metrics)

    def catch_up(self, sliding: bool = False, panes: bool = False) -> dict[str, StreamingQuery]:
        """Scheduled execution: work off everything landed so far, layer after layer, then stop."""
        done: dict[str, StreamingQuery] = {}
        golds = [c.GOLD_5MIN] + ([c.GOLD_15MIN] if sliding else []) + ([c.PANES] if panes else [])
        for layer in ([c.BRONZE], [c.SILVER, c.QUARANTINE], golds):
            running = {name: self.start(name) for name in layer}
            for q in running.values():
                q.awaitTermination()
                self.metrics.wait(q)
            done |= running
        return done

    def start_all(self, every: str = "30 seconds", sliding: bool = False, panes: bool = False) -> dict[str, StreamingQuery]:
        """Continuous execution: every layer at once. The folders must exist before they are streamed,
        so run :meth:`catch_up` once first."""
        names = [c.BRONZE, c.SILVER, c.QUARANTINE, c.GOLD_5MIN] + ([c.GOLD_15MIN] if sliding else [])
        names += [c.PANES] if panes else []
        return {name: self.start(name, every) for name in names}
