"""The scheduled jobs: each resolves ``as_of`` once, runs one plan, writes, and reports from storage."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.model import contracts as c
from tidegauge.operators import anomaly, baseline, summaries, vector_index
from tidegauge.session import scratch_path
from tidegauge.sources.tables import Tables, written


def _clock(as_of: datetime | None) -> datetime:
    return as_of or datetime.now(timezone.utc)


def run_baseline(tables: Tables, as_of: datetime | None = None, **options) -> DataFrame:
    """Daily: replace today's partition of the baseline table; the history stays."""
    at = _clock(as_of)
    tables.replace_partitions(c.BASELINE, baseline.rolling_baseline(tables.read(c.GOLD_5MIN), at, **options))
    return baseline.baseline_written(tables.read(c.BASELINE), at)


def run_baseline_incremental(
    tables: Tables, as_of: datetime | None = None, lookback_days: int = c.LOOKBACK_DAYS, settle_minutes: int = c.SETTLE_MINUTES,
    **options,
) -> DataFrame:
    """Daily: the same partition of the baseline table as :func:`run_baseline`, from one more day of windows.

    The moments of each settled day (over for ``settle_minutes``, so no stream adds windows to it) are stored once; a run
    that was left out is made up for, and a run that is repeated replaces its own partitions."""
    at = _clock(as_of)
    gold, low = tables.read(c.GOLD_5MIN), (at - timedelta(days=lookback_days)).date()
    settled, have = (at - timedelta(minutes=settle_minutes)).date(), set(tables.days(c.MOMENTS))
    missing = [d for n in range(1, (settled - low).days) if (d := low + timedelta(days=n)) not in have]
    if missing:
        tables.replace_partitions(
            c.MOMENTS, baseline.daily_moments(gold.filter(F.col("window_date").isin(missing))).select(*tables.read(c.MOMENTS).columns)
        )
    found = baseline.incremental_baseline(
        gold, tables.read(c.MOMENTS), [d for d in tables.days(c.MOMENTS) if d < settled], at, lookback_days, **options
    )
    tables.replace_partitions(c.BASELINE, found)
    return baseline.baseline_written(tables.read(c.BASELINE), at)


def run_detection(tables: Tables, as_of: datetime | None = None, **options) -> DataFrame:
    """Every quarter hour: append the windows newly above their baseline."""
    at = _clock(as_of)
    known = tables.read(c.FLAGS) if tables.exists(c.FLAGS) else None
    found = anomaly.detect_anomalies(tables.read(c.GOLD_5MIN), tables.read(c.BASELINE), known, at, **options)
    tables.append(c.FLAGS, found)
    return anomaly.flags_written(tables.read(c.FLAGS), at)


def run_summaries(
    tables: Tables,
    as_of: datetime | None = None,
    generator: summaries.Generator | None = None,
    model: str | None = None,
    cooldown_minutes: int = c.COOLDOWN_MINUTES,
    k: int = c.MAX_PAGES_PER_RUN,
    max_comments: int = c.MAX_COMMENTS,
    tasks: int | None = None,
) -> DataFrame:
    """After detection: summarise the strongest pending pages. What is pending follows from the stored summaries
    (:func:`flag_state`), so flags are never rewritten, a failure leaves pages pending, and a run with nothing
    pending writes nothing. The queue is stored first, so it is worked out once.
    """
    at = _clock(as_of)
    known = tables.read(c.SUMMARIES)
    pending = summaries.pending_queue(flag_state(tables), known, at, cooldown_minutes, k)
    path = scratch_path(tables.spark, "queue")
    pending.write.parquet(path)
    queue = tables.spark.read.schema(pending.schema).parquet(path)
    if not queue.isEmpty():
        said = summaries.comments_for_queue(queue, tables.read(c.SILVER))
        asked = summaries.with_context(queue, summaries.comment_context(said, max_comments))
        tables.append(c.SUMMARIES, summaries.summarize(asked, generator, at, model, tasks))
    written = tables.read(c.SUMMARIES).filter(F.col("generated_at") == F.lit(at))
    return written.orderBy(F.desc("z_score"), "title")


def flag_state(tables: Tables) -> DataFrame:
    """All flags with their present state; for dashboards and alerts too."""
    return summaries.with_state(tables.read(c.FLAGS), tables.read(c.SUMMARIES))


def backfill_ids(tables: Tables) -> None:
    """Give older summaries the key the index needs."""
    tables.rewrite(c.SUMMARIES, summaries.with_summary_id(tables.read(c.SUMMARIES)))


def run_index_sync(tables: Tables) -> None:
    """Embed and append the summaries that are new or rewritten, and add their words to the frequency table. The new rows
    are worked out once; words of rows that a lost run has counted and not appended are counted again, which moves
    weights a little and no result but scores."""
    known = tables.read(c.INDEX) if tables.exists(c.INDEX) else None
    fresh = written(vector_index.index_additions(tables.read(c.SUMMARIES), known), "index-additions")
    if known is not None and fresh.isEmpty():
        return
    tables.append(c.FREQUENCIES, vector_index.slot_frequencies(fresh).coalesce(1))
    tables.append(c.INDEX, fresh)


def index(tables: Tables) -> DataFrame:
    """The indexed summaries as they are now."""
    return vector_index.current_index(tables.read(c.INDEX))


def index_weights(tables: Tables) -> list[float]:
    """How much each slot of the indexed vectors tells, by all texts indexed so far."""
    return vector_index.word_weights(tables.read(c.FREQUENCIES))
