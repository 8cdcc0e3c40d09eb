"""From pending flags to stored summaries: queue, edit context, request text, summary rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.clock import AsOf, from_day, now, since
from tidegauge.functions.scalars import bucket_index, signed_bytes, summary_id
from tidegauge.model.contracts import COOLDOWN_MINUTES, MAX_COMMENTS, MAX_PAGES_PER_RUN

FLAG = ("title", "namespace", "window_start")

# Fixed value: the context of a page whose editors left no comments.
NO_COMMENTS = "(no edit summaries were provided for these edits)"

# Activity classes and the comment words that mark them, tried in this order.
ACTIVITY_WORDS = {
    "vandalism and reverts": r"(?i)\b(vandal\w*|revert\w*|rvv?|undid|rollback)\b",
    "an edit war or content dispute": r"(?i)\b(dispute\w*|npov|consensus|edit war\w*|unsourced)\b",
    "routine maintenance": r"(?i)\b(typo\w*|cleanup|format\w*|categor\w*|link\w*|template\w*)\b",
}
DEFAULT_ACTIVITY = "a real-world event or breaking news"
#: Without comments nothing is known of the cause.
UNCLEAR_ACTIVITY = "unclear, as no comments were left"
LOCAL_MODEL = "keyword-rules"

SUMMARY_COLUMNS = (
    "title", "window_start", "z_score", "edit_count", "summary", "searches_used", "model_used",
    "generated_at", "id",
)


def strongest_window(flags: DataFrame) -> DataFrame:
    """One row per title: its highest z-score, the latest such window on a tie."""
    order = Window.partitionBy("title").orderBy(F.desc("z_score"), F.desc("window_start"), "namespace")
    return flags.withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place")


def off_cooldown(pending: DataFrame, summaries: DataFrame | None, as_of: AsOf, minutes: int) -> DataFrame:
    """Without the titles summarised in the last ``minutes``; zero switches the rule off."""
    if not minutes or summaries is None:
        return pending
    recent = since(summaries, "generated_at", as_of, f"{minutes} MINUTES").select("title").distinct()
    return pending.join(recent, "title", "left_anti")


def pending_queue(
    flags: DataFrame,
    summaries: DataFrame | None = None,
    as_of: AsOf = None,
    cooldown_minutes: int = COOLDOWN_MINUTES,
    k: int = MAX_PAGES_PER_RUN,
) -> DataFrame:
    """The work of one run: at most ``k`` pages, strongest first. ``k`` bounds everything downstream."""
    pending = off_cooldown(flags.filter(~F.col("summarized")), summaries, as_of, cooldown_minutes)
    return strongest_window(pending).orderBy(F.desc("z_score"), "title").limit(k)


def _remarks(silver: DataFrame) -> DataFrame:
    return silver.filter(F.length("comment") > 0).select(
        "title", "event_id", "event_timestamp", "comment", "byte_delta"
    )


# A comment (s) on a flagged page (f) inside the flagged window, and the columns of the match.
INSIDE = "f.title = s.title AND s.event_timestamp >= f.window_start AND s.event_timestamp < f.window_end"
MATCHED = [f"f.{c}" for c in FLAG] + ["s.event_id", "s.event_timestamp", "s.comment", "s.byte_delta"]


def comments_in_windows(flags: DataFrame, silver: DataFrame, bucket_seconds: int = 300) -> DataFrame:
    """Every non-empty comment made on a flagged page inside its flagged window; any number of flags.

    The interval condition becomes an equality on (title, time bucket): a flag is repeated for the
    buckets its window touches, a comment has exactly one. A title with a large share of all edits
    is thereby spread over as many hash keys as it has buckets.
    """
    first = bucket_index(F.col("window_start"), bucket_seconds)
    last = bucket_index(F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND"), bucket_seconds)
    spans = flags.select(*FLAG, "window_end", F.explode(F.sequence(first, last)).alias("bucket"))
    said = _remarks(silver).withColumn("bucket", bucket_index(F.col("event_timestamp"), bucket_seconds))
    met = F.expr(f"f.bucket = s.bucket AND {INSIDE}")
    return spans.alias("f").join(said.alias("s"), met).select(*MATCHED)


def comments_for_queue(queue: DataFrame, silver: DataFrame, bucket_seconds: int = 300) -> DataFrame:
    """As :func:`comments_in_windows`, with the scan of silver bounded below by the earliest window of the queue.

    The join is the same for a queue of any length; whether a short one is broadcast is Spark's choice by its size."""
    earliest = queue.agg(F.min("window_start")).scalar()
    recent = from_day(silver, earliest).filter(F.col("event_timestamp") >= earliest)
    return comments_in_windows(queue, recent, bucket_seconds)


def first_comments(comments: DataFrame, n: int = MAX_COMMENTS) -> DataFrame:
    """The first ``n`` comments of each flag in event order; the limit is applied within each task
    before the shuffle (window group limit), so a busy page ships at most ``n`` rows per task."""
    order = Window.partitionBy(*FLAG).orderBy("event_timestamp", "event_id")
    return comments.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def comment_context(comments: DataFrame, n: int = MAX_COMMENTS) -> DataFrame:
    """One text per flag: its first ``n`` comments, one line each with the signed size change."""
    line = F.format_string("- (%s bytes) %s", signed_bytes(F.col("byte_delta")), F.col("comment"))
    bounded = first_comments(comments, n).select(*FLAG, F.struct("place", line.alias("line")).alias("item"))
    lines = F.sort_array(F.collect_list("item"))
    return bounded.groupBy(*FLAG).agg(F.array_join(F.transform(lines, lambda i: i["line"]), "\n").alias("context"))


def with_context(flags: DataFrame, context: DataFrame) -> DataFrame:
    """Flags with their context; those without comments get the fixed text."""
    return flags.join(context, list(FLAG), "left").withColumn(
        "context", F.coalesce("context", F.lit(NO_COMMENTS))
    )


def request_text() -> Column:
    """What a text generator is asked: the figures of the surge and its comments."""
    return F.format_string(
        "Article %s drew %s edits in one window; %s is usual (z-score %s). "
        "Editors: %s. Net size change: %s bytes.\nComments:\n%s\n"
        "State in two or three sentences what most likely explains this.",
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
            for c in (
                "title", "edit_count", "baseline_mean", "z_score", "unique_editors",
                "total_byte_delta", "context",
            )
        ],
    )


def activity_class(text: Column) -> Column:
    """The first class whose words occur in the comments."""
    found = F.lit(DEFAULT_ACTIVITY)
    for name, pattern in reversed(ACTIVITY_WORDS.items()):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return F.when(text == NO_COMMENTS, UNCLEAR_ACTIVITY).otherwise(found)


def local_summary() -> Column:
    """A summary without any remote call: the keyword class in a fixed sentence."""
    return F.format_string(
        "%s drew %s edits by %s editors against a usual %s (z-score %s), most likely %s.",
        "title",
        F.col("edit_count").cast("string"),
        F.col("unique_editors").cast("string"),
        F.col("baseline_mean").cast("string"),
        F.col("z_score").cast("string"),
        activity_class(F.col("context")),
    )


Generator = Callable[[pd.DataFrame], pd.DataFrame]
"""Gets a batch with ``request`` and the flag's figures; returns ``summary`` and ``searches_used``,
index-aligned. Rows it leaves out, or leaves empty, stay pending."""


def generated(queue: DataFrame, generator: Generator) -> DataFrame:
    """Summaries by a pluggable generator, called on the executors one Arrow batch at a time.

    A batch that raises is retried row by row, so one bad row does not take the others with it;
    rows that still fail are left out and remain pending.
    """
    def attempt(rows: pd.DataFrame) -> pd.DataFrame:
        made = generator(rows).reindex(columns=["summary", "searches_used"])
        return rows.join(made, how="inner")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            try:
                out = attempt(batch)
            except Exception:
                parts = []
                for i in range(len(batch)):
                    try:
                        parts.append(attempt(batch.iloc[[i]]))
                    except Exception:
                        continue
                if not parts:
                    continue
                out = pd.concat(parts)
            out["searches_used"] = out["searches_used"].fillna(0).astype("int64")
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queue.schema.fields)
    return queue.mapInPandas(run, f"{schema}, summary string, searches_used bigint")


def summarize(
    queue: DataFrame,
    generator: Generator | None = None,
    as_of: AsOf = None,
    model: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Rows of the summaries table for a queue with context. Without a generator, the local keyword
    rules are used, which are plain column expressions. ``tasks`` spreads a short queue over that many
    tasks, for generators that spend their time waiting."""
    if tasks:
        queue = queue.repartition(tasks)
    if generator is None:
        made = queue.withColumn("summary", local_summary()).withColumn("searches_used", F.lit(0).cast("bigint"))
    else:
        made = generated(queue.withColumn("request", request_text()), generator)
    return (
        made.withColumn("summary", F.trim("summary"))
        .filter(F.length("summary") > 0)
        .withColumn("model_used", F.lit(model or (LOCAL_MODEL if generator is None else "custom")))
        .withColumn("generated_at", now(as_of))
        .withColumn("id", summary_id(F.col("title"), F.col("window_start")))
        .select(*SUMMARY_COLUMNS)
    )


def with_summary_id(summaries: DataFrame) -> DataFrame:
    """Add the ``id`` column to a table that lacks it, or fill it where it is NULL."""
    made = summary_id(F.col("title"), F.col("window_start"))
    return summaries.withColumn("id", F.coalesce("id", made) if "id" in summaries.columns else made)


def mark_summarized(flags: DataFrame, done: DataFrame) -> DataFrame:
    """Flags with every pending window of the ``done`` titles set to summarised; other rows as they were.

    Join strategy is left to Catalyst: ``done`` is tiny in a run (bounded by the queue) and is then
    broadcast by its size, but nothing breaks when it is not.
    """
    titles = done.select("title").distinct().withColumn("is_done", F.lit(True))
    return flags.join(titles, "title", "left").withColumn(
        "summarized", F.col("summarized") | F.coalesce("is_done", F.lit(False))
    ).drop("is_done").select(*flags.columns)


def with_state(flags: DataFrame, summaries: DataFrame) -> DataFrame:
    """Flags with ``summarized`` as the stored summaries tell it: a flag is done once its title was summarised at or
    after its detection. Both tables are only appended to, so no flag is ever rewritten or lost."""
    latest = summaries.groupBy("title").agg(F.max("generated_at").alias("last_summary"))
    done = F.coalesce(F.col("last_summary") >= F.col("detected_at"), F.lit(False))
    return flags.join(latest, "title", "left").withColumn("summarized", F.col("summarized") | done).select(*flags.columns)
