"""Baselines, surges, the summary queue and what is served from them."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
from pyspark.sql import functions as F

from tidegauge.model import contracts as c
from tidegauge.operators import anomaly, baseline, summaries, windows
from tidegauge.plans import alerts, checks, jobs, served
from tidegauge.registry.core import HOUR, query
from tidegauge.session import scratch_path
from tidegauge.sources.tables import Tables

# ------------------------------------------------------------------ which keys surged

KIND = ("event_type",)


def surging_kinds(events):
    """Hourly counts per event type, their baseline, and the hours far above it."""
    counts = windows.event_counts(events, HOUR, KIND, "ts")
    return anomaly.surges(counts, baseline.baseline_stats(counts, KIND), KIND).select(
        "event_type", "window_start", "window_end", "edit_count", "baseline_mean", "baseline_stddev", "z_score")


@query("surging_event_types", """
    WITH counts AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS edit_count
                    FROM events GROUP BY ALL),
         stats AS (SELECT event_type, avg(edit_count) AS m, stddev_samp(edit_count) AS s FROM counts
                   GROUP BY 1 HAVING count(*) >= 10)
    SELECT event_type, window_start, window_start + INTERVAL 1 HOUR AS window_end, edit_count,
           round(m, 2) AS baseline_mean, round(s, 2) AS baseline_stddev,
           round((edit_count - m) / nullif(s, 0), 2) AS z_score
    FROM counts JOIN stats USING (event_type)
    WHERE edit_count >= 3 AND round((edit_count - m) / nullif(s, 0), 2) >= 3""")
def _(m):
    return surging_kinds(m.events)


# ------------------------------------------------------------------ baseline and detection

BASELINE_SQL = """
    SELECT title, namespace, window_count, round(mean_edit_count, 6) AS mean_edit_count,
           round(stddev_edit_count, 6) AS stddev_edit_count, round(mean_unique_editors, 6) AS mean_unique_editors,
           round(mean_total_byte_delta, 6) AS mean_total_byte_delta, data_from, data_through"""


def rounded(df):
    floats = ["mean_edit_count", "stddev_edit_count", "mean_unique_editors", "mean_total_byte_delta"]
    return df.withColumns({c: F.round(c, 6) for c in floats})


@query("a4_rolling_baseline", """
    WITH recent AS (SELECT gold.* FROM gold, clock WHERE window_start >= t - INTERVAL 7 DAY)
    SELECT title, namespace, count(*) AS window_count, round(avg(edit_count), 6) AS mean_edit_count,
           round(stddev_samp(edit_count), 6) AS stddev_edit_count,
           round(avg(unique_editors), 6) AS mean_unique_editors,
           round(avg(total_byte_delta), 6) AS mean_total_byte_delta,
           min(window_start) AS data_from, max(window_start) AS data_through,
           (SELECT CAST(t AS DATE) FROM clock) AS baseline_date, (SELECT t FROM clock) AS computed_at,
           7 AS lookback_days
    FROM recent GROUP BY 1, 2 HAVING count(*) >= 10""")
def _(m):
    return rounded(baseline.rolling_baseline(m.gold, m.as_of, lookback_days=7))


@query("a4_incremental_baseline", """
    WITH recent AS (SELECT gold.* FROM gold, clock WHERE window_start >= t - INTERVAL 7 DAY)
    SELECT title, namespace, count(*) AS window_count, round(avg(edit_count), 6) AS mean_edit_count,
           round(stddev_samp(edit_count), 6) AS stddev_edit_count,
           round(avg(unique_editors), 6) AS mean_unique_editors,
           round(avg(total_byte_delta), 6) AS mean_total_byte_delta,
           min(window_start) AS data_from, max(window_start) AS data_through,
           (SELECT CAST(t AS DATE) FROM clock) AS baseline_date
    FROM recent GROUP BY 1, 2 HAVING count(*) >= 10""")
def _(m):
    """Daily runs over stored windows: each merges the moments of settled days with the days that are open."""
    tables = Tables(m.spark, scratch_path(m.spark, "moments"))
    zoned = {n: F.col(n).cast("timestamp") for n in ("window_start", "window_end")}
    tables.append(c.GOLD_5MIN, m.gold.withColumns(zoned))
    last = m.spark.range(1).select(m.as_of.cast("timestamp").alias("at")).first()["at"]
    for days_ago in (2, 0):
        jobs.run_baseline_incremental(tables, last - timedelta(days=days_ago), lookback_days=7)
    found = tables.read(c.BASELINE).filter(F.col("baseline_date") == F.lit(last.date()))
    return rounded(found).drop("computed_at", "lookback_days")


@query("a4_baseline_history", BASELINE_SQL + " FROM baseline")
def _(m):
    return rounded(m.baseline)


@query("j1_windows_with_baseline", """
    SELECT title, namespace, window_start, edit_count,
           round((edit_count - mean_edit_count) / nullif(stddev_edit_count, 0), 2) AS z_score
    FROM hourly JOIN baseline USING (title, namespace)""")
def _(m):
    return anomaly.scored(m.hourly, m.baseline).select("title", "namespace", "window_start", "edit_count", "z_score")


@query("a5_surges", "SELECT * EXCLUDE (detected_at, summarized) FROM flags")
def _(m):
    return m.flags.drop("detected_at", "summarized")


# Yesterday's baseline against the last day of hours, as a scheduled run would compare them.
DAILY = """
    WITH day_base AS (
        SELECT title, namespace, avg(edit_count) AS m, stddev_samp(edit_count) AS s FROM hourly, clock
        WHERE window_start >= t - INTERVAL 1 DAY - INTERVAL 30 DAY GROUP BY 1, 2 HAVING count(*) >= 10),
    recent AS (SELECT hourly.* FROM hourly, clock WHERE window_start >= t - INTERVAL 10 DAY)"""


def yesterdays(m):
    return baseline.rolling_baseline(m.hourly, m.as_of - F.expr("INTERVAL 1 DAY"))


@query("c1_detect_anomalies", DAILY + """
    SELECT title, namespace, window_start, window_end, edit_count, unique_editors, total_byte_delta,
           round(m, 2) AS baseline_mean, round(s, 2) AS baseline_stddev,
           round((edit_count - m) / nullif(s, 0), 2) AS z_score, (SELECT t FROM clock) AS detected_at,
           false AS summarized
    FROM recent JOIN day_base USING (title, namespace)
    WHERE edit_count >= 3 AND round((edit_count - m) / nullif(s, 0), 2) >= 3""")
def _(m):
    return anomaly.detect_anomalies(m.hourly, yesterdays(m), None, m.as_of, lookback_minutes=10 * 24 * 60)


@query("j3_unflagged", """
    SELECT title, namespace, window_start, z_score FROM flags f
    WHERE NOT EXISTS (SELECT 1 FROM flag_history h
                      WHERE h.title = f.title AND h.window_start = f.window_start AND h.summarized)""")
def _(m):
    known = m.flag_history.filter("summarized")
    return anomaly.unflagged(m.flags, known).select("title", "namespace", "window_start", "z_score")


@query("a6_surge_preview", DAILY + """
    SELECT title, namespace, window_start, edit_count, round(m, 1) AS baseline_mean, round(s, 1) AS baseline_stddev,
           round((edit_count - m) / nullif(s, 0), 2) AS z_score
    FROM recent JOIN day_base USING (title, namespace) WHERE (edit_count - m) / nullif(s, 0) > 3
    ORDER BY z_score DESC, title, namespace, window_start LIMIT 20""")
def _(m):
    return anomaly.surge_preview(m.hourly, yesterdays(m), m.as_of, hours=240)


@query("s21_flags_written", """
    SELECT title, namespace, window_start, z_score, detected_at FROM flags, flag_clock
    WHERE detected_at >= t - INTERVAL 2 MINUTE""")
def _(m):
    return anomaly.flags_written(m.flags, m.flag_clock).select(
        "title", "namespace", "window_start", "z_score", "detected_at")


# ------------------------------------------------------------------ queue, context, summaries

STRONGEST = """
    SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY title ORDER BY z_score DESC, window_start DESC, namespace) AS place
        FROM {source}) WHERE place = 1"""
QUEUE = f"""queue AS (SELECT * FROM ({STRONGEST.format(source='pending')}) ORDER BY z_score DESC, title LIMIT 20)"""


@query("w1_strongest_window", STRONGEST.format(source="flags"))
def _(m):
    return summaries.strongest_window(m.flags)


@query("c2_pending_queue", f"""
    WITH pending AS (SELECT * FROM flag_history WHERE NOT summarized), {QUEUE} SELECT * FROM queue""")
def _(m):
    return summaries.pending_queue(m.flag_history)


@query("j4_queue_with_cooldown", f"""
    WITH recent AS (SELECT DISTINCT title FROM summaries, summary_clock WHERE generated_at >= t - INTERVAL 1440 MINUTE),
         pending AS (SELECT * FROM flags WHERE title NOT IN (SELECT title FROM recent)), {QUEUE}
    SELECT * FROM queue""")
def _(m):
    return summaries.pending_queue(m.flags, m.summaries, m.summary_clock, cooldown_minutes=1440)


SAID = """
    said AS (SELECT f.title, f.namespace, f.window_start, s.event_id, s.event_timestamp, s.comment, s.byte_delta
             FROM {flags} f JOIN silver s ON s.title = f.title AND s.event_timestamp >= f.window_start
                  AND s.event_timestamp < f.window_end AND length(s.comment) > 0)"""
FIRST = """
    first AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY title, namespace, window_start
                                     ORDER BY event_timestamp, event_id) AS place FROM said) WHERE place <= {n})"""
CONTEXT = """
    context AS (SELECT title, namespace, window_start,
                       string_agg('- (' || CASE WHEN byte_delta IS NULL THEN 'n/a' WHEN byte_delta >= 0
                                  THEN '+' || byte_delta ELSE CAST(byte_delta AS VARCHAR) END || ' bytes) ' || comment,
                                  chr(10) ORDER BY place) AS context
                FROM first GROUP BY 1, 2, 3)"""
ASKED = """
    asked AS (SELECT q.*, coalesce(c.context, '(no edit summaries were provided for these edits)') AS context
              FROM {flags} q LEFT JOIN context c USING (title, namespace, window_start))"""


def asked_sql(flags: str, n: int = 25) -> str:
    return ",".join([SAID.format(flags=flags), FIRST.format(n=n), CONTEXT, ASKED.format(flags=flags)])


@query("j5_comments_in_windows", "WITH" + SAID.format(flags="flags") + " SELECT * FROM said")
def _(m):
    return summaries.comments_in_windows(m.flags, m.silver, bucket_seconds=3600)


@query("w3_first_comments", "WITH" + SAID.format(flags="flags") + "," + FIRST.format(n=2) + """
    SELECT title, window_start, event_id, CAST(place AS INTEGER) AS place FROM first""")
def _(m):
    said = summaries.comments_in_windows(m.flags, m.silver, bucket_seconds=3600)
    return summaries.first_comments(said, 2).select("title", "window_start", "event_id", "place")


@query("c3_comment_context", "WITH" + asked_sql("flags") + """
    SELECT title, namespace, window_start, context FROM asked""")
def _(m):
    said = summaries.comments_in_windows(m.flags, m.silver, bucket_seconds=3600)
    return summaries.with_context(m.flags, summaries.comment_context(said)).select(
        "title", "namespace", "window_start", "context")


def queue_with_context(m):
    queue = summaries.pending_queue(m.flag_history)
    said = summaries.comments_for_queue(queue, m.silver)
    return summaries.with_context(queue, summaries.comment_context(said))


PENDING_ASKED = f"""
    WITH pending AS (SELECT * FROM flag_history WHERE NOT summarized), {QUEUE}, {asked_sql('queue')}"""


@query("c3_queue_context", PENDING_ASKED + " SELECT title, namespace, window_start, context FROM asked")
def _(m):
    return queue_with_context(m).select("title", "namespace", "window_start", "context")


@query("c4_request_text", PENDING_ASKED + """
    SELECT title, window_start, 'Article ' || title || ' drew ' || edit_count || ' edits in one window; '
           || baseline_mean || ' is usual (z-score ' || z_score || '). Editors: ' || unique_editors
           || '. Net size change: ' || coalesce(CAST(total_byte_delta AS VARCHAR), 'unknown') || ' bytes.' || chr(10)
           || 'Comments:' || chr(10) || context || chr(10)
           || 'State in two or three sentences what most likely explains this.' AS request
    FROM asked""")
def _(m):
    return queue_with_context(m).select("title", "window_start", summaries.request_text().alias("request"))


@query("c5_summarize", "WITH" + asked_sql("flags") + """
    SELECT title, window_start, z_score, edit_count, title || ' drew ' || edit_count || ' edits by '
           || unique_editors || ' editors against a usual ' || baseline_mean || ' (z-score ' || z_score
           || '), most likely ' || CASE WHEN context = '(no edit summaries were provided for these edits)'
              THEN 'unclear, as no comments were left' ELSE 'a real-world event or breaking news' END || '.' AS summary, CAST(0 AS BIGINT) AS searches_used,
           'keyword-rules' AS model_used, (SELECT t FROM clock) AS generated_at,
           md5(title || '|' || CAST(window_start AS VARCHAR)) AS id
    FROM asked""")
def _(m):
    said = summaries.comments_in_windows(m.flags, m.silver, bucket_seconds=3600)
    asked = summaries.with_context(m.flags, summaries.comment_context(said))
    return summaries.summarize(asked, as_of=m.as_of)


def line_counter(rows: pd.DataFrame) -> pd.DataFrame:
    """A stand-in generator: tells how many lines it was given."""
    lines = rows["context"].str.count("\n") + 1
    return pd.DataFrame({"summary": rows["title"] + ": " + lines.astype(str) + " lines", "searches_used": 1})


@query("c5_summarize_by_generator", "WITH" + asked_sql("flags") + """
    SELECT title, window_start, title || ': ' || (length(context) - length(replace(context, chr(10), '')) + 1)
           || ' lines' AS summary, CAST(1 AS BIGINT) AS searches_used, 'line-counter' AS model_used,
           md5(title || '|' || CAST(window_start AS VARCHAR)) AS id
    FROM asked""")
def _(m):
    said = summaries.comments_in_windows(m.flags, m.silver, bucket_seconds=3600)
    asked = summaries.with_context(m.flags, summaries.comment_context(said))
    return summaries.summarize(asked, line_counter, m.as_of, "line-counter").select(
        "title", "window_start", "summary", "searches_used", "model_used", "id")


@query("c7_mark_summarized", f"""
    WITH pending AS (SELECT * FROM flag_history WHERE NOT summarized), {QUEUE}
    SELECT title, namespace, window_start, summarized OR title IN (SELECT title FROM queue) AS summarized
    FROM flag_history""")
def _(m):
    done = summaries.pending_queue(m.flag_history)
    return summaries.mark_summarized(m.flag_history, done).select("title", "namespace", "window_start", "summarized")


@query("s16_backfill_ids", "SELECT title, window_start, id FROM summaries")
def _(m):
    return summaries.with_summary_id(m.summaries.drop("id")).select("title", "window_start", "id")


# ------------------------------------------------------------------ served and checked

@query("an1_recent_anomalies", """
    SELECT title, window_start, window_end, edit_count, baseline_mean, baseline_stddev, z_score, unique_editors,
           total_byte_delta, detected_at
    FROM flags, flag_clock WHERE detected_at >= t - INTERVAL 2 HOUR ORDER BY z_score DESC, title, window_start LIMIT 20""")
def _(m):
    return served.recent_anomalies(m.flags, m.flag_clock)


@query("an2_anomalies_per_hour", """
    SELECT date_trunc('hour', detected_at) AS hour, count(*) AS anomaly_count, max(z_score) AS peak_z_score
    FROM flags, flag_clock WHERE detected_at >= CAST(t AS DATE) GROUP BY 1""")
def _(m):
    return served.anomalies_per_hour(m.flags, m.flag_clock)


@query("an3_sustained_surges", """
    SELECT title, count(*) AS anomalous_windows, max(z_score) AS peak_z_score, max(edit_count) AS peak_edits,
           min(window_start) AS first_detected
    FROM flags, flag_clock WHERE detected_at >= CAST(t AS DATE) GROUP BY title
    ORDER BY anomalous_windows DESC, peak_z_score DESC, title LIMIT 15""")
def _(m):
    return served.sustained_surges(m.flags, m.flag_clock)


@query("an4_latest_summaries", """
    SELECT title, z_score, edit_count, summary, generated_at FROM summaries, summary_clock
    WHERE generated_at >= t - INTERVAL 6 HOUR ORDER BY generated_at DESC, z_score DESC, title LIMIT 20""")
def _(m):
    return served.latest_summaries(m.summaries, m.summary_clock)


@query("alt2_new_anomalies", """
    SELECT count(*) AS new_anomalies FROM flag_history, flag_clock
    WHERE detected_at >= t - INTERVAL 15 MINUTE AND NOT summarized""")
def _(m):
    return alerts.new_anomalies(m.flag_history, m.flag_clock)


@query("alert_new_anomalies_state", """
    SELECT 'new anomaly flags' AS name, CAST(count(*) AS DOUBLE) AS value,
           CASE WHEN count(*) > 0 THEN 'TRIGGERED' ELSE 'OK' END AS state
    FROM flag_history, flag_clock WHERE detected_at >= t - INTERVAL 15 MINUTE AND NOT summarized""")
def _(m):
    found = alerts.new_anomalies(m.flag_history, m.flag_clock)
    return alerts.evaluate(found, "new anomaly flags", "GREATER_THAN", 0)


@query("q17_anomalies_since", """
    SELECT title, window_start, edit_count, baseline_mean, baseline_stddev, z_score, detected_at
    FROM flags, flag_clock WHERE detected_at >= t - INTERVAL 48 HOUR""")
def _(m):
    return checks.anomalies_since(m.flags, m.flag_clock, hours=48)


@query("q18_persistent_surges", """
    SELECT title, count(*) AS anomalous_windows, max(z_score) AS peak_z_score, max(edit_count) AS peak_edits
    FROM flags, flag_clock WHERE detected_at >= CAST(t AS DATE) GROUP BY title
    ORDER BY anomalous_windows DESC, peak_z_score DESC, title LIMIT 20""")
def _(m):
    return checks.persistent_surges(m.flags, m.flag_clock)


@query("q19_unsummarized", "SELECT * FROM flag_history WHERE NOT summarized")
def _(m):
    return checks.unsummarized(m.flag_history)


@query("q20_newest_summaries", """
    SELECT title, z_score, edit_count, searches_used, summary, generated_at FROM summaries
    ORDER BY generated_at DESC, z_score DESC, title LIMIT 20""")
def _(m):
    return checks.newest_summaries(m.summaries)


@query("q21_search_usage", """
    SELECT CAST(sum(searches_used) AS BIGINT) AS total_searches, count(*) AS pages_summarized,
           round(avg(searches_used), 2) AS avg_searches_per_page,
           count(*) FILTER (WHERE searches_used > 0) AS pages_that_searched
    FROM summaries, summary_clock WHERE generated_at >= CAST(t AS DATE)""")
def _(m):
    return checks.search_usage(m.summaries, m.summary_clock)


@query("q22_stuck_flags", """
    SELECT count(*) AS stuck FROM flag_history, flag_clock WHERE NOT summarized AND detected_at < t - INTERVAL 1 HOUR""")
def _(m):
    return checks.stuck_flags(m.flag_history, m.flag_clock)


@query("q26_baseline_coverage", """
    WITH b AS (SELECT title, namespace, count(*) AS n FROM gold, clock
               WHERE window_start >= t - INTERVAL 30 DAY GROUP BY 1, 2 HAVING count(*) >= 10)
    SELECT count(*) AS pages, min(n) AS min_windows, max(n) AS max_windows FROM b""")
def _(m):
    return checks.baseline_coverage(baseline.rolling_baseline(m.gold, m.as_of), m.as_of)


@query("q27_baseline_written", """
    WITH b AS (SELECT title, namespace, count(*) AS n FROM gold, clock
               WHERE window_start >= t - INTERVAL 30 DAY GROUP BY 1, 2 HAVING count(*) >= 10)
    SELECT count(*) AS pages_written FROM b""")
def _(m):
    return baseline.baseline_written(baseline.rolling_baseline(m.gold, m.as_of), m.as_of)


@query("k5_latest_summary", """
    SELECT id, title, z_score, generated_at FROM summaries
    ORDER BY generated_at DESC, z_score DESC, title LIMIT 1""")
def _(m):
    return served.latest_row(m.summaries).select("id", "title", "z_score", "generated_at")
