"""Parsing, quality, windows, served queries and checks over the event layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions.clock import since
from tidegauge.functions.percentiles import exact_percentiles
from tidegauge.functions.scalars import bucket_label, namespace_label
from tidegauge.operators import quality, windows
from tidegauge.operators.parse import parse_events
from tidegauge.plans import alerts, checks, served
from tidegauge.registry.core import query
from tidegauge.sources.landing import retention_report
from tidegauge.sources.tables import by_title

# ------------------------------------------------------------------ parsing and quality

PARSED = [
    "event_id", "mw_id", "event_type", "wiki", "namespace", "title", "user", "bot", "minor", "event_timestamp",
    "event_dt", "comment", "length_old", "length_new", "byte_delta", "revision_new", "log_id", "log_type",
    "log_params", "ingest_timestamp", "ingest_date",
]


@query("p1_parse_events", """
    SELECT event_id, mw_id, event_type, wiki, namespace, title, "user", bot, minor, event_timestamp, event_dt,
           comment, length_old, length_new, byte_delta, mw_id AS revision_new, log_id, log_type,
           CASE WHEN log_k IS NOT NULL THEN '{"k":' || log_k || '}' END AS log_params, ingest_timestamp, ingest_date
    FROM parsed""")
def _(m):
    return parse_events(m.bronze).select(*PARSED)


@query("p2_log_params", """
    SELECT log_type, '{"k":' || log_k || '}' AS log_params, count(*) AS n
    FROM parsed WHERE log_k IS NOT NULL GROUP BY ALL""")
def _(m):
    return parse_events(m.bronze).filter(F.col("log_params").isNotNull()).groupBy("log_type", "log_params").agg(
        F.count("*").alias("n"))


@query("p5_accepted", 'SELECT event_id, event_type, title, "user", byte_delta, event_timestamp FROM silver')
def _(m):
    return quality.accepted(parse_events(m.bronze)).select(
        "event_id", "event_type", "title", "user", "byte_delta", "event_timestamp")


@query("p7_quarantine_reason", "SELECT event_id, wiki, event_type, namespace, bot, quarantine_reason FROM quarantine")
def _(m):
    return quality.rejected(parse_events(m.bronze)).select(
        "event_id", "wiki", "event_type", "namespace", "bot", "quarantine_reason")


@query("p11_recent_rows", """
    SELECT event_id, title, ingest_timestamp FROM silver, clock
    WHERE ingest_timestamp >= t - INTERVAL 2 DAY AND ingest_timestamp < t - INTERVAL 1 DAY""")
def _(m):
    recent = since(m.silver, "ingest_timestamp", m.as_of, "2 DAYS", until="1 DAY", part="ingest_date")
    return recent.select("event_id", "title", "ingest_timestamp")


@query("p12_yesterday", """
    SELECT event_id, title FROM silver, clock WHERE event_date = CAST(t AS DATE) - 1""")
def _(m):
    return m.silver.filter(F.col("event_date") == F.date_sub(m.as_of.cast("date"), 1)).select("event_id", "title")


# Conditions that the test data breaks: comments are sometimes missing, sizes sometimes jump.
TEST_EXPECTATIONS = (
    quality.Expectation("comment_not_null", "comment IS NOT NULL", hard=True),
    quality.Expectation("title_not_null", "title IS NOT NULL", hard=True),
    quality.Expectation("byte_delta_small", "byte_delta IS NULL OR byte_delta BETWEEN -40 AND 40"),
)


@query("p13_expect_or_drop", "SELECT event_id, comment, byte_delta FROM silver WHERE comment IS NOT NULL")
def _(m):
    return quality.enforce(m.silver, TEST_EXPECTATIONS).select("event_id", "comment", "byte_delta")


@query("p14_expectation_report", """
    SELECT 'silver' AS flow, 'comment_not_null' AS expectation, 'drop' AS kind,
           count(*) FILTER (WHERE comment IS NOT NULL) AS passed, count(*) FILTER (WHERE comment IS NULL) AS failed
    FROM silver
    UNION ALL SELECT 'silver', 'title_not_null', 'drop', count(*), 0 FROM silver
    UNION ALL SELECT 'silver', 'byte_delta_small', 'warn',
           count(*) FILTER (WHERE byte_delta IS NULL OR byte_delta BETWEEN -40 AND 40),
           count(*) FILTER (WHERE byte_delta NOT BETWEEN -40 AND 40) FROM silver""")
def _(m):
    return quality.expectation_report(m.silver, TEST_EXPECTATIONS)


@query("p15_expectation_failures", """
    SELECT 'silver' AS flow, 'comment_not_null' AS expectation,
           count(*) FILTER (WHERE comment IS NULL) AS failed FROM silver""")
def _(m):
    report = quality.expectation_report(m.silver, TEST_EXPECTATIONS).withColumn("at", m.as_of)
    return quality.failures(report).select("flow", "expectation", "failed")


@query("p16_namespace_label", """
    SELECT CASE namespace WHEN 0 THEN 'article' WHEN 1 THEN 'talk' ELSE CAST(namespace AS VARCHAR) END AS namespace,
           count(*) AS n FROM parsed GROUP BY 1""")
def _(m):
    return m.parsed.groupBy("namespace").agg(F.count("*").alias("n")).withColumn(
        "namespace", namespace_label(F.col("namespace")))


@query("p19_conservation", """
    SELECT (SELECT count(*) FROM bronze) AS bronze, (SELECT count(*) FROM silver) AS silver,
           (SELECT count(*) FROM quarantine) AS quarantine, CAST(0 AS BIGINT) AS duplicates,
           CAST(0 AS BIGINT) AS dropped, CAST(0 AS BIGINT) AS unexplained""")
def _(m):
    parsed = parse_events(m.bronze)
    return quality.conservation(m.bronze, quality.clean(parsed), quality.rejected(parsed))


# ------------------------------------------------------------------ windows and aggregates

@query("a1_page_windows", "SELECT * FROM gold")
def _(m):
    return m.gold


@query("a1_page_windows_from_raw", """
    SELECT window_start, title, namespace, edit_count, total_byte_delta, avg_byte_delta, max_byte_delta FROM gold""")
def _(m):
    """The whole batch chain: raw lines, parsed, cleaned, de-duplicated, windowed."""
    return windows.page_metrics(quality.clean(parse_events(m.bronze))).select(
        "window_start", "title", "namespace", "edit_count", "total_byte_delta", "avg_byte_delta", "max_byte_delta")


@query("a2_approx_editors")
def _(m):
    return windows.page_metrics(m.silver, "1 day").select("window_start", "title", "unique_editors")


@query("a3_minor_edits", """
    SELECT title, count(*) FILTER (WHERE minor) AS minor_edits, count(*) AS edits FROM silver GROUP BY title""")
def _(m):
    return m.silver.groupBy("title").agg(
        F.sum(F.when(F.col("minor"), 1).otherwise(0)).alias("minor_edits"), F.count("*").alias("edits"))


@query("a10_percentiles", """
    SELECT quantile_cont(byte_delta, 0.05) AS p05, quantile_cont(byte_delta, 0.5) AS p50,
           quantile_cont(byte_delta, 0.95) AS p95, quantile_cont(byte_delta, 0.99) AS p99 FROM parsed""")
def _(m):
    return exact_percentiles(m.parsed, "byte_delta", {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99})


@query("a15_page_totals", """
    SELECT title, CAST(sum(edit_count) AS BIGINT) AS total_edits, CAST(sum(unique_editors) AS BIGINT) AS editors,
           CAST(sum(total_byte_delta) AS BIGINT) AS net_bytes, CAST(sum(minor_edit_count) AS BIGINT) AS minor_edits
    FROM gold GROUP BY title""")
def _(m):
    return served.page_totals(m.gold, "title")


@query("t4_sliding_windows", """
    SELECT s AS window_start, s + INTERVAL 15 MINUTE AS window_end, CAST(s AS DATE) AS window_date, title, namespace,
           count(*) AS edit_count, count(DISTINCT "user") AS unique_editors,
           CAST(sum(byte_delta) AS BIGINT) AS total_byte_delta
    FROM (SELECT *, unnest(generate_series(time_bucket(INTERVAL 1 MINUTE, event_timestamp) - INTERVAL 14 MINUTE,
                                           time_bucket(INTERVAL 1 MINUTE, event_timestamp), INTERVAL 1 MINUTE)) AS s
          FROM silver)
    GROUP BY ALL""")
def _(m):
    return windows.sliding_page_metrics(m.silver, exact=True)


@query("time_bucket_label", """
    SELECT strftime(time_bucket(INTERVAL 5 MINUTE, event_timestamp), '%Y-%m-%d %H:%M:%S') AS bucket_start,
           count(*) AS n FROM parsed GROUP BY 1""")
def _(m):
    return m.parsed.groupBy(bucket_label(F.col("event_timestamp"), 300).alias("bucket_start")).agg(
        F.count("*").alias("n"))


# ------------------------------------------------------------------ served: producer and flow health

@query("ph1_ingest_per_hour", """
    SELECT date_trunc('hour', ingest_timestamp) AS hour, count(*) AS events_ingested,
           round(sum(length(raw_json)) / 1048576.0, 1) AS mb_ingested
    FROM bronze, clock WHERE ingest_timestamp >= t - INTERVAL 24 HOUR GROUP BY 1""")
def _(m):
    return served.ingest_per_hour(m.bronze, m.as_of)


@query("ph2_staleness", """
    SELECT max(ingest_timestamp) AS latest_event, CAST(0 AS BIGINT) AS minutes_stale FROM bronze""")
def _(m):
    return served.staleness(m.bronze, m.as_of)


@query("ph3_ingest_trend", """
    SELECT date_trunc('hour', ingest_timestamp) AS day_hour, count(*) AS events_ingested
    FROM bronze, clock WHERE ingest_timestamp >= t - INTERVAL 7 DAY GROUP BY 1""")
def _(m):
    return served.ingest_trend(m.bronze, m.as_of)


@query("pl1_layer_snapshot", """
    SELECT 'bronze' AS layer, count(*) AS total_rows, max(ingest_timestamp) AS latest_event FROM bronze
    UNION ALL SELECT 'silver_enwiki', count(*), max(ingest_timestamp) FROM silver
    UNION ALL SELECT 'silver_quarantine', count(*), max(ingest_timestamp) FROM quarantine
    UNION ALL SELECT 'gold_5min_windows', count(*), max(window_end) FROM gold""")
def _(m):
    return served.layer_snapshot({
        "bronze": (m.bronze, "ingest_timestamp"),
        "silver_enwiki": (m.silver, "ingest_timestamp"),
        "silver_quarantine": (m.quarantine, "ingest_timestamp"),
        "gold_5min_windows": (m.gold, "window_end"),
    })


@query("pl2_pass_rates", """
    SELECT b AS bronze_1h, s AS silver_1h, q AS quarantine_1h,
           round(CAST(100.0 AS DOUBLE) * s / nullif(b, 0), 1) AS pass_rate_pct,
           round(CAST(100.0 AS DOUBLE) * q / nullif(b, 0), 1) AS quarantine_rate_pct
    FROM (SELECT (SELECT count(*) FROM bronze, clock WHERE ingest_timestamp >= t - INTERVAL 1 HOUR) AS b,
                 (SELECT count(*) FROM silver, clock WHERE ingest_timestamp >= t - INTERVAL 1 HOUR) AS s,
                 (SELECT count(*) FROM quarantine, clock WHERE ingest_timestamp >= t - INTERVAL 1 HOUR) AS q)""")
def _(m):
    return served.pass_rates(m.bronze, m.silver, m.quarantine, m.as_of)


@query("pl3_quarantine_breakdown", """
    SELECT quarantine_reason, count(*) AS events,
           round(CAST(100.0 AS DOUBLE) * count(*) / sum(count(*)) OVER (), 1) AS pct
    FROM quarantine, clock WHERE ingest_timestamp >= t - INTERVAL 1 HOUR GROUP BY 1""")
def _(m):
    return served.quarantine_breakdown(m.quarantine, m.as_of)


@query("pl4_silver_buckets", """
    SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ingest_timestamp), '%Y-%m-%d %H:%M:%S') AS bucket_start,
           count(*) AS silver_events
    FROM silver, clock WHERE ingest_timestamp >= t - INTERVAL 2 HOUR GROUP BY 1""")
def _(m):
    return served.rows_per_bucket(m.silver, m.as_of)


@query("pl5_windows_landing", """
    SELECT window_start, CAST(sum(edit_count) AS BIGINT) AS total_edits, count(DISTINCT title) AS pages_with_edits
    FROM gold, clock WHERE window_start >= t - INTERVAL 2 HOUR GROUP BY 1""")
def _(m):
    return served.windows_landing(m.gold, m.as_of)


@query("cv1_top_pages", """
    SELECT title, CAST(sum(edit_count) AS BIGINT) AS total_edits, CAST(sum(unique_editors) AS BIGINT) AS editors,
           CAST(sum(total_byte_delta) AS BIGINT) AS net_bytes, CAST(sum(minor_edit_count) AS BIGINT) AS minor_edits
    FROM gold, clock WHERE window_start >= t - INTERVAL 1 HOUR GROUP BY title
    ORDER BY total_edits DESC, title LIMIT 20""")
def _(m):
    return served.top_pages(m.gold, m.as_of)


@query("cv1b_top_pages_by_namespace", """
    SELECT title, CASE namespace WHEN 0 THEN 'article' WHEN 1 THEN 'talk' WHEN 4 THEN 'project'
                                 WHEN 10 THEN 'template' ELSE CAST(namespace AS VARCHAR) END AS namespace,
           CAST(sum(edit_count) AS BIGINT) AS total_edits, CAST(sum(unique_editors) AS BIGINT) AS editors,
           CAST(sum(total_byte_delta) AS BIGINT) AS net_bytes, CAST(sum(minor_edit_count) AS BIGINT) AS minor_edits
    FROM gold, clock WHERE window_start >= t - INTERVAL 1 HOUR GROUP BY title, gold.namespace
    ORDER BY total_edits DESC, title LIMIT 20""")
def _(m):
    return served.top_pages_by_namespace(m.gold, m.as_of)


@query("cv2_edit_volume", """
    SELECT window_start, CAST(sum(edit_count) AS BIGINT) AS total_edits, count(DISTINCT title) AS pages_edited,
           CAST(sum(total_byte_delta) AS BIGINT) AS net_bytes_added
    FROM gold, clock WHERE window_start >= t - INTERVAL 6 HOUR GROUP BY 1""")
def _(m):
    return served.edit_volume(m.gold, m.as_of)


@query("cv3_largest_edits", """
    SELECT title, "user", event_timestamp, byte_delta, substring(comment, 1, 120) AS comment_preview
    FROM silver, clock WHERE event_timestamp >= t - INTERVAL 1 HOUR AND byte_delta IS NOT NULL
    ORDER BY abs(byte_delta) DESC, event_timestamp, event_id LIMIT 10""")
def _(m):
    return served.largest_edits(m.silver, m.as_of)


@query("cv3_largest_edits_ever", """
    SELECT title, "user", event_timestamp, byte_delta, substring(comment, 1, 120) AS comment_preview
    FROM silver WHERE byte_delta IS NOT NULL ORDER BY abs(byte_delta) DESC, event_timestamp, event_id LIMIT 10""")
def _(m):
    return served.largest_edits(m.silver, m.as_of, hours=24 * 365)


@query("alt1_silver_gap", """
    SELECT count(*) AS silver_events_15min FROM silver, clock WHERE ingest_timestamp >= t - INTERVAL 15 MINUTE""")
def _(m):
    return alerts.silver_gap(m.silver, m.as_of)


@query("alert_silver_gap_state", """
    SELECT 'silver gap' AS name, CAST(count(*) AS DOUBLE) AS value,
           CASE WHEN count(*) = 0 THEN 'TRIGGERED' ELSE 'OK' END AS state
    FROM silver, clock WHERE ingest_timestamp >= t - INTERVAL 15 MINUTE""")
def _(m):
    return alerts.evaluate(alerts.silver_gap(m.silver, m.as_of), "silver gap", "EQUAL", 0)


# ------------------------------------------------------------------ checks

@query("q1_volume", """
    SELECT (SELECT count(*) FROM silver) AS silver_rows, (SELECT count(*) FROM bronze) AS bronze_rows,
           (SELECT count(*) FROM quarantine) AS quarantine_rows""")
def _(m):
    return checks.volume(m.silver, m.bronze, m.quarantine)


@query("q2_quarantine_shares", """
    SELECT quarantine_reason, count(*) AS cnt,
           round(CAST(100.0 AS DOUBLE) * count(*) / sum(count(*)) OVER (), 1) AS pct
    FROM quarantine GROUP BY 1""")
def _(m):
    return checks.quarantine_shares(m.quarantine)


@query("q3_purity", "SELECT DISTINCT bot, wiki, event_type FROM silver")
def _(m):
    return checks.purity(m.silver, "bot", "wiki", "event_type")


@query("q4_repeated_ids", """
    SELECT "user" AS event_id, count(*) AS dupes FROM parsed GROUP BY 1 HAVING count(*) > 1
    ORDER BY dupes DESC, event_id LIMIT 10""")
def _(m):
    """Ids are unique in the given table, so the operator is shown on a column that repeats."""
    return checks.repeated_ids(m.parsed.select(F.col("user").alias("event_id")))


@query("q4_repeated_id_count", """
    SELECT count(*) AS duplicate_event_ids FROM (SELECT event_id FROM silver GROUP BY 1 HAVING count(*) > 1)""")
def _(m):
    return checks.repeated_id_count(m.silver)


@query("q5_byte_delta_profile", """
    SELECT min(byte_delta) AS min_delta, max(byte_delta) AS max_delta, round(avg(byte_delta), 1) AS avg_delta,
           quantile_cont(byte_delta, 0.5) AS p50_delta, quantile_cont(byte_delta, 0.95) AS p95_delta,
           count(*) FILTER (WHERE byte_delta IS NULL) AS null_delta_rows FROM silver""")
def _(m):
    return checks.byte_delta_profile(m.silver)


@query("q6_busiest_pages", """
    SELECT title, count(*) AS edits, count(DISTINCT "user") AS unique_editors
    FROM silver, clock WHERE event_timestamp >= t - INTERVAL 1 HOUR
    GROUP BY title ORDER BY edits DESC, title LIMIT 10""")
def _(m):
    return checks.busiest_pages(m.silver, m.as_of)


@query("q8_reconcile", """
    WITH s AS (SELECT title, namespace, time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS w, count(*) AS e,
                      sum(byte_delta) AS b FROM silver, clock
               WHERE event_timestamp >= t - INTERVAL 2 HOUR AND event_timestamp < t - INTERVAL 15 MINUTE GROUP BY ALL),
         g AS (SELECT title, namespace, window_start AS w, edit_count, total_byte_delta FROM gold, clock
               WHERE window_start >= t - INTERVAL 2 HOUR AND window_start < t - INTERVAL 15 MINUTE)
    SELECT count(*) AS windows_compared, CAST(sum(abs(e - edit_count)) AS BIGINT) AS total_edit_count_diff,
           CAST(sum(abs(coalesce(b, 0) - coalesce(total_byte_delta, 0))) AS BIGINT) AS total_byte_diff,
           max(abs(e - edit_count)) AS max_edit_count_diff
    FROM s JOIN g USING (title, namespace, w)""")
def _(m):
    return checks.reconcile(m.silver, m.gold, m.as_of)


@query("q8_reconcile_history", """
    WITH s AS (SELECT title, namespace, time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS w, count(*) AS e,
                      sum(byte_delta) AS b FROM silver, clock
               WHERE event_timestamp < t - INTERVAL 15 MINUTE GROUP BY ALL),
         g AS (SELECT title, namespace, window_start AS w, edit_count, total_byte_delta FROM gold, clock
               WHERE window_start < t - INTERVAL 15 MINUTE)
    SELECT count(*) AS windows_compared, CAST(sum(abs(e - edit_count)) AS BIGINT) AS total_edit_count_diff,
           CAST(sum(abs(coalesce(b, 0) - coalesce(total_byte_delta, 0))) AS BIGINT) AS total_byte_diff,
           max(abs(e - edit_count)) AS max_edit_count_diff
    FROM s JOIN g USING (title, namespace, w)""")
def _(m):
    return checks.reconcile(m.silver, m.gold, m.as_of, hours=None)


@query("q9_bronze_coverage", """
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE event_id IS NULL) AS null_event_ids,
           count(*) FILTER (WHERE raw_json IS NULL) AS null_raw_json FROM bronze""")
def _(m):
    return checks.bronze_coverage(m.bronze)


@query("q10_layers_live", """
    SELECT 'bronze' AS layer, count(*) AS "rows", max(ingest_timestamp) AS latest FROM bronze
    UNION ALL SELECT 'silver', count(*), max(ingest_timestamp) FROM silver
    UNION ALL SELECT 'gold', count(*), max(window_end) FROM gold""")
def _(m):
    return served.layer_snapshot(
        {"bronze": (m.bronze, "ingest_timestamp"), "silver": (m.silver, "ingest_timestamp"), "gold": (m.gold, "window_end")},
        rows="rows", latest="latest")


@query("q11_silver_share", """
    SELECT round(CAST(100.0 AS DOUBLE) * (SELECT count(*) FROM silver) / (SELECT count(*) FROM bronze), 1)
           AS silver_pct_of_bronze""")
def _(m):
    return checks.silver_share(m.silver, m.bronze)


@query("q12_latest_windows", """
    SELECT window_start, window_end, count(*) AS pages, CAST(sum(edit_count) AS BIGINT) AS total_edits
    FROM gold GROUP BY 1, 2 ORDER BY 1 DESC LIMIT 5""")
def _(m):
    return checks.latest_windows(m.gold)


@query("q13_consistency", """
    SELECT b AS bronze, s AS silver, q AS quarantine, b - s - q AS unaccounted,
           round(CAST(100.0 AS DOUBLE) * s / nullif(b, 0), 1) AS silver_pct,
           round(CAST(100.0 AS DOUBLE) * q / nullif(b, 0), 1) AS quarantine_pct, g AS gold_events,
           round(CAST(100.0 AS DOUBLE) * g / nullif(s, 0), 1) AS gold_coverage_pct
    FROM (SELECT (SELECT count(*) FROM bronze) AS b, (SELECT count(*) FROM silver) AS s,
                 (SELECT count(*) FROM quarantine) AS q, (SELECT CAST(sum(edit_count) AS BIGINT) FROM gold) AS g)""")
def _(m):
    return checks.consistency(m.bronze, m.silver, m.quarantine, m.gold)


@query("q14_page_leaders", """
    SELECT title, CAST(sum(edit_count) AS BIGINT) AS edits, CAST(sum(unique_editors) AS BIGINT) AS editors
    FROM gold, clock WHERE window_start >= t - INTERVAL 1 HOUR GROUP BY title ORDER BY edits DESC, title LIMIT 20""")
def _(m):
    return checks.page_leaders(m.gold, m.as_of)


@query("q15_layer_totals", """
    SELECT (SELECT count(*) FROM bronze) AS bronze, (SELECT count(*) FROM silver) AS silver,
           (SELECT CAST(sum(edit_count) AS BIGINT) FROM gold) AS gold_events""")
def _(m):
    return checks.layer_totals(m.bronze, m.silver, m.gold)


@query("q16_byte_stats_today", """
    SELECT round(avg(avg_byte_delta), 1) AS overall_avg_delta, max(max_byte_delta) AS largest_single_edit,
           CAST(sum(total_byte_delta) AS BIGINT) AS net_bytes_added
    FROM gold, clock WHERE window_date = CAST(t AS DATE)""")
def _(m):
    return checks.byte_stats_today(m.gold, m.as_of)


@query("q23_pause_counts", """
    SELECT (SELECT count(*) FROM bronze) AS bronze_before, (SELECT count(*) FROM silver) AS silver_before""")
def _(m):
    return checks.pause_counts(m.bronze, m.silver)


@query("q24_minute_continuity", """
    SELECT strftime(time_bucket(INTERVAL 1 MINUTE, ingest_timestamp), '%Y-%m-%d %H:%M:%S') AS minute,
           count(*) AS rows_landed
    FROM bronze, clock WHERE ingest_timestamp >= t - INTERVAL 30 MINUTE GROUP BY 1""")
def _(m):
    return served.rows_per_bucket(m.bronze, m.as_of, 30, 60, "minute", "rows_landed")


@query("q24_bucket_gaps", """
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS bucket_start, count(s.event_id) AS rows_landed
    FROM (SELECT unnest(generate_series(time_bucket(INTERVAL 5 MINUTE, t - INTERVAL 45 MINUTE),
                                        time_bucket(INTERVAL 5 MINUTE, t), INTERVAL 5 MINUTE)) AS w FROM clock)
    LEFT JOIN (SELECT event_id, ingest_timestamp FROM silver, clock
               WHERE ingest_timestamp >= t - INTERVAL 45 MINUTE) s
      ON time_bucket(INTERVAL 5 MINUTE, ingest_timestamp) = w
    GROUP BY w""")
def _(m):
    return checks.bucket_gaps(m.silver, m.as_of)


@query("s9_retention", """
    SELECT date_trunc('hour', ingest_timestamp) AS hour, count(*) AS lines,
           date_trunc('hour', ingest_timestamp) + INTERVAL 1 HOUR <= (SELECT t FROM clock) - INTERVAL 1 DAY AS expired
    FROM bronze GROUP BY 1""")
def _(m):
    return retention_report(m.bronze, m.as_of)


@query("s22_by_title", "SELECT event_id, title, comment, byte_delta FROM silver WHERE title = 'page-7'")
def _(m):
    return by_title(m.silver, "page-7").select("event_id", "title", "comment", "byte_delta")


@query("p7_poison_lines", """
    WITH lines AS (SELECT p.*, mw_id % 10 AS d FROM parsed p)
    SELECT CASE WHEN d IN (0, 2) THEN 'parse_failure' WHEN bot THEN 'bot' WHEN wiki <> 'enwiki' THEN 'non_enwiki'
                WHEN event_type NOT IN ('edit', 'new') THEN 'non_edit_type' WHEN namespace <> 0 THEN 'non_article_namespace'
                ELSE 'accepted' END AS outcome,
           count(*) AS n, count(*) FILTER (WHERE d NOT IN (0, 1, 2) AND byte_delta IS NOT NULL) AS with_size
    FROM lines GROUP BY 1""")
def _(m):
    """One line in ten is cut off, one has sizes whose difference leaves the type, one is NULL: all end somewhere."""
    d = F.substring("event_id", 4, 20).cast("bigint") % 10
    sizes = F.regexp_replace("raw_json", '"length":\\{[^}]*\\}', '"length":{"old":-2147483648,"new":2147483647}')
    line = F.when(d == 0, F.substring("raw_json", 1, 40)).when(d == 1, sizes).when(d == 2, None).otherwise(F.col("raw_json"))
    parsed = parse_events(m.bronze.withColumn("raw_json", line))
    sized = F.count(F.when(F.col("byte_delta").isNotNull(), 1)).alias("with_size")
    kept = quality.accepted(parsed).select(F.lit("accepted").alias("outcome"), "byte_delta")
    lost = quality.rejected(parsed).select(F.col("quarantine_reason").alias("outcome"), "byte_delta")
    return kept.unionByName(lost).groupBy("outcome").agg(F.count("*").alias("n"), sized)
