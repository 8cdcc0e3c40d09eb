"""Input and table schemas (as DDL text) and the default constants of every operator."""

from __future__ import annotations

# --- Fixed values: the public shape of one raw change event. log_params has no stable type and
# --- is therefore left out; it is read separately as text.
RAW_EVENT_DDL = """
    schema STRING,
    meta STRUCT<uri: STRING, request_id: STRING, id: STRING, dt: STRING, domain: STRING,
                stream: STRING, topic: STRING, partition: INT, offset: BIGINT>,
    id BIGINT, type STRING, namespace INT, title STRING, title_url STRING,
    comment STRING, parsedcomment STRING, timestamp BIGINT, user STRING,
    bot BOOLEAN, minor BOOLEAN, patrolled BOOLEAN,
    notify_url STRING, server_url STRING, server_name STRING, server_script_path STRING,
    wiki STRING,
    length STRUCT<old: INT, new: INT>,
    revision STRUCT<old: BIGINT, new: BIGINT>,
    log_id BIGINT, log_type STRING, log_action STRING, log_action_comment STRING
"""

# --- Fixed values: table columns.
BRONZE_DDL = (
    "raw_json STRING, ingest_timestamp TIMESTAMP, source_file STRING, event_id STRING, ingest_date DATE"
)
PARSED_DDL = (
    "event_id STRING, mw_id BIGINT, event_type STRING, wiki STRING, namespace INT, title STRING, "
    "title_url STRING, server_name STRING, server_url STRING, user STRING, bot BOOLEAN, minor BOOLEAN, "
    "patrolled BOOLEAN, event_timestamp TIMESTAMP, event_dt STRING, comment STRING, parsedcomment STRING, "
    "length_old INT, length_new INT, byte_delta INT, revision_old BIGINT, revision_new BIGINT, "
    "log_id BIGINT, log_type STRING, log_action STRING, log_params STRING, log_action_comment STRING, "
    "ingest_timestamp TIMESTAMP, ingest_date DATE, source_file STRING"
)
SILVER_DDL = PARSED_DDL + ", event_date DATE"
QUARANTINE_DDL = PARSED_DDL + ", quarantine_reason STRING"
GOLD_DDL = (
    "window_start TIMESTAMP, window_end TIMESTAMP, window_date DATE, title STRING, namespace INT, "
    "edit_count BIGINT, unique_editors BIGINT, total_byte_delta BIGINT, avg_byte_delta DOUBLE, "
    "max_byte_delta INT, minor_edit_count BIGINT"
)
PANES_DDL = (
    "pane_start TIMESTAMP, pane_date DATE, title STRING, namespace INT, edit_count BIGINT, editors_sketch BINARY, "
    "byte_windows BIGINT, total_byte_delta BIGINT, max_byte_delta INT, minor_edit_count BIGINT"
)
BASELINE_DDL = (
    "title STRING, namespace INT, window_count BIGINT, mean_edit_count DOUBLE, stddev_edit_count DOUBLE, "
    "mean_unique_editors DOUBLE, mean_total_byte_delta DOUBLE, data_from TIMESTAMP, data_through TIMESTAMP, "
    "baseline_date DATE, computed_at TIMESTAMP, lookback_days INT"
)
MOMENTS_DDL = (
    "title STRING, namespace INT, window_date DATE, window_count BIGINT, mean_edit_count DOUBLE, "
    "squared_deviations DOUBLE, editor_windows BIGINT, editors BIGINT, delta_windows BIGINT, byte_delta BIGINT, "
    "data_from TIMESTAMP, data_through TIMESTAMP"
)
FLAGS_DDL = (
    "title STRING, namespace INT, window_start TIMESTAMP, window_end TIMESTAMP, edit_count BIGINT, "
    "unique_editors BIGINT, total_byte_delta BIGINT, baseline_mean DOUBLE, baseline_stddev DOUBLE, "
    "z_score DOUBLE, detected_at TIMESTAMP, summarized BOOLEAN"
)
SUMMARIES_DDL = (
    "title STRING, window_start TIMESTAMP, z_score DOUBLE, edit_count BIGINT, summary STRING, "
    "searches_used BIGINT, model_used STRING, generated_at TIMESTAMP, id STRING"
)
FREQUENCIES_DDL = "slot INT, texts BIGINT"
METRICS_DDL = (
    "flow STRING, batch_id BIGINT, expectation STRING, kind STRING, passed BIGINT, failed BIGINT, at TIMESTAMP"
)

# --- Fixed values: table names of the medallion layout.
BRONZE = "bronze_recentchange_raw"
SILVER = "silver_recentchange_enwiki"
QUARANTINE = "silver_recentchange_quarantine"
GOLD_5MIN = "gold_page_edits_5min"
GOLD_15MIN = "gold_page_edits_15min"
PANES = "gold_page_edits_panes"
BASELINE = "gold_page_edits_baseline"
MOMENTS = "gold_page_edits_daily_moments"
FLAGS = "gold_anomaly_flags"
SUMMARIES = "gold_anomaly_summaries"
INDEX = "gold_anomaly_summaries_index"
FREQUENCIES = "gold_anomaly_index_frequencies"
METRICS = "expectation_metrics"

# --- Fixed values: default constants.
WATERMARK = "10 minutes"
TUMBLING = "5 minutes"
SLIDING, SLIDE = "15 minutes", "1 minute"
LOOKBACK_DAYS = 30
MIN_WINDOWS = 10
Z_THRESHOLD = 3.0
MIN_EDITS = 3
LOOKBACK_MINUTES = 60
MAX_PAGES_PER_RUN = 20
MAX_COMMENTS = 25
COOLDOWN_MINUTES = 0
NOVELTY_THRESHOLD = 0.75
SETTLE_MINUTES = 30
RETENTION_DAYS = 1
FLUSH_SECONDS = 60
