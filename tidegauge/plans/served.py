"""The dashboard queries: producer health, flow health, content and anomalies.

Relative-time filters on tables partitioned by date also carry the date predicate, so the files of
older days are never opened. Every ``LIMIT`` has a full tie-break and plans as a distributed top-k.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.clock import AsOf, ago, from_day, now, since, today
from tidegauge.functions.scalars import bucket_label, namespace_label, pct

BYTES_PER_MB = 1048576.0


def stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def counts_in_one_row(named: dict[str, DataFrame], measure=None) -> DataFrame:
    """One row with the row count (or ``measure``) of each table: the one-row results are stacked
    and folded, which needs no join."""
    rows = [
        df.agg((measure or {}).get(name, F.count("*")).alias("n")).select(F.lit(name).alias("part"), "n")
        for name, df in named.items()
    ]
    pick = lambda name: F.max(F.when(F.col("part") == name, F.col("n"))).alias(name)
    return stacked(rows).agg(*[pick(name) for name in named])


# --- producer health

def ingest_per_hour(bronze: DataFrame, as_of: AsOf = None, hours: int = 24) -> DataFrame:
    """PH-1"""
    recent = since(bronze, "ingest_timestamp", as_of, f"{hours} HOURS", part="ingest_date")
    return recent.groupBy(F.date_trunc("hour", "ingest_timestamp").alias("hour")).agg(
        F.count("*").alias("events_ingested"),
        F.round(F.sum(F.length("raw_json")) / BYTES_PER_MB, 1).alias("mb_ingested"),
    ).orderBy("hour")


def staleness(bronze: DataFrame, as_of: AsOf = None) -> DataFrame:
    """PH-2; the latest event is in the newest day's partition, so only that is read."""
    if "ingest_date" in bronze.columns:
        bronze = bronze.filter(F.col("ingest_date") == bronze.agg(F.max("ingest_date")).scalar())
    return bronze.agg(F.max("ingest_timestamp").alias("latest_event")).withColumn(
        "minutes_stale", F.timestamp_diff("MINUTE", F.col("latest_event"), now(as_of))
    )


def ingest_trend(bronze: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """PH-3"""
    recent = since(bronze, "ingest_timestamp", as_of, f"{days} DAYS", part="ingest_date")
    return recent.groupBy(F.date_trunc("hour", "ingest_timestamp").alias("day_hour")).agg(
        F.count("*").alias("events_ingested")
    ).orderBy("day_hour")


# --- flow health

def layer_snapshot(layers: dict[str, tuple[DataFrame, str]], rows: str = "total_rows", latest: str = "latest_event") -> DataFrame:
    """PL-1: (layer, rows, latest) for each named table and its time column."""
    return stacked(
        [
            df.agg(F.count("*").alias(rows), F.max(ts).alias(latest)).select(F.lit(name).alias("layer"), rows, latest)
            for name, (df, ts) in layers.items()
        ]
    )


def pass_rates(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, as_of: AsOf = None, hours: int = 1) -> DataFrame:
    """PL-2"""
    span = f"{hours} HOURS"
    recent = {
        name: since(df, "ingest_timestamp", as_of, span, part="ingest_date")
        for name, df in (("bronze_1h", bronze), ("silver_1h", silver), ("quarantine_1h", quarantine))
    }
    return counts_in_one_row(recent).withColumns(
        {
            "pass_rate_pct": pct(F.col("silver_1h"), F.col("bronze_1h")),
            "quarantine_rate_pct": pct(F.col("quarantine_1h"), F.col("bronze_1h")),
        }
    )


def shares(df: DataFrame, key: str, count_name: str) -> DataFrame:
    """Rows per value of a low-cardinality column with its share of all rows; the total is taken over
    the grouped result, a handful of rows."""
    grouped = df.groupBy(key).agg(F.count("*").alias(count_name))
    total = F.sum(count_name).over(Window.partitionBy())
    return grouped.withColumn("pct", pct(F.col(count_name), total)).orderBy(F.desc(count_name), key)


def quarantine_breakdown(quarantine: DataFrame, as_of: AsOf = None, hours: int = 1) -> DataFrame:
    """PL-3"""
    recent = since(quarantine, "ingest_timestamp", as_of, f"{hours} HOURS", part="ingest_date")
    return shares(recent, "quarantine_reason", "events")


def rows_per_bucket(
    df: DataFrame, as_of: AsOf = None, minutes: int = 120, seconds: int = 300,
    label: str = "bucket_start", count_name: str = "silver_events", ts: str = "ingest_timestamp",
) -> DataFrame:
    """PL-4, and the continuity checks: rows per fixed-width bucket of the ingest clock."""
    recent = since(df, ts, as_of, f"{minutes} MINUTES", part="ingest_date")
    return recent.groupBy(bucket_label(F.col(ts), seconds).alias(label)).agg(F.count("*").alias(count_name)).orderBy(label)


def _recent_windows(gold: DataFrame, as_of: AsOf, hours: int) -> DataFrame:
    return since(gold, "window_start", as_of, f"{hours} HOURS", part="window_date")


def windows_landing(gold: DataFrame, as_of: AsOf = None, hours: int = 2) -> DataFrame:
    """PL-5"""
    return _recent_windows(gold, as_of, hours).groupBy("window_start").agg(
        F.sum("edit_count").alias("total_edits"), F.countDistinct("title").alias("pages_with_edits")
    ).orderBy("window_start")


# --- content

PAGE_TOTALS = {
    "total_edits": "edit_count", "editors": "unique_editors", "net_bytes": "total_byte_delta",
    "minor_edits": "minor_edit_count",
}


def page_totals(gold: DataFrame, *keys) -> DataFrame:
    """Window rows added up per page; ``editors`` counts an editor once per window, so it is an upper bound."""
    return gold.groupBy(*keys).agg(*[F.sum(src).alias(name) for name, src in PAGE_TOTALS.items()])


def top_pages(gold: DataFrame, as_of: AsOf = None, hours: int = 1, n: int = 20) -> DataFrame:
    """CV-1"""
    return page_totals(_recent_windows(gold, as_of, hours), "title").orderBy(F.desc("total_edits"), "title").limit(n)


def top_pages_by_namespace(gold: DataFrame, as_of: AsOf = None, hours: int = 1, n: int = 20) -> DataFrame:
    """CV-1 with the namespace spelled out"""
    totals = page_totals(_recent_windows(gold, as_of, hours), "title", "namespace")
    return totals.orderBy(F.desc("total_edits"), "title", "namespace").limit(n).withColumn(
        "namespace", namespace_label(F.col("namespace"))
    )


def edit_volume(gold: DataFrame, as_of: AsOf = None, hours: int = 6) -> DataFrame:
    """CV-2"""
    return _recent_windows(gold, as_of, hours).groupBy("window_start").agg(
        F.sum("edit_count").alias("total_edits"),
        F.countDistinct("title").alias("pages_edited"),
        F.sum("total_byte_delta").alias("net_bytes_added"),
    ).orderBy("window_start")


def largest_edits(
    silver: DataFrame, as_of: AsOf = None, hours: int = 1, n: int = 10
) -> DataFrame:
    """CV-3"""
    span = f"{hours} HOURS"
    recent = since(from_day(silver, ago(as_of, span)), "event_timestamp", as_of, span)
    recent = recent.filter(F.col("byte_delta").isNotNull())
    return recent.orderBy(F.abs(F.col("byte_delta").cast("bigint")).desc(), "event_timestamp", "event_id").limit(n).select(
        "title", "user", "event_timestamp", "byte_delta", F.substring("comment", 1, 120).alias("comment_preview")
    )


# --- anomalies

def recent_anomalies(flags: DataFrame, as_of: AsOf = None, hours: int = 2, n: int = 20) -> DataFrame:
    """AN-1"""
    return since(flags, "detected_at", as_of, f"{hours} HOURS").select(
        "title", "window_start", "window_end", "edit_count", "baseline_mean", "baseline_stddev", "z_score",
        "unique_editors", "total_byte_delta", "detected_at",
    ).orderBy(F.desc("z_score"), "title", "window_start").limit(n)


def _today(flags: DataFrame, as_of: AsOf) -> DataFrame:
    return flags.filter(F.col("detected_at") >= today(as_of))


def anomalies_per_hour(flags: DataFrame, as_of: AsOf = None) -> DataFrame:
    """AN-2"""
    return _today(flags, as_of).groupBy(F.date_trunc("hour", "detected_at").alias("hour")).agg(
        F.count("*").alias("anomaly_count"), F.max("z_score").alias("peak_z_score")
    ).orderBy("hour")


def sustained_surges(flags: DataFrame, as_of: AsOf = None, n: int = 15) -> DataFrame:
    """AN-3"""
    return _today(flags, as_of).groupBy("title").agg(
        F.count("*").alias("anomalous_windows"),
        F.max("z_score").alias("peak_z_score"),
        F.max("edit_count").alias("peak_edits"),
        F.min("window_start").alias("first_detected"),
    ).orderBy(F.desc("anomalous_windows"), F.desc("peak_z_score"), "title").limit(n)


def latest_summaries(summaries: DataFrame, as_of: AsOf = None, hours: int = 6, n: int = 20) -> DataFrame:
    """AN-4"""
    return since(summaries, "generated_at", as_of, f"{hours} HOURS").orderBy(
        F.desc("generated_at"), F.desc("z_score"), "title"
    ).limit(n).select("title", "z_score", "edit_count", "summary", "generated_at")


def latest_row(summaries: DataFrame) -> DataFrame:
    """The newest summary, the strongest among equals: what related events are looked up for."""
    return summaries.orderBy(F.desc("generated_at"), F.desc("z_score"), "title").limit(1)
