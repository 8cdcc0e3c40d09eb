"""Validation of a running system: volumes, purity, duplicates, reconciliation, continuity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.clock import AsOf, ago, from_day, now, since, today
from tidegauge.functions.percentiles import exact_percentiles
from tidegauge.functions.scalars import bucket_index, count_when, pct
from tidegauge.plans.served import counts_in_one_row, shares


def volume(silver: DataFrame, bronze: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Q1"""
    return counts_in_one_row({"silver_rows": silver, "bronze_rows": bronze, "quarantine_rows": quarantine})


def quarantine_shares(quarantine: DataFrame) -> DataFrame:
    """Q2"""
    return shares(quarantine, "quarantine_reason", "cnt")


def purity(silver: DataFrame, *columns: str) -> DataFrame:
    """Q3: the distinct combinations present; silver must show one bot/wiki pair."""
    return silver.select(*columns).distinct()


def repeated_ids(silver: DataFrame, n: int | None = 10) -> DataFrame:
    """Q4: ids that occur more than once."""
    found = silver.groupBy("event_id").agg(F.count("*").alias("dupes")).filter("dupes > 1")
    return found if n is None else found.orderBy(F.desc("dupes"), "event_id").limit(n)


def repeated_id_count(silver: DataFrame) -> DataFrame:
    """Q4 as one number."""
    return repeated_ids(silver, None).agg(F.count("*").alias("duplicate_event_ids"))


def byte_delta_profile(silver: DataFrame) -> DataFrame:
    """Q5: spread of the size changes with exact median and 95th percentile.

    The simple measures and the percentiles are two one-row results, stacked and folded.
    """
    simple = silver.agg(
        F.min("byte_delta").cast("double").alias("min_delta"),
        F.max("byte_delta").cast("double").alias("max_delta"),
        F.round(F.avg("byte_delta"), 1).alias("avg_delta"),
        count_when(F.col("byte_delta").isNull()).alias("null_delta_rows"),
    )
    mid = exact_percentiles(silver, "byte_delta", {"p50_delta": 0.5, "p95_delta": 0.95})
    both = simple.unionByName(mid, allowMissingColumns=True)
    out = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return out.select(
        F.col("min_delta").cast("int").alias("min_delta"), F.col("max_delta").cast("int").alias("max_delta"),
        "avg_delta", "p50_delta", "p95_delta", "null_delta_rows",
    )


def busiest_pages(
    silver: DataFrame, as_of: AsOf = None, hours: int = 1, n: int = 10
) -> DataFrame:
    """Q6: with exact editors."""
    span = f"{hours} HOURS"
    recent = since(from_day(silver, ago(as_of, span)), "event_timestamp", as_of, span)
    return recent.groupBy("title").agg(
        F.count("*").alias("edits"), F.countDistinct("user").alias("unique_editors")
    ).orderBy(F.desc("edits"), "title").limit(n)


def reconcile(
    silver: DataFrame, gold: DataFrame, as_of: AsOf = None, hours: int | None = 2, settle_minutes: int = 15,
    seconds: int = 300,
) -> DataFrame:
    """Q8: silver aggregated again against gold, over windows old enough to be closed; differences must be 0.

    ``hours=None`` compares the whole history.
    """
    def span(df: DataFrame, ts: str, part: str | None = None) -> DataFrame:
        if hours is None:
            return df.filter(F.col(ts) < ago(as_of, f"{settle_minutes} MINUTES"))
        return since(df, ts, as_of, f"{hours} HOURS", until=f"{settle_minutes} MINUTES", part=part)

    slot = lambda ts: bucket_index(F.col(ts), seconds).alias("slot")
    if hours is not None:
        silver = from_day(silver, ago(as_of, f"{hours} HOURS"))
    again = span(silver, "event_timestamp").groupBy("title", "namespace", slot("event_timestamp")).agg(
        F.count("*").alias("s_edits"), F.sum("byte_delta").alias("s_bytes")
    )
    stored = span(gold, "window_start", "window_date").select(
        "title", "namespace", slot("window_start"), F.col("edit_count").alias("g_edits"),
        F.col("total_byte_delta").alias("g_bytes"),
    )
    edits = F.abs(F.col("s_edits") - F.col("g_edits"))
    zero = F.lit(0)
    bytes_ = F.abs(F.coalesce("s_bytes", zero) - F.coalesce("g_bytes", zero))
    return again.join(stored, ["title", "namespace", "slot"]).agg(
        F.count("*").alias("windows_compared"),
        F.sum(edits).alias("total_edit_count_diff"),
        F.sum(bytes_).alias("total_byte_diff"),
        F.max(edits).alias("max_edit_count_diff"),
    )


def bronze_coverage(bronze: DataFrame) -> DataFrame:
    """Q9"""
    return bronze.agg(
        F.count("*").alias("total_rows"),
        count_when(F.col("event_id").isNull()).alias("null_event_ids"),
        count_when(F.col("raw_json").isNull()).alias("null_raw_json"),
    )


def silver_share(silver: DataFrame, bronze: DataFrame) -> DataFrame:
    """Q11"""
    both = counts_in_one_row({"silver": silver, "bronze": bronze})
    return both.select(pct(F.col("silver"), F.col("bronze")).alias("silver_pct_of_bronze"))


def latest_windows(gold: DataFrame, n: int = 5, pages: str = "pages") -> DataFrame:
    """Q12: the newest closed windows. A day's partition has one window at least, so the ``n`` newest days have them all."""
    if "window_date" in gold.columns:
        days = gold.select("window_date").distinct().orderBy(F.desc("window_date")).limit(n)
        gold = gold.filter(F.col("window_date") >= days.agg(F.min("window_date")).scalar())
    return gold.groupBy("window_start", "window_end").agg(
        F.count("*").alias(pages), F.sum("edit_count").alias("total_edits")
    ).orderBy(F.desc("window_start")).limit(n)


def layer_totals(bronze: DataFrame, silver: DataFrame, gold: DataFrame, quarantine: DataFrame | None = None) -> DataFrame:
    """Q15: rows of each layer, and the events gold has counted."""
    named = {"bronze": bronze, "silver": silver}
    if quarantine is not None:
        named["quarantine"] = quarantine
    named["gold_events"] = gold
    return counts_in_one_row(named, {"gold_events": F.sum("edit_count")})


def consistency(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, gold: DataFrame) -> DataFrame:
    """Q13"""
    c = F.col
    return layer_totals(bronze, silver, gold, quarantine).select(
        "bronze", "silver", "quarantine",
        (c("bronze") - c("silver") - c("quarantine")).alias("unaccounted"),
        pct(c("silver"), c("bronze")).alias("silver_pct"),
        pct(c("quarantine"), c("bronze")).alias("quarantine_pct"),
        "gold_events",
        pct(c("gold_events"), c("silver")).alias("gold_coverage_pct"),
    )


def page_leaders(gold: DataFrame, as_of: AsOf = None, hours: int = 1, n: int = 20) -> DataFrame:
    """Q14"""
    return since(gold, "window_start", as_of, f"{hours} HOURS", part="window_date").groupBy("title").agg(
        F.sum("edit_count").alias("edits"), F.sum("unique_editors").alias("editors")
    ).orderBy(F.desc("edits"), "title").limit(n)


def byte_stats_today(gold: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Q16"""
    return gold.filter(F.col("window_date") == today(as_of)).agg(
        F.round(F.avg("avg_byte_delta"), 1).alias("overall_avg_delta"),
        F.max("max_byte_delta").alias("largest_single_edit"),
        F.sum("total_byte_delta").alias("net_bytes_added"),
    )


def anomalies_since(flags: DataFrame, as_of: AsOf = None, hours: int = 2) -> DataFrame:
    """Q17"""
    return since(flags, "detected_at", as_of, f"{hours} HOURS").select(
        "title", "window_start", "edit_count", "baseline_mean", "baseline_stddev", "z_score", "detected_at"
    ).orderBy(F.desc("z_score"), "title", "window_start")


def persistent_surges(flags: DataFrame, as_of: AsOf = None, n: int = 20) -> DataFrame:
    """Q18"""
    return flags.filter(F.col("detected_at") >= today(as_of)).groupBy("title").agg(
        F.count("*").alias("anomalous_windows"), F.max("z_score").alias("peak_z_score"),
        F.max("edit_count").alias("peak_edits"),
    ).orderBy(F.desc("anomalous_windows"), F.desc("peak_z_score"), "title").limit(n)


def unsummarized(flags: DataFrame) -> DataFrame:
    """Q19"""
    return flags.filter(~F.col("summarized")).orderBy(F.desc("z_score"), "title", "window_start")


def newest_summaries(summaries: DataFrame, n: int = 20) -> DataFrame:
    """Q20"""
    return summaries.orderBy(F.desc("generated_at"), F.desc("z_score"), "title").limit(n).select(
        "title", "z_score", "edit_count", "searches_used", "summary", "generated_at"
    )


def search_usage(summaries: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Q21"""
    return summaries.filter(F.col("generated_at") >= today(as_of)).agg(
        F.sum("searches_used").alias("total_searches"),
        F.count("*").alias("pages_summarized"),
        F.round(F.avg("searches_used"), 2).alias("avg_searches_per_page"),
        count_when(F.col("searches_used") > 0).alias("pages_that_searched"),
    )


def stuck_flags(flags: DataFrame, as_of: AsOf = None, hours: int = 1) -> DataFrame:
    """Q22"""
    old = F.col("detected_at") < ago(as_of, f"{hours} HOURS")
    return flags.filter(~F.col("summarized") & old).agg(F.count("*").alias("stuck"))


def pause_counts(bronze: DataFrame, silver: DataFrame, suffix: str = "before") -> DataFrame:
    """Q23, Q25"""
    return counts_in_one_row({f"bronze_{suffix}": bronze, f"silver_{suffix}": silver})


def bucket_gaps(df: DataFrame, as_of: AsOf = None, minutes: int = 45, seconds: int = 300, ts: str = "ingest_timestamp") -> DataFrame:
    """Q24: every bucket of the last minutes with its row count, zero where nothing came.

    The expected buckets are generated (``minutes * 60 / seconds`` of them) and the counted ones
    joined on, so silence shows as rows rather than as their absence.
    """
    recent = since(df, ts, as_of, f"{minutes} MINUTES", part="ingest_date")
    counted = recent.groupBy(bucket_index(F.col(ts), seconds).alias("slot")).agg(F.count("*").alias("n"))
    last = bucket_index(F.col("at"), seconds)
    first = bucket_index(F.col("at") - F.expr(f"INTERVAL {minutes} MINUTES"), seconds)
    expected = df.sparkSession.range(1).select(now(as_of).alias("at")).select(F.explode(F.sequence(first, last)).alias("slot"))
    return expected.join(counted, "slot", "left").select(
        F.from_unixtime(F.col("slot") * seconds).alias("bucket_start"), F.coalesce("n", F.lit(0)).alias("rows_landed")
    )


def baseline_coverage(baseline: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Q26"""
    return baseline.filter(F.col("baseline_date") == today(as_of)).agg(
        F.count("*").alias("pages"), F.min("window_count").alias("min_windows"),
        F.max("window_count").alias("max_windows"),
    )
