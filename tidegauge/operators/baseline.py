"""What is normal for each key: rolling statistics over its windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.clock import AsOf, now, since, today
from tidegauge.model.contracts import LOOKBACK_DAYS, MIN_WINDOWS
from tidegauge.operators.windows import PAGE


def baseline_stats(windows: DataFrame, keys: Sequence[str] = PAGE, min_windows: int = MIN_WINDOWS) -> DataFrame:
    """Count, mean and sample deviation per key; keys with too few windows are left out.

    Windows in which a key saw nothing do not exist as rows, so the mean is conditional on activity.
    """
    measures = [
        F.count("*").alias("window_count"),
        F.avg("edit_count").alias("mean_edit_count"),
        F.stddev_samp("edit_count").alias("stddev_edit_count"),
    ]
    for extra in ("unique_editors", "total_byte_delta"):
        if extra in windows.columns:
            measures.append(F.avg(extra).alias(f"mean_{extra}"))
    measures += [F.min("window_start").alias("data_from"), F.max("window_start").alias("data_through")]
    return windows.groupBy(*keys).agg(*measures).filter(F.col("window_count") >= min_windows)


def rolling_baseline(
    gold: DataFrame,
    as_of: AsOf = None,
    lookback_days: int = LOOKBACK_DAYS,
    min_windows: int = MIN_WINDOWS,
    keys: Sequence[str] = PAGE,
) -> DataFrame:
    """The baseline table of one day, over the last ``lookback_days`` of windows."""
    part = "window_date" if "window_date" in gold.columns else None
    recent = since(gold, "window_start", as_of, f"{lookback_days} DAYS", part=part)
    return (
        baseline_stats(recent, keys, min_windows)
        .withColumn("baseline_date", today(as_of))
        .withColumn("computed_at", now(as_of))
        .withColumn("lookback_days", F.lit(lookback_days))
    )


def daily_moments(windows: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """What a day of windows (with ``window_date``) adds to the baseline of each key: counts, mean, sum of squared
    deviations from it, sums, first and last window. Days are merged by :func:`merged_baseline`."""
    return windows.groupBy(*keys, "window_date").agg(
        F.count("*").alias("window_count"), F.avg("edit_count").alias("mean_edit_count"),
        (F.var_pop("edit_count") * F.count("edit_count")).alias("squared_deviations"),
        F.count("unique_editors").alias("editor_windows"), F.sum("unique_editors").alias("editors"),
        F.count("total_byte_delta").alias("delta_windows"), F.sum("total_byte_delta").alias("byte_delta"),
        F.min("window_start").alias("data_from"), F.max("window_start").alias("data_through"),
    )


def merged_baseline(moments: DataFrame, keys: Sequence[str] = PAGE, min_windows: int = MIN_WINDOWS) -> DataFrame:
    """:func:`baseline_stats` of all windows behind ``moments`` (:func:`daily_moments`).

    Means and squared deviations of two parts are merged by the distance of the means, which keeps its digits where sums
    of squares lose them. A key has one row per day, so what is gathered for it is bounded by the days looked back."""
    day = F.struct(
        F.col("window_date").alias("day"), F.col("window_count").cast("double").alias("n"),
        F.col("mean_edit_count").alias("mean"), F.col("squared_deviations").alias("m2"),
    )
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a, b):
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
        )

    merged = moments.groupBy(*keys).agg(
        F.sum("window_count").alias("window_count"),
        F.aggregate(F.array_sort(F.collect_list(day)), zero, add).alias("all"),
        (F.sum("editors") / F.sum("editor_windows")).alias("mean_unique_editors"),
        (F.sum("byte_delta") / F.nullif(F.sum("delta_windows"), F.lit(0))).alias("mean_total_byte_delta"),
        F.min("data_from").alias("data_from"), F.max("data_through").alias("data_through"),
    )
    spread = F.when(F.col("window_count") > 1, F.sqrt(F.col("all.m2") / (F.col("window_count") - 1)))
    return merged.filter(F.col("window_count") >= min_windows).select(
        *keys, "window_count", F.col("all.mean").alias("mean_edit_count"), spread.alias("stddev_edit_count"),
        "mean_unique_editors", "mean_total_byte_delta", "data_from", "data_through",
    )


def incremental_baseline(
    gold: DataFrame,
    moments: DataFrame,
    days: Sequence[date],
    as_of: datetime,
    lookback_days: int = LOOKBACK_DAYS,
    min_windows: int = MIN_WINDOWS,
    keys: Sequence[str] = PAGE,
) -> DataFrame:
    """:func:`rolling_baseline`, from stored moments where a whole day within the lookback has them (``days``), and from
    the windows themselves for the rest: the day the lookback begins in, and days not settled yet. Only these days'
    partitions of ``gold`` are read."""
    low = as_of - timedelta(days=lookback_days)
    whole = [d for d in days if low.date() < d]
    rest = since(gold, "window_start", as_of, f"{lookback_days} DAYS", part="window_date")
    if whole:
        rest = rest.filter(~F.col("window_date").isin(whole))
        stored = moments.filter(F.col("window_date").isin(whole))
        parts = stored.unionByName(daily_moments(rest, keys).select(*stored.columns))
    else:
        parts = daily_moments(rest, keys)
    return (
        merged_baseline(parts, keys, min_windows)
        .withColumn("baseline_date", today(as_of))
        .withColumn("computed_at", now(as_of))
        .withColumn("lookback_days", F.lit(lookback_days))
    )


def baseline_of(baseline: DataFrame, as_of: AsOf = None, days_back: int = 1) -> DataFrame:
    """The partition a detector compares with: by default the one of the day before ``as_of``."""
    return baseline.filter(F.col("baseline_date") == F.date_sub(today(as_of), days_back))


def baseline_written(baseline: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Number of keys in the partition of ``as_of``'s date, read back from the table."""
    return baseline_of(baseline, as_of, 0).agg(F.count("*").alias("pages_written"))
