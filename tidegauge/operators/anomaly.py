"""Windows far above their key's baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.clock import AsOf, ago, now, since
from tidegauge.model.contracts import LOOKBACK_MINUTES, MIN_EDITS, Z_THRESHOLD
from tidegauge.operators.baseline import baseline_of
from tidegauge.operators.windows import PAGE

FLAG_KEY = ("title", "window_start")


def z_score(x: Column, mean: Column, sd: Column, digits: int | None = 2) -> Column:
    """Distance from the mean in deviations; NULL when the deviation is unknown or zero."""
    z = (x - mean) / F.when(sd > 0, sd)
    return z if digits is None else F.round(z, digits)


def scored(windows: DataFrame, baseline: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Windows with their key's baseline; keys without one are left out.

    No join hint: the baseline grows with the number of pages, so its size is left for Catalyst and
    AQE to judge. A key has one row per window on one side and one row on the other, so no key can
    dominate the join however many events it had.
    """
    side = baseline.select(*keys, "mean_edit_count", "stddev_edit_count")
    return windows.join(side, list(keys)).withColumn(
        "z_score", z_score(F.col("edit_count"), F.col("mean_edit_count"), F.col("stddev_edit_count"))
    )


def surges(
    windows: DataFrame,
    baseline: DataFrame,
    keys: Sequence[str] = PAGE,
    z_threshold: float = Z_THRESHOLD,
    min_edits: int = MIN_EDITS,
) -> DataFrame:
    """Windows whose rounded z-score reaches the threshold. Small windows are dropped before the join."""
    busy = windows.filter(F.col("edit_count") >= min_edits)
    return (
        scored(busy, baseline, keys)
        .filter(F.col("z_score") >= z_threshold)
        .withColumn("baseline_mean", F.round("mean_edit_count", 2))
        .withColumn("baseline_stddev", F.round("stddev_edit_count", 2))
    )


def unflagged(candidates: DataFrame, flags: DataFrame | None, key: Sequence[str] = FLAG_KEY) -> DataFrame:
    """Candidates not flagged before. The default key has no namespace, so a title flagged in one
    namespace is also suppressed in the others for that window."""
    if flags is None:
        return candidates
    return candidates.join(flags.select(*key), list(key), "left_anti")


def detect_anomalies(
    gold: DataFrame,
    baseline: DataFrame,
    flags: DataFrame | None = None,
    as_of: AsOf = None,
    z_threshold: float = Z_THRESHOLD,
    min_edits: int = MIN_EDITS,
    lookback_minutes: int = LOOKBACK_MINUTES,
    flag_key: Sequence[str] = FLAG_KEY,
) -> DataFrame:
    """New flags of one run: recent closed windows against yesterday's baseline, minus known flags.

    Both the windows and the known flags are cut to the lookback before they are joined, so a run
    costs the same however long the history is.
    """
    span = f"{lookback_minutes} MINUTES"
    recent = since(gold, "window_start", as_of, span, part="window_date" if "window_date" in gold.columns else None)
    hits = surges(recent, baseline_of(baseline, as_of), z_threshold=z_threshold, min_edits=min_edits)
    known = None if flags is None else flags.filter(F.col("window_start") >= ago(as_of, span))
    return unflagged(as_flags(hits, as_of), known, flag_key).select(*FLAG_COLUMNS)


# Column order of the flags table.
FLAG_COLUMNS = (
    "title", "namespace", "window_start", "window_end", "edit_count", "unique_editors",
    "total_byte_delta", "baseline_mean", "baseline_stddev", "z_score", "detected_at", "summarized",
)


def as_flags(hits: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Surges as rows of the flags table, pending a summary."""
    return hits.withColumn("detected_at", now(as_of)).withColumn("summarized", F.lit(False)).select(*FLAG_COLUMNS)


def surge_preview(
    gold: DataFrame,
    baseline: DataFrame,
    as_of: AsOf = None,
    z_threshold: float = Z_THRESHOLD,
    hours: int = 1,
    n: int = 20,
) -> DataFrame:
    """What is above the threshold right now: the unrounded score, strictly above, no minimum count."""
    recent = since(gold, "window_start", as_of, f"{hours} HOURS", part="window_date" if "window_date" in gold.columns else None)
    exact = z_score(F.col("edit_count"), F.col("mean_edit_count"), F.col("stddev_edit_count"), None)
    return (
        scored(recent, baseline_of(baseline, as_of))
        .filter(exact > z_threshold)
        .select(
            "title", "namespace", "window_start", "edit_count",
            F.round("mean_edit_count", 1).alias("baseline_mean"),
            F.round("stddev_edit_count", 1).alias("baseline_stddev"),
            "z_score",
        )
        .orderBy(F.desc("z_score"), "title", "namespace", "window_start")
        .limit(n)
    )


def flags_written(flags: DataFrame, as_of: AsOf = None, minutes: int = 2) -> DataFrame:
    """The rows a run has just appended, read back by their detection time, strongest first."""
    return since(flags, "detected_at", as_of, f"{minutes} MINUTES").orderBy(
        F.desc("z_score"), "title", "namespace", "window_start"
    )
