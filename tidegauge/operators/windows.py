"""Event-time page metrics; the same functions serve batch tables and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalars import count_when
from tidegauge.model.contracts import SLIDE, SLIDING, TUMBLING

PAGE = ("title", "namespace")


def distinct_users(user: str = "user", exact: bool = False, rsd: float = 0.05) -> Column:
    """Editors per group: a fixed-size sketch by default, since exact sets are too large to keep as
    streaming state; ``exact`` is for batch."""
    return F.countDistinct(user) if exact else F.approx_count_distinct(user, rsd)


def _windowed(df: DataFrame, ts: str, width: str, slide: str | None, keys, measures) -> DataFrame:
    grouped = df.groupBy(F.window(ts, width, slide) if slide else F.window(ts, width), *keys)
    return grouped.agg(*measures).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("window.start").cast("date").alias("window_date"),
        "*",
    ).drop("window")


def page_metrics(
    silver: DataFrame,
    width: str = TUMBLING,
    keys: Sequence[str] = PAGE,
    ts: str = "event_timestamp",
    exact: bool = False,
) -> DataFrame:
    """One row per tumbling window and page: volume, editors, byte change, minor edits.

    All measures combine before the shuffle, so a page with a large share of the edits sends one
    row per window and task. Rows without an event time belong to no window.
    """
    delta = F.col("byte_delta")
    return _windowed(
        silver, ts, width, None, keys,
        [
            F.count("*").alias("edit_count"),
            distinct_users(exact=exact).alias("unique_editors"),
            F.sum(delta).alias("total_byte_delta"),
            F.round(F.avg(delta), 1).alias("avg_byte_delta"),
            F.max(delta).alias("max_byte_delta"),
            count_when(F.col("minor")).alias("minor_edit_count"),
        ],
    )


def sliding_page_metrics(
    silver: DataFrame,
    width: str = SLIDING,
    slide: str = SLIDE,
    keys: Sequence[str] = PAGE,
    ts: str = "event_timestamp",
    exact: bool = False,
) -> DataFrame:
    """Overlapping windows: one row per slide step and page, with the three core measures."""
    return _windowed(
        silver, ts, width, slide, keys,
        [
            F.count("*").alias("edit_count"),
            distinct_users(exact=exact).alias("unique_editors"),
            F.sum("byte_delta").alias("total_byte_delta"),
        ],
    )


def event_counts(df: DataFrame, width: str, keys: Sequence[str], ts: str) -> DataFrame:
    """Only the count, for any key: the input of a baseline over something other than pages."""
    return _windowed(df, ts, width, None, keys, [F.count("*").alias("edit_count")])
