"""One-minute panes per page, from which any longer window is merged.

A pane holds the measures of a minute in a form that can be merged: counts, sums, a maximum, and a sketch of the editors. An
event is aggregated once, into its pane; sliding, tumbling and whole-day windows then combine panes, so an event is not
copied into each window it belongs to, and editors are counted once per window however many panes they edited in. Where the
count has to be exact, a pane holds the editors themselves in place of the sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.clock import AsOf, since
from tidegauge.functions.scalars import count_when
from tidegauge.operators.windows import PAGE

PANE = "1 minute"
PANE_SECONDS = 60
#: log2 of a sketch's slots: about 1.6 % error at 4,096, and exact or nearly so for some hundred editors.
SKETCH = 12
EDITORS = "editors"
MEASURES = ("edit_count", "editors_sketch", "byte_windows", "total_byte_delta", "max_byte_delta", "minor_edit_count")


def page_panes(
    silver: DataFrame, keys: Sequence[str] = PAGE, ts: str = "event_timestamp", user: str = "user", exact: bool = False
) -> DataFrame:
    """One row per minute and page, for tables and streams. Rows without an event time belong to no pane. ``exact`` panes
    have the minute's ``editors``, others a sketch of them."""
    delta = F.col("byte_delta")
    editors = F.collect_set(user).alias(EDITORS) if exact else F.hll_sketch_agg(user, SKETCH).alias("editors_sketch")
    grouped = silver.groupBy(F.window(ts, PANE), *keys).agg(
        F.count("*").alias("edit_count"), editors,
        F.count(delta).alias("byte_windows"), F.sum(delta).alias("total_byte_delta"),
        F.max(delta).alias("max_byte_delta"), count_when(F.col("minor")).alias("minor_edit_count"),
    )
    return grouped.select(
        F.col("window.start").alias("pane_start"), F.col("window.start").cast("date").alias("pane_date"), *keys,
        *[EDITORS if exact and c == "editors_sketch" else c for c in MEASURES],
    )


def _merge(panes: DataFrame, *keys: str) -> DataFrame:
    """``panes`` merged by ``keys``. Editors of exact panes become rows beside the panes, so no group holds them all."""
    if EDITORS not in panes.columns:
        estimate = F.hll_sketch_estimate(F.hll_union_agg("editors_sketch"))
        return panes.groupBy(*keys).agg(*_merged(F.coalesce(estimate, F.lit(0))))
    one = panes.select(*keys, F.explode(EDITORS).alias("editor__"))
    both = panes.drop(EDITORS).unionByName(one, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*_merged(F.count_distinct("editor__")))


def _merged(editors: Column) -> list[Column]:
    total, n = F.sum("total_byte_delta"), F.sum("byte_windows")
    return [
        F.sum("edit_count").alias("edit_count"), editors.alias("unique_editors"),
        total.alias("total_byte_delta"), F.round(total / F.nullif(n, F.lit(0)), 1).alias("avg_byte_delta"),
        F.max("max_byte_delta").alias("max_byte_delta"), F.sum("minor_edit_count").alias("minor_edit_count"),
    ]


def windows_of_panes(
    panes: DataFrame, minutes: int, slide_minutes: int | None = None, keys: Sequence[str] = PAGE
) -> DataFrame:
    """Windows of ``minutes``, every ``slide_minutes`` (tumbling, if none are given), merged from ``panes``: the columns of
    the page metrics, with distinct editors of the window."""
    slide = slide_minutes or minutes
    if minutes % slide or minutes < 1:
        raise ValueError("a window is a whole number of slides, and a slide of minutes")
    width, step = minutes * PANE_SECONDS, slide * PANE_SECONDS
    at = F.unix_timestamp(F.col("pane_start").cast("timestamp"))
    last = at - F.pmod(at, F.lit(step))
    starts = F.sequence(last - F.lit(width - step), last, F.lit(step)) if minutes > slide else F.array(last)
    spread = panes.withColumn("start__", F.explode(starts))
    kind = panes.schema["pane_start"].dataType.simpleString()
    time = lambda c: F.timestamp_seconds(c).cast(kind)
    merged = _merge(spread, "start__", *keys)
    return merged.select(
        time(F.col("start__")).alias("window_start"), time(F.col("start__") + width).alias("window_end"),
        time(F.col("start__")).cast("date").alias("window_date"), *[c for c in merged.columns if c != "start__"],
    )


def page_activity(
    panes: DataFrame, as_of: AsOf = None, span: str = "1 HOUR", n: int | None = 20, keys: Sequence[str] = ("title",)
) -> DataFrame:
    """Pages by edits over ``span`` (all of them, if ``n`` is none), with the distinct editors of the whole span: unlike a
    sum over windows, somebody who edits in many windows counts once."""
    recent = since(panes, "pane_start", as_of, span, part="pane_date")
    found = _merge(recent, *keys)
    return found if n is None else found.orderBy(F.desc("edit_count"), *keys).limit(n)
