"""Small column expressions: buckets, rates, labels, signed byte text, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display names of page namespaces.
NAMESPACE_LABELS = {0: "article", 1: "talk", 4: "project", 10: "template"}


def bucket_label(ts: Column, seconds: int) -> Column:
    """Start of the ``seconds``-wide bucket holding ``ts``, as text in the session time zone."""
    return F.from_unixtime(F.floor(F.unix_timestamp(ts) / seconds) * seconds)


def bucket_index(ts: Column, seconds: int) -> Column:
    """Number of the ``seconds``-wide bucket holding ``ts`` since the epoch."""
    return F.floor(F.unix_timestamp(ts) / F.lit(seconds))


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is zero."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def count_when(cond: Column) -> Column:
    """Rows where ``cond`` is true; zero, not NULL, on empty input."""
    return F.count_if(cond)


def namespace_label(ns: Column) -> Column:
    label = ns.cast("string")
    for number, name in NAMESPACE_LABELS.items():
        label = F.when(ns == number, name).otherwise(label)
    return label


def signed_bytes(delta: Column) -> Column:
    """``+12``, ``-3`` or ``n/a`` for an unknown size change."""
    return F.when(delta.isNull(), "n/a").otherwise(F.format_string("%+d", delta))


def summary_id(title: Column, window_start: Column) -> Column:
    """Stable key of a summary: md5 of ``title|window_start``."""
    return F.md5(F.concat_ws("|", title, window_start.cast("string")))
