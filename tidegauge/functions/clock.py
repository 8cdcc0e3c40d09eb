"""Explicit 'now': every relative-time operator takes an ``as_of`` instead of reading the wall clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = Column | datetime | str | None


def now(as_of: AsOf = None) -> Column:
    """``as_of`` as a column: a literal, a given column (e.g. a scalar subquery) or the wall clock."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp")
    return F.lit(as_of)


def ago(as_of: AsOf, span: str) -> Column:
    """``as_of`` minus an interval such as ``'60 MINUTES'``."""
    return now(as_of) - F.expr(f"INTERVAL {span}")


def today(as_of: AsOf = None) -> Column:
    return now(as_of).cast("date")


def since(
    df: DataFrame, ts: str, as_of: AsOf, span: str, until: str | None = None, part: str | None = None
) -> DataFrame:
    """Rows with ``as_of - span <= ts`` (and ``ts < as_of - until``).

    ``part`` names a partition column holding the date of ``ts``; the matching date predicate is
    added so that whole partitions are pruned rather than read and filtered.
    """
    low = ago(as_of, span)
    df = df.filter(F.col(ts) >= low)
    if until is not None:
        df = df.filter(F.col(ts) < ago(as_of, until))
    if part is not None:
        df = df.filter(F.col(part) >= low.cast("date"))
    return df


def from_day(df: DataFrame, low: Column, part: str = "event_date") -> DataFrame:
    """Only the date partitions that can hold events from ``low`` on; exact, since the date is that of the event.
    A table without the column is returned as it is."""
    return df.filter(F.col(part) >= low.cast("date")) if part in df.columns else df
