"""Alert conditions over one-value query results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.clock import AsOf, since

OPERATORS = {
    "EQUAL": lambda v, t: v == t,
    "NOT_EQUAL": lambda v, t: v != t,
    "GREATER_THAN": lambda v, t: v > t,
    "GREATER_THAN_OR_EQUAL": lambda v, t: v >= t,
    "LESS_THAN": lambda v, t: v < t,
    "LESS_THAN_OR_EQUAL": lambda v, t: v <= t,
}


def silver_gap(silver: DataFrame, as_of: AsOf = None, minutes: int = 15) -> DataFrame:
    """Silver rows of the last minutes; zero means the stream has stalled."""
    recent = since(silver, "ingest_timestamp", as_of, f"{minutes} MINUTES", part="ingest_date")
    return recent.agg(F.count("*").alias("silver_events_15min"))


def new_anomalies(flags: DataFrame, as_of: AsOf = None, minutes: int = 15) -> DataFrame:
    """Fresh flags still waiting for a summary."""
    recent = since(flags, "detected_at", as_of, f"{minutes} MINUTES").filter(~F.col("summarized"))
    return recent.agg(F.count("*").alias("new_anomalies"))


def evaluate(
    result: DataFrame, name: str, operator: str, threshold: float, empty_state: str = "ERROR"
) -> DataFrame:
    """(name, value, state): TRIGGERED or OK by the first column of a one-row result, ``empty_state``
    when the query returned no row or no value."""
    value = F.max(F.col(result.columns[0])).cast("double")
    met = OPERATORS[operator](F.col("value"), F.lit(float(threshold)))
    state = F.when(F.col("value").isNull(), empty_state).when(met, "TRIGGERED").otherwise("OK")
    return result.agg(value.alias("value")).select(F.lit(name).alias("name"), "value", state.alias("state"))
