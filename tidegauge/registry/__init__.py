"""Every operator as a query over the given test tables, each with its SQL counterpart where one exists."""

from tidegauge.registry import anomalies, content, streams, tables, vectors  # noqa: F401
from tidegauge.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
