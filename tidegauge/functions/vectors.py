"""Vector arithmetic on array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _vector(v: Column | Sequence[float]) -> Column:
    return (v if isinstance(v, Column) else F.lit([float(x) for x in v])).cast("array<double>")


def dot(a: Column | Sequence[float], b: Column | Sequence[float]) -> Column:
    return F.aggregate(
        F.zip_with(_vector(a), _vector(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x
    )


def norm(a: Column | Sequence[float]) -> Column:
    return F.sqrt(F.aggregate(_vector(a), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column | Sequence[float], b: Column | Sequence[float]) -> Column:
    """Cosine similarity; NULL when either vector has no length."""
    size = norm(a) * norm(b)
    return dot(a, b) / F.when(size > 0, size)
