"""Vector functions over ``array<float|double>`` columns (P10 and the cosine of R1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vector_narrow(c) -> Column:
    """array<double> -> array<float>; null stays null."""
    return _c(c).cast("array<float>")


def vector_widen(c) -> Column:
    """array<float> -> array<double>; null stays null."""
    return _c(c).cast("array<double>")


def dot(a, b) -> Column:
    a, b = _c(a).cast("array<double>"), _c(b).cast("array<double>")
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def l2_norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine similarity; null when either vector has zero norm (never a hit)."""
    return F.try_divide(dot(a, b), F.nullif(l2_norm(a) * l2_norm(b), F.lit(0.0)))
