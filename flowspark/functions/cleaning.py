"""Column expressions for feature cleaning (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def fcol(name: str) -> Column:
    """Column by its exact name; feature names contain blanks, ``/`` and ``.``."""
    return F.col("`" + name.replace("`", "``") + "`")


def log1p_nonneg(c: Column) -> Column:
    """``log1p(clip(x, lower=0))``.  Null becomes 0 (greatest skips nulls),
    NaN stays NaN and is zeroed by :func:`zero_nonfinite` later."""
    return F.log1p(F.greatest(c, F.lit(0.0)))


def zero_nonfinite(c: Column) -> Column:
    """±Inf, NaN and null -> 0."""
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(INF))
    return F.when(bad, F.lit(0.0)).otherwise(c)


def clip(c: Column, limit: float) -> Column:
    return F.least(F.greatest(c, F.lit(-limit)), F.lit(limit))


def to_float32(c: Column) -> Column:
    return c.cast("float")
