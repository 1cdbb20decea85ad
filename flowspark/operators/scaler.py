"""Robust scaler: fit (A3), summary (A4), apply.

Fit: exact linear-interpolated quartiles (= DuckDB ``quantile_cont``) of
every feature over all rows, by sketch brackets and distributed selection
(:mod:`flowspark.operators.quantiles`): no sample, and no task that holds a
column.

Apply: ``(x - median) / IQR`` with IQR 0 -> 1 (scikit's rule, not
``pyspark.ml.feature.RobustScaler``, which maps such columns to 0).  The
fitted table has one row per feature (78), so it is read to the driver and
inlined as literals: the apply is a pure projection, no join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowspark import config
from flowspark.functions.cleaning import fcol
from flowspark.operators.quantiles import exact_quantiles
from flowspark.session import compiled_methods

SCALER_SCHEMA = T.StructType([
    T.StructField("idx", T.IntegerType(), False),
    T.StructField("feature", T.StringType(), False),
    T.StructField("q1", T.DoubleType(), True),
    T.StructField("center", T.DoubleType(), True),
    T.StructField("q3", T.DoubleType(), True),
    T.StructField("scale", T.DoubleType(), True),
])


def fit_scaler(prepared: DataFrame, order: Sequence[str] = config.FEATURE_ORDER,
               absent: Iterable[str] = ()) -> DataFrame:
    """Long table ``idx, feature, q1, center, q3, scale``; quartiles and scale
    are null if there are no rows.

    ``prepared`` is read twice: pass a written table if it is costly.
    ``absent``: features missing from the raw input.  Preparation fills them
    with 0, so their quartiles are exactly 0 and need no pass (on the flow
    fixture: 17 measured columns instead of 78)."""
    absent = set(absent)
    measured = [n for n in order if n not in absent]
    if measured:
        found = exact_quantiles(prepared, measured)
        empty = found[measured[0]][0] is None
    else:
        found, empty = {}, prepared.isEmpty()
    rows = []
    for i, n in enumerate(order):
        q1, center, q3 = found.get(n, [None if empty else 0.0] * 3)
        scale = None if q1 is None else (q3 - q1) or 1.0
        rows.append((i, n, q1, center, q3, scale))
    return prepared.sparkSession.createDataFrame(rows, SCALER_SCHEMA)


def scaler_summary(scaler: DataFrame) -> DataFrame:
    """A4: min / max of centers and scales."""
    return scaler.agg(
        F.min("center").alias("center_min"), F.max("center").alias("center_max"),
        F.min("scale").alias("scale_min"), F.max("scale").alias("scale_max"),
    )


def scaler_params(scaler: DataFrame) -> dict[str, tuple[float, float]]:
    """Read the (bounded: one row per feature) fitted table to the driver."""
    return {r["feature"]: (r["center"], r["scale"])
            for r in scaler.select("feature", "center", "scale").collect()}


def scaler_from_params(spark: SparkSession, params: dict[str, tuple[float, float]],
                       order: Sequence[str] = config.FEATURE_ORDER) -> DataFrame:
    rows = [(i, n, None, params[n][0], None, params[n][1]) for i, n in enumerate(order)]
    return spark.createDataFrame(rows, SCALER_SCHEMA)


def apply_scaler(prepared: DataFrame, params: dict[str, tuple[float, float]],
                 order: Sequence[str] = config.FEATURE_ORDER) -> DataFrame:
    """Scale every feature exactly once; result float32."""
    compiled_methods(prepared.sparkSession)
    feats = set(order)
    others = [fcol(c) for c in prepared.columns if c not in feats]
    scaled = [((fcol(n) - F.lit(params[n][0])) / F.lit(params[n][1])).cast("float").alias(n)
              for n in order]
    return prepared.select(*others, *scaled)
