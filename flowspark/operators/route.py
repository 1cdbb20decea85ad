"""Two-stage routing rules and result shaping (F3-F6, L6, P13-P19, M6 rules, J1).

Stage 1 gives ``p_attack``; below the threshold a row is BENIGN with
confidence ``1 - p``.  Otherwise stage 2's class probabilities name the
attack (first arg-max), confidence = that probability, and the optional
reconstruction error flags an anomaly -- only on attack-routed rows.
All rules are column expressions: one projection, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark import config
from flowspark.functions.cleaning import fcol

RESULT_COLUMNS = ["Final_Prediction", "Binary_Route", "Confidence", "Anomaly"]
# fixed values: renamed keys of the record / single-flow response
RECORD_NAMES = {"Final_Prediction": "final_prediction", "Binary_Route": "binary_route",
                "Confidence": "confidence", "Anomaly": "anomaly"}
SINGLE_NAMES = {"Binary_Route": "binary_prediction", "Final_Prediction": "final_prediction",
                "Confidence": "confidence", "Anomaly": "anomaly"}


def binary_label(label: Column) -> Column:
    """P13 string form: BENIGN stays, everything else is ATTACK (null stays null)."""
    return F.when(label.isNull(), F.lit(None).cast("string")) \
        .when(label == config.BENIGN, F.lit(config.BENIGN)).otherwise(F.lit(config.ATTACK))


def binary_target(label: Column) -> Column:
    """P13 numeric form: label != BENIGN -> 1."""
    return (label != F.lit(config.BENIGN)).cast("int")


def is_benign(p: Column, threshold: float = config.ATTACK_THRESHOLD,
              inclusive: bool = False) -> Column:
    """``p < t`` is BENIGN in batch scoring, ``p <= t`` in single-flow scoring."""
    return (p <= F.lit(threshold)) if inclusive else (p < F.lit(threshold))


def route_expr(p: Column, threshold: float = config.ATTACK_THRESHOLD,
               inclusive: bool = False) -> Column:
    """the binary route of ``p``."""
    return F.when(is_benign(p, threshold, inclusive), F.lit(config.BENIGN)) \
        .otherwise(F.lit(config.ATTACK))


def argmax_expr(probs: Column) -> Column:
    """0-based index of the first maximum."""
    return F.array_position(probs, F.array_max(probs)) - 1


def route(df: DataFrame, classes: Sequence[str], p_col: str = "p_attack",
          probs_col: str = "probs", mse_col: str | None = "mse",
          ae_threshold: float | None = None, threshold: float = config.ATTACK_THRESHOLD,
          inclusive: bool = False, keep: Sequence[str] = ("flow_id",),
          actual_col: str | None = config.LABEL_NAME) -> DataFrame:
    """M6 (rules): scored rows ``[Actual,] Final_Prediction, Binary_Route,
    Confidence, Anomaly`` (+ kept columns)."""
    p = F.col(p_col)
    r = route_expr(p, threshold, inclusive)
    is_benign = r == F.lit(config.BENIGN)
    cls = F.element_at(F.array(*[F.lit(c) for c in classes]),
                       (argmax_expr(F.col(probs_col)) + 1).cast("int"))
    final = F.when(is_benign, F.lit(config.BENIGN)).otherwise(cls)
    conf = F.round(F.when(is_benign, F.lit(1.0) - p)
                   .otherwise(F.array_max(F.col(probs_col))), 4)
    if mse_col is not None and ae_threshold is not None and mse_col in df.columns:
        anomaly = (~is_benign) & F.coalesce(F.col(mse_col) > F.lit(ae_threshold), F.lit(False))
    else:
        anomaly = F.lit(False)
    cols = [fcol(k) for k in keep if k in df.columns]
    if actual_col is not None and actual_col in df.columns:
        cols.append(fcol(actual_col).alias("Actual"))
    cols += [final.alias("Final_Prediction"), r.alias("Binary_Route"),
             conf.alias("Confidence"), anomaly.alias("Anomaly")]
    return df.select(*cols)


def rename_results(scored: DataFrame, names: dict[str, str] = RECORD_NAMES) -> DataFrame:
    """Title-case result names -> snake names."""
    return scored.withColumnsRenamed({k: v for k, v in names.items() if k in scored.columns})


def result_record_json(scored: DataFrame, keep: Sequence[str] = ("flow_id",)) -> DataFrame:
    """Each result row as one JSON record with renamed keys."""
    s = F.struct(*[F.col(k).alias(v) for k, v in RECORD_NAMES.items()])
    return scored.select(*[F.col(k) for k in keep], F.to_json(s).alias("record"))


def score_proxy(scored: DataFrame) -> Column:
    """The compatible ROC score (1 - Confidence on ATTACK rows)."""
    return F.when(F.col("Binary_Route") == config.ATTACK, F.lit(1.0) - F.col("Confidence")) \
        .otherwise(F.col("Confidence"))


def train_decision(p: Column, threshold: float = config.TRAIN_DECISION_THRESHOLD) -> Column:
    """training-time decision ``p > 0.5``."""
    return (p > F.lit(threshold)).cast("int")


def _sq(a: Column, b: Column) -> Column:
    d = a.cast("double") - b.cast("double")
    return d * d


def recon_sq_errors(x: Column, r: Column) -> Column:
    """P20: per-feature squared errors."""
    return F.zip_with(x, r, _sq)


def recon_mse(x: Column | Sequence[Column], r: Column | Sequence[Column]) -> Column:
    """P20: mean squared reconstruction error of two equal-length arrays, or
    of their elements as separate columns (left-to-right sum, then divided by
    the width).  The sum over columns is compiled, a higher-order function is
    not."""
    if isinstance(x, Column):
        return F.aggregate(recon_sq_errors(x, r), F.lit(0.0), lambda acc, v: acc + v) / F.size(x)
    total = F.lit(0.0)
    for a, b in zip(x, r, strict=True):
        total = total + _sq(a, b)
    return total / F.lit(len(x))
