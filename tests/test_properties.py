"""Randomised properties: reports and per-row top-k against plain Python."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowspark.operators import explain as ex
from flowspark.operators import metrics as m

CLASSES = ["Bot", "DDoS", "PortScan", "SSH-Patator"]
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
pairs = st.lists(st.tuples(st.sampled_from(CLASSES), st.sampled_from(CLASSES)),
                 min_size=1, max_size=40)


def _report(rows):
    classes = sorted({a for a, _ in rows} | {p for _, p in rows})
    sup = Counter(a for a, _ in rows)
    pred = Counter(p for _, p in rows)
    tp = Counter(a for a, p in rows if a == p)
    out = {}
    for c in classes:
        prec = tp[c] / pred[c] if pred[c] else 0.0
        rec = tp[c] / sup[c] if sup[c] else 0.0
        f1 = 2 * tp[c] / (sup[c] + pred[c]) if sup[c] + pred[c] else 0.0
        out[c] = (prec, rec, f1, sup[c])
    n = len(rows)
    out["accuracy"] = (None, None, sum(tp.values()) / n, n)
    out["macro avg"] = tuple(float(np.mean([out[c][i] for c in classes])) for i in range(3)) + (n,)
    out["weighted avg"] = tuple(sum(out[c][i] * sup[c] for c in classes) / n for i in range(3)) + (n,)
    return out


@SETTINGS
@given(rows=pairs)
def test_classification_report(spark, rows):
    df = spark.createDataFrame(rows, "a string, p string")
    got = {r["class"]: (r.precision, r.recall, r.f1_score, r.support)
           for r in m.classification_report(df, "a", "p").collect()}
    want = _report(rows)
    assert set(got) == set(want)
    for k, w in want.items():
        for g, e in zip(got[k], w):
            assert (g is None and e is None) or g == pytest.approx(e)


@SETTINGS
@given(rows=pairs)
def test_confusion_matrix(spark, rows):
    df = spark.createDataFrame(rows, "Actual string, Final_Prediction string")
    got = {(r.actual, r.predicted): r["count"] for r in m.confusion_multiclass(df).collect()}
    labels = sorted({a for a, _ in rows})
    cnt = Counter(rows)
    assert got == {(a, p): cnt[(a, p)] for a in labels for p in labels}


def _auc(y, s):
    pos = [v for t, v in zip(y, s) if t == 1]
    neg = [v for t, v in zip(y, s) if t == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=2, max_size=60))
def test_roc_auc_is_rank_statistic(spark, data):
    y = [t for t, _ in data]
    if len(set(y)) < 2:
        return
    s = [v / 20 for _, v in data]
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    got = m.roc_auc(df, F.col("y"), F.col("s")).first().auc
    assert got == pytest.approx(_auc(y, s))


@SETTINGS
@given(vals=st.lists(st.lists(st.integers(-9, 9), min_size=6, max_size=6), min_size=1, max_size=8),
       k=st.integers(1, 6))
def test_top_k_per_row(spark, vals, k):
    names = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(vals)],
                               "flow_id long, v array<double>")
    got = ex.top_k_per_row(df, F.col("v"), k=k, names=names).collect()
    for i, r in enumerate(vals):
        order = sorted(range(6), key=lambda j: (-abs(r[j]), j))[:k]
        rows = sorted((g for g in got if g.flow_id == i), key=lambda g: g["rank"])
        assert [g.feature for g in rows] == [names[j] for j in order]
        assert [g.value for g in rows] == [float(r[j]) for j in order]
