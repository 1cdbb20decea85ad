"""Exact quantiles, prefix sums, ROC, confusion matrices and cut keys over all
rows, against plain Python; blocks and brackets forced to be small."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowspark.operators import metrics as m
from flowspark.operators import quantiles as qt
from flowspark.operators import sampling as smp
from flowspark.operators.prefix import prefix_sums


def test_prefix_sums_over_blocks(spark):
    rng = random.Random(1)
    rows = [(k, rng.randint(0, 9), rng.randint(-5, 5)) for k in rng.sample(range(10_000), 500)]
    df = spark.createDataFrame(rows, "k long, a long, b long")
    for descending in (False, True):
        out = prefix_sums(df, ["k"], {"sa": "a", "sb": "b"}, descending, blocks=7).collect()
        got = {r.k: r for r in out}
        rows.sort(reverse=descending)
        a = b = 0
        for n, (k, x, y) in enumerate(rows):
            a, b = a + x, b + y
            r = got[k]
            assert (r.sa, r.sb, r.sa_total) == (a, b, sum(x[1] for x in rows))
            following = rows[n + 1] if n + 1 < len(rows) else (None, None, None)
            assert (r.sa_next, r.sb_next) == following[1:]
    assert prefix_sums(df.limit(0), ["k"], {"sa": "a"}).count() == 0


@pytest.mark.parametrize("k, margin", [(4096, 0.005), (8, 0.0), (64, 0.02)])
def test_quantiles_are_exact(spark, monkeypatch, k, margin):
    """Also with a sketch so coarse that brackets miss and are opened."""
    monkeypatch.setattr(qt, "SKETCH_K", k)
    monkeypatch.setattr(qt, "MARGIN", margin)
    rng = np.random.default_rng(3)
    n = 7_001
    cols = {"x y": rng.normal(size=n), "ties": rng.integers(0, 3, n).astype(float), "const": np.full(n, 2.5),
            "heavy": np.where(rng.random(n) < 0.4, 0.0, rng.lognormal(size=n))}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cols.values())], ", ".join(f"`{c}` double" for c in cols))
    got = qt.exact_quantiles(df.repartition(5), list(cols), (0.25, 0.5, 0.75, 0.999))
    for c, v in cols.items():
        assert got[c] == pytest.approx(np.quantile(v, [0.25, 0.5, 0.75, 0.999]).tolist(), rel=1e-12, abs=1e-12)


def test_quantiles_read_the_rows_twice(spark):
    """Once for the sketches, once for the counts and the values inside the
    brackets, which may overlap."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    rng = np.random.default_rng(5)
    v, w = rng.normal(size=4000), rng.integers(0, 4, 4000).astype(float)
    df = spark.createDataFrame(list(zip(v.tolist(), w.tolist())), "v double, w double").mapInArrow(counted, "v double, w double")
    probs = (0.25, 0.252, 0.5)
    got = qt.exact_quantiles(df, ["v", "w"], probs)
    assert got["v"] == pytest.approx(np.quantile(v, probs).tolist(), rel=1e-12) and got["w"] == np.quantile(w, probs).tolist()
    assert seen.value == 2 * 4000


def test_quantiles_of_few_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    assert qt.exact_quantiles(df, ["v"]) == {"v": [1.25, 1.5, 1.75]}
    assert qt.exact_quantiles(df.limit(0), ["v"]) == {"v": [None] * 3}
    assert qt.exact_quantiles(df.limit(1), ["v"])["v"] == [1.0] * 3


def test_roc_of_unrounded_scores(spark):
    """Scores that differ beyond six decimals keep their order."""
    rng = random.Random(4)
    rows = [(rng.randint(0, 1), 0.5 + 1e-9 * rng.randint(0, 300)) for _ in range(800)]
    df = spark.createDataFrame(rows, "y long, s double")
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert m.roc_auc(df, F.col("y"), F.col("s")).first().auc == pytest.approx(wins, abs=1e-12)
    curve = sorted((r.fpr, r.tpr) for r in m.roc_curve(df, F.col("y"), F.col("s")).collect())
    full = sorted((r.fpr, r.tpr) for r in m.roc_curve(df, F.col("y"), F.col("s"), drop_intermediate=False).collect())
    assert set(curve) <= set(full) and curve[0] == (0, 0) and curve[-1] == (1, 1) and len(curve) < len(full)
    area = sum((b[0] - a[0]) * (b[1] + a[1]) / 2 for a, b in zip(curve, curve[1:]))
    assert area == pytest.approx(wins, abs=1e-12)


def test_confusion_of_many_classes(spark):
    """More classes than a pivot would take; predictions outside them and null
    ones are dropped, zeros are kept."""
    rng = random.Random(5)
    names = [f"c{k:04d}" for k in range(1200)]
    rows = [(n, rng.choice(names[:3] + ["other", None])) for n in names] + [("BENIGN", "c0000"), (None, "c0000")]
    out = m.confusion_multiclass(spark.createDataFrame(rows, "Actual string, Final_Prediction string"))
    got = out.where("count > 0").collect()
    assert out.count() == 1200 * 1200
    assert sorted((r.actual, r.predicted) for r in got) == sorted(r for r in rows if r[0] in names and r[1] in names)


def test_split_by_cut_equals_ranks(spark):
    rows = [(k, ["a", "b", None][k % 3] if k % 50 else "rare", [1.0]) for k in range(3000)]
    df = spark.createDataFrame(rows, "flow_id long, Label string, features array<double>")
    want = {r.flow_id: r.is_val for r in smp.split_stratified(df, "Label").collect()}
    out = smp.split_by_cut(df, "Label")
    assert {r.flow_id: r.is_val for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_a_damaged_autoencoder_is_an_error(spark, tmp_shared):
    from flowspark.operators import autoencoder as ae
    assert ae.load(spark, f"{tmp_shared}/absent") is None
    spark.range(1).write.parquet(f"{tmp_shared}/auto/layers")
    spark.range(1).write.parquet(f"{tmp_shared}/auto/threshold")
    with pytest.raises(Exception):
        ae.load(spark, f"{tmp_shared}/auto")


def test_both_routes_on_separable_data(spark, tmp_shared):
    """Benign flows get a probability below the contract's threshold, attacks
    above it; the link survives saving."""
    from pyspark.ml.regression import IsotonicRegressionModel

    from flowspark.operators import models as md
    rows = [(k, [float(k % 10 + 90 * (k % 100 >= 70)), float(k * 7 % 13)], float(k % 100 >= 70)) for k in range(3000)]
    df = md.with_vector(spark.createDataFrame(rows, "flow_id long, features array<float>, y double"))
    model, _ = md.fit_binary(df.where("flow_id % 10 > 0"), None, md.GbtParams(max_iter=3, max_depth=2))
    held = df.where("flow_id % 10 = 0")
    assert md.score_binary(model, held).where("p_attack < 0.01").isEmpty()      # the model's own sigmoid
    link = md.fit_link(model, held)
    link.write().overwrite().save(f"{tmp_shared}/link")
    for k in (link, IsotonicRegressionModel.load(f"{tmp_shared}/link")):
        out = md.score_binary(model, df, k)
        assert out.where("(p_attack < 0.01) <> (y = 0)").isEmpty() and out.where("p_attack < 0 OR p_attack > 1").isEmpty()
    assert md.fit_link(model, held.where("y = 0")) is None and md.fit_link(model, held.limit(0)) is None
