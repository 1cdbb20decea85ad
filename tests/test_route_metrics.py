"""Routing rules and reports on hand-made scored rows (exact expectations)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowspark import config
from flowspark.operators import metrics as m
from flowspark.operators import route as rt
from conftest import SF_SMALL

CLASSES = ["Bot", "DDoS", "PortScan"]


def _flows(spark):
    rows = [
        (1, "BENIGN", 0.001, [0.2, 0.3, 0.5], 9.0),
        (2, "DDoS", 0.01, [0.4, 0.4, 0.2], 9.0),      # exactly the threshold; tie -> first
        (3, "Bot", 0.9, [0.7, 0.2, 0.1], 1.0),
        (4, "PortScan", 0.005, [0.1, 0.1, 0.8], 9.0),  # missed attack
        (5, "BENIGN", 0.6, [0.1, 0.8, 0.1], 0.5),      # false positive
    ]
    return spark.createDataFrame(rows, "flow_id long, Label string, p_attack double, "
                                       "probs array<double>, mse double")


def test_route_batch_and_single(spark):
    df = _flows(spark)
    batch = {r.flow_id: r for r in rt.route(df, CLASSES, ae_threshold=2.0).collect()}
    single = {r.flow_id: r for r in rt.route(df, CLASSES, ae_threshold=2.0, inclusive=True).collect()}
    assert batch[2].Binary_Route == "ATTACK" and single[2].Binary_Route == "BENIGN"   # Q1
    assert batch[2].Final_Prediction == "Bot"                                          # L6 first tie
    assert batch[2].Confidence == 0.4 and single[2].Confidence == 0.99
    assert batch[1].Final_Prediction == "BENIGN" and batch[1].Confidence == 0.999
    assert batch[1].Anomaly is False                 # benign-routed: never anomalous (Q4)
    assert batch[2].Anomaly is True and batch[3].Anomaly is False
    assert batch[1].Actual == "BENIGN"


def test_no_autoencoder_means_no_anomaly(spark):
    out = rt.route(_flows(spark), CLASSES, ae_threshold=None)
    assert out.where("Anomaly").count() == 0


def test_reports(spark):
    s = rt.route(_flows(spark), CLASSES, ae_threshold=2.0)
    cm = {(r.actual, r.predicted): r["count"] for r in m.confusion_binary(s).collect()}
    assert cm == {("BENIGN", "BENIGN"): 1, ("BENIGN", "ATTACK"): 1,
                  ("ATTACK", "BENIGN"): 1, ("ATTACK", "ATTACK"): 2}
    rep = {r["class"]: r for r in m.classification_report(
        s.withColumn("ya", rt.binary_label(F.col("Actual"))), "ya", "Binary_Route").collect()}
    assert rep["ATTACK"].precision == pytest.approx(2 / 3)
    assert rep["ATTACK"].recall == pytest.approx(2 / 3)
    assert rep["accuracy"].f1_score == pytest.approx(3 / 5)
    assert rep["weighted avg"].support == 5
    dist = m.attack_distribution(s).collect()
    assert [(r.Final_Prediction, r["count"]) for r in dist] == [("Bot", 2), ("DDoS", 1)]
    assert dist[0].pct == pytest.approx(40.0)
    summ = m.summary_percent(s).first()
    assert (summ.total, summ.attack_count, summ.anomaly_count) == (5, 3, 1)


def test_class_with_no_predictions_and_no_attacks(spark):
    s = spark.createDataFrame([("Bot", "DDoS"), ("PortScan", "DDoS")],
                              "Actual string, Final_Prediction string")
    rep = {r["class"]: r for r in m.classification_report(s, "Actual", "Final_Prediction").collect()}
    assert rep["Bot"].precision == 0.0 and rep["DDoS"].recall == 0.0      # 0/0 -> 0
    cm = m.confusion_multiclass(s).collect()
    assert {(r.actual, r.predicted, r["count"]) for r in cm} == {
        ("Bot", "Bot", 0), ("Bot", "PortScan", 0), ("PortScan", "Bot", 0), ("PortScan", "PortScan", 0)}
    none = spark.createDataFrame([("BENIGN", "BENIGN")], "Actual string, Final_Prediction string")
    assert m.confusion_multiclass(none).count() == 0
    assert m.class_accuracy(none).count() == 0


def test_roc_auc_perfect_and_random(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.3), (0, 0.1)], "y int, s double")
    assert m.roc_auc(df, F.col("y"), F.col("s")).first().auc == pytest.approx(1.0)
    df2 = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, s double")
    assert m.roc_auc(df2, F.col("y"), F.col("s")).first().auc == pytest.approx(0.5)


def test_log_loss(spark):
    import math
    df = spark.createDataFrame([(1, 0.8), (0, 0.2), (1, 0.0)], "y int, p double")
    got = m.log_loss_binary(df, F.col("y"), F.col("p")).first().log_loss
    want = (-math.log(0.8) - math.log(0.8) - math.log(1e-15)) / 3
    assert got == pytest.approx(want)


def test_running_sum_crosses_blocks(spark):
    from flowspark.streaming.monitor import running_sum
    df = spark.range(0, 50).select(F.col("id").alias("b"), F.lit(2).alias("x"))
    out = {r.b: r.x for r in running_sum(df, "b", ["x"], block=7).collect()}
    assert out == {i: 2 * (i + 1) for i in range(50)}


def test_reports_without_attacks_or_rows(spark):
    s = spark.createDataFrame([(1, "BENIGN", "BENIGN", "BENIGN", 0.9, False)],
                              "flow_id long, Actual string, Final_Prediction string, "
                              "Binary_Route string, Confidence double, Anomaly boolean")
    # no positives: ROC points exist, rates are null instead of a division error
    roc = m.roc_curve(s, rt.binary_target(F.col("Actual")), F.col("Confidence")).collect()
    assert roc[0].tpr == 0.0 and roc[-1].tpr is None
    assert m.attack_distribution(s).count() == 0
    empty = s.limit(0)
    summ = m.summary_percent(empty).first()
    assert summ.total == 0 and summ.benign_pct is None
    assert m.anomaly_rate(empty.withColumn("e", F.lit(1.0)), "e", 0.5).first().rate_pct is None
    rep = m.classification_report(empty, "Actual", "Final_Prediction").collect()
    assert [r["class"] for r in rep] == ["accuracy", "macro avg", "weighted avg"]


def test_reconstruction_error_of_columns_equals_that_of_arrays(spark):
    rows = [(1.5, -2.0, 0.1, 1.0, 0.3, 7.0), (1e9, 3.25, 0.0, -1e9, 0.7, 0.1), (None, 1.0, 2.0, 3.0, 4.0, 5.0)]
    df = spark.createDataFrame(rows, "a float, b float, c float, x double, y double, z double")
    x, r = [F.col(c) for c in "abc"], [F.col(c) for c in "xyz"]
    for got in df.select(rt.recon_mse(x, r).alias("one"), rt.recon_mse(F.array(*x), F.array(*r)).alias("two")).collect():
        assert got["one"] == got["two"]


def test_prepared_table_writes_no_absent_feature(spark):
    from flowspark.plans import fixtures as fx
    t = fx.prepared_table(spark, SF_SMALL)
    assert [c for c in t.columns if c in set(config.FEATURE_ORDER)] == config.FEATURE_ORDER
    written = set(spark.read.parquet(t.inputFiles()[0]).columns)
    assert written.isdisjoint(fx.ABSENT) and written | set(fx.ABSENT) >= set(config.FEATURE_ORDER)
    whole = fx.prepared_flows(spark, SF_SMALL)
    assert t.dtypes == whole.dtypes
    assert t.exceptAll(whole).isEmpty() and whole.exceptAll(t).isEmpty()
