"""Softmax boosting: the model against a plain numpy Newton step, its
independence of partitions, early stopping, saving."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowspark.operators import boosting as bo
from flowspark.operators import models as md
from flowspark.operators import treeshap as ts

SCHEMA = "flow_id long, features array<float>, Label string, v boolean"


def _rows(n, seed=1, noise=0.0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 2).astype(np.float32)
    x[:, 3] = 7
    y = np.where(x[:, 0] > 0.3, "a", np.where(x[:, 1] * x[:, 2] > 0, "b", "c"))
    y = np.where(rng.random(n) < noise, "a", y)
    return x, y, [(i, [float(v) for v in r], str(t), i % 5 == 0) for i, (r, t) in enumerate(zip(x, y))]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(_rows(2000)[2], SCHEMA).cache()


@pytest.fixture(scope="module")
def model(frame):
    return bo.fit(frame.where("not v"), frame.where("v"), md.GbtParams(max_iter=12, max_depth=3))


def test_first_round_is_the_newton_step(spark):
    """Depth 1, every row and feature: split and leaf values by brute force."""
    x, y, rows = _rows(400, seed=3)
    m = bo.fit(spark.createDataFrame(rows, SCHEMA), None, md.GbtParams(max_iter=1, max_depth=1, subsample=1.0, feature_fraction=1.0))
    assert len(m.trees.feature) == 1 and m.classes == ["a", "b", "c"]
    share = np.array([np.mean(y == c) for c in m.classes])
    assert np.allclose(m.prior, np.log(share))
    for k, c in enumerate(m.classes):
        g = share[k] - (y == c)
        h = np.full(len(y), share[k] * (1 - share[k]) * 1.5)
        best = (0.0, None)
        for f, cuts in enumerate(m.cuts):
            for cut in cuts:
                left = x[:, f].astype(float) <= cut
                if min(left.sum(), (~left).sum()) < bo.MIN_ROWS:
                    continue
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + bo.RIDGE) for s in (left, ~left))
                if gain > best[0] + 1e-4:
                    best = (gain, (f, cut, left))
        f, cut, left = best[1]
        assert m.trees.feature[0, k, 0] == f and m.cuts[f][m.trees.cut[0, k, 0]] == cut
        for i, s in ((1, left), (2, ~left)):
            assert m.trees.value[0, k, i] == pytest.approx(-0.05 * g[s].sum() / (h[s].sum() + bo.RIDGE), abs=1e-5)


def test_same_model_whatever_the_partitions(frame, model):
    p = md.GbtParams(max_iter=12, max_depth=3)
    other = bo.fit(frame.where("not v").repartition(13), frame.where("v").repartition(3), p)
    assert np.array_equal(other.trees.feature, model.trees.feature) and np.array_equal(other.trees.cut, model.trees.cut)
    assert np.array_equal(other.trees.value, model.trees.value) and other.losses == model.losses


def test_losses_are_those_of_the_scored_rows(spark, frame, model):
    """Also across a refresh of the margins (12 rounds, REFRESH 10)."""
    s = frame.where("v").withColumn("p", bo.probs_col(spark, model, F.col("features"))).select("Label", "p").collect()
    loss = -np.mean([np.log(r.p[model.classes.index(r.Label)]) for r in s])
    assert len(model.losses) == 13 and model.losses[0] > model.losses[-1]
    assert model.losses[len(model.trees.feature)] == pytest.approx(loss, abs=1e-6)
    assert all(abs(sum(r.p) - 1) < 1e-12 for r in s)


def test_early_stop_cuts_behind_the_best_round(spark):
    """Labels without any signal: no round helps the validation rows for long."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=3)], "ab"[int(rng.random() < 0.5)], i % 3 == 0) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    m = bo.fit(df.where("not v"), df.where("v"), md.GbtParams(max_iter=60, max_depth=3, early_stop=3, step=0.3))
    assert len(m.losses) < 61
    best = int(np.argmin(m.losses))
    assert len(m.trees.feature) == best and len(m.losses) == best + 3 + 1


def test_margins_of_the_explained_trees(model):
    x = _rows(60, seed=9)[0].astype(np.float64)
    bins = bo.bins_of(x, model.cuts)
    margin = bo.add_trees(np.tile(model.prior, (len(x), 1)), model.trees, bins)
    for k in range(3):
        lt = ts.build_tables(model.nodes(k), x[:20])
        phi, own = ts.explain_matrix(lt, x)
        assert np.allclose(own, margin[:, k], atol=1e-12)
        assert np.allclose(phi.sum(axis=1), own - lt.base, atol=1e-9)


def test_saved_model_is_the_same(spark, model, tmp_shared):
    bo.save(spark, model, tmp_shared)
    back = bo.load(spark, tmp_shared)
    assert back.classes == model.classes and back.losses == model.losses and np.array_equal(back.prior, model.prior)
    assert all(np.array_equal(a, b) for a, b in zip(back.cuts, model.cuts))
    for name in ("feature", "cut", "value"):
        assert np.array_equal(getattr(back.trees, name), getattr(model.trees, name))


def test_no_rows_one_class_null_labels(spark, tmp_shared):
    empty = spark.createDataFrame([], SCHEMA)
    m = bo.fit(empty, empty, md.GbtParams(max_iter=2))
    assert m.classes == [] and len(m.trees.feature) == 0
    one = spark.createDataFrame([(i, [float(i)], None if i % 2 else "x", False) for i in range(50)], SCHEMA)
    m = bo.fit(one, one, md.GbtParams(max_iter=2))
    assert m.classes == ["x"] and m.prior[0] == 0
    bo.save(spark, m, tmp_shared)
    back = bo.load(spark, tmp_shared)
    assert one.withColumn("p", bo.probs_col(spark, back, F.col("features"))).first().p == [1.0]


def test_class_that_only_validation_rows_have(spark):
    rows = _rows(300)[2]
    new = [(1000 + i, [0.0] * 4, "new", True) for i in range(5)]
    df = spark.createDataFrame(rows + new, SCHEMA)
    m = bo.fit(df.where("not v"), df.where("v"), md.GbtParams(max_iter=2, max_depth=2))
    assert m.classes == ["a", "b", "c"] and m.losses[0] > 1


def test_truncated_binary_model_is_the_shorter_fit(spark):
    df = spark.createDataFrame(_rows(400)[2], SCHEMA).select(
        md.array_to_vector("features").alias(md.VEC), (F.col("Label") == "a").cast("double").alias("y"))
    full = md.gbt(md.GbtParams(max_iter=5, max_depth=2), "y").fit(df)
    short, ref = md.first_rounds(full, 2), md.gbt(md.GbtParams(max_iter=2, max_depth=2), "y").fit(df)
    raw = [[r[0] for r in m.transform(df).select("rawPrediction").collect()] for m in (short, ref)]
    assert short.getNumTrees == 2 and raw[0] == raw[1]


def test_same_model_when_tasks_add_up_the_sums(frame, model, monkeypatch):
    """Many tasks' sums are added by tasks, not by the driver; the model stays."""
    monkeypatch.setattr(bo, "MAX_TO_DRIVER", 0)
    monkeypatch.setattr(bo, "TASK_ROWS", 100)
    other = bo.fit(frame.where("not v").repartition(6), frame.where("v"), md.GbtParams(max_iter=12, max_depth=3))
    assert np.array_equal(other.trees.value, model.trees.value) and other.losses == model.losses


def test_small_table_is_one_task_a_pass(frame, monkeypatch):
    """Rounds are many short passes: a task for every few rows is all overhead."""
    parts, sums = [], bo._level_sums
    monkeypatch.setattr(bo, "_level_sums", lambda blocks, *a: parts.append(blocks.getNumPartitions()) or sums(blocks, *a))
    bo.fit(frame.where("not v").repartition(6), frame.where("v"), md.GbtParams(max_iter=2, max_depth=2))
    assert set(parts) == {1}


def test_walk_and_tables_by_brute_force():
    """Places among a level's nodes and sums by (node, feature, bin), with an
    odd number of features, for few rows (one feature a table) and many (two)."""
    rng = np.random.default_rng(4)
    for n in (50, 40_000):
        bins = rng.integers(0, 6, size=(5, n)).astype(np.uint8)
        feature, cut = rng.integers(0, 5, 15).astype(np.int16), rng.integers(0, 5, 15).astype(np.uint8)
        feature[[2, 3]] = bo.LEAF
        stop = bo.ends(feature, 3)
        place = bo.places_of(feature, cut, bins, 3)
        for row in range(0, n, max(1, n // 50)):
            i = 0
            while i < 7 and feature[i] != bo.LEAF:
                i = 2 * i + 1 + int(bins[feature[i], row] > cut[i])
            assert stop[place[row]] == i
        w = rng.integers(-9, 9, n).astype(float)
        t = bo._tables(bins, place, (w, None), 8, 6)
        for node, f, b in ((0, 0, 0), (3, 4, 5), (7, 2, 1), (5, 3, 3)):
            here = (place == node) & (bins[f] == b)
            assert t[0, node, f, b] == w[here].sum() and t[1, node, f, b] == here.sum()


def test_constant_features_are_neither_cut_nor_kept(spark, frame, monkeypatch):
    """Most of a table's 78 features may be absent: no quantiles, no bytes a row."""
    asked, kept = [], []
    quantiles, sums = F.percentile_approx, bo._level_sums
    monkeypatch.setattr(bo.F, "percentile_approx", lambda *a: asked.append(1) or quantiles(*a))
    monkeypatch.setattr(bo, "_level_sums", lambda blocks, *a: kept.append(blocks.first().bins.shape[0]) or sums(blocks, *a))
    m = bo.fit(frame.where("not v"), frame.where("v"), md.GbtParams(max_iter=1, max_depth=2))
    assert len(asked) == 3 and set(kept) == {3} and len(m.cuts) == 4 and len(m.cuts[3]) == 0
    assert set(np.unique(m.trees.feature)) <= {bo.LEAF, 0, 1, 2}


def test_only_the_smaller_child_is_counted(frame, monkeypatch):
    """The other child is what remains: the same sums as if both were counted."""
    seen, sums = [], bo._level_sums

    def both(blocks, grown, level, round_no, used, n_bins, fraction, counted):
        every = np.ones_like(counted)
        found = sums(blocks, grown, level, round_no, used, n_bins, fraction, counted)
        whole = sums(blocks, grown, level, round_no, used, n_bins, fraction, every)[0].reshape(3, len(counted), 1 << level, -1)
        part = found[0].reshape(whole.shape)
        if level:
            above = seen[-1][1]
            k, j = np.argwhere(counted).T
            assert (whole[2, k, j].sum(axis=1) <= whole[2, k, j ^ 1].sum(axis=1)).all() and not part[:, ~counted].any()
            assert np.array_equal(above[:, k, j >> 1] - part[:, k, j], whole[:, k, j ^ 1])
        seen.append((level, whole))
        return found

    monkeypatch.setattr(bo, "_level_sums", both)
    bo.fit(frame.where("not v"), None, md.GbtParams(max_iter=2, max_depth=3))
    assert [level for level, _ in seen] == [0, 1, 2] * 2
