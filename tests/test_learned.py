"""Property checks of the learned operators (SURVEY §5 "P")."""

from __future__ import annotations

import inspect
import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowspark import config
from flowspark.operators import autoencoder as ae
from flowspark.operators import models as md
from flowspark.operators import treeshap as ts


@pytest.fixture(scope="module")
def bundle(spark):
    from flowspark.plans import training as tr
    return tr.bundle_for(spark, SF_SMALL)


def test_early_stop_round():
    assert md.early_stop_round([5, 4, 3, 2, 1], 10) == 5
    losses = [5, 4, 3] + [3.5] * 10 + [1.0]
    assert md.early_stop_round(losses, 10) == 3        # stops before the late improvement
    assert md.early_stop_round([1.0], 10) == 1


def test_training_defaults_to_the_contract(monkeypatch):
    """The registered queries' bundle is trained with all rounds of the contract."""
    from types import SimpleNamespace

    from flowspark.plans import fixtures, training as tr
    used = []
    monkeypatch.setattr(fixtures, "scaled_flows", lambda spark, sf: SimpleNamespace(df=None, params={}))
    monkeypatch.setattr(tr.prep, "pack", lambda df: df)
    monkeypatch.setattr(tr, "split_table", lambda df: df)
    default = inspect.signature(tr.train_prepared).parameters["gbt"].default
    monkeypatch.setattr(tr, "train_prepared", lambda spark, data, params, gbt=default: used.append(gbt))
    tr.bundle_for(SimpleNamespace(sparkContext=SimpleNamespace(applicationId="none")), "nowhere")
    used.append(inspect.signature(tr.train).parameters["gbt"].default)
    assert [(g.max_iter, g.early_stop) for g in used] == [(config.GBT_MAX_ROUNDS, config.GBT_EARLY_STOP)] * 2
    assert config.GBT_MAX_ROUNDS == 200


def _brute_shap(lt, x, bg):
    n = x.shape[0]

    def value(subset):
        hyb = bg.copy()
        idx = list(subset)
        hyb[:, idx] = x[idx]
        return ts.explain_matrix(lt, hyb)[1].mean()

    phi = np.zeros(n)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for k in range(n):
            for s in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n)
                phi[i] += w * (value(s + (i,)) - value(s))
    return phi


def test_treeshap_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] + x[:, 2] > 0.5)).astype(float)
    df = spark.createDataFrame([(list(map(float, r)), float(t)) for r, t in zip(x, y)],
                               "a array<double>, y double").select(array_to_vector("a").alias("vec"), "y")
    model = md.GBTClassifier(featuresCol="vec", labelCol="y", maxIter=4, maxDepth=3, seed=1).fit(df)
    bg = x[:12]
    lt = ts.build_tables(ts.read_trees(spark, model), bg)
    for row in x[20:24]:
        fast = ts.explain_matrix(lt, row[None, :])[0][0]
        assert np.allclose(fast, _brute_shap(lt, row, bg), atol=1e-10)
    margin = ts.explain_matrix(lt, x[:50])[1]
    raw = np.array([r[0] for r in model.transform(df.limit(50)).select(
        vector_to_array("rawPrediction")[1]).collect()])
    assert np.allclose(margin, raw, atol=1e-9)


def _random_tree(rng, depth, width):
    nodes = {}

    def grow(d):
        i = len(nodes)
        nodes[i] = None
        if d == 0 or (d < depth and rng.random() < 0.1):
            nodes[i] = (None, None, -1, -1, float(rng.normal()))
        else:
            left, right = grow(d - 1), grow(d - 1)
            nodes[i] = (int(rng.integers(width)), float(rng.normal()), left, right, 0.0)
        return i

    grow(depth)
    return nodes


def _leaf_by_leaf(lt, x):
    """Each leaf's own table, one after another."""
    phi, margin = np.zeros(x.shape), np.zeros(len(x))
    for leaf in range(len(lt.values)):
        met = (x[:, lt.feats[leaf]] > lt.lo[leaf]) & (x[:, lt.feats[leaf]] <= lt.hi[leaf])
        pattern = (met << np.arange(met.shape[1])).sum(axis=1)
        for j, f in enumerate(lt.feats[leaf]):
            phi[:, f] += lt.table[leaf][pattern, j]
        margin += met.all(axis=1) * lt.values[leaf]
    return phi, margin


@pytest.mark.parametrize("most", [9, 3])
def test_leaves_looked_up_in_groups(monkeypatch, most):
    """Groups of leaves give the sums of their leaves, also where a leaf has
    more tests than a group may have; there are far fewer groups."""
    monkeypatch.setattr(ts, "MAX_TESTS", most)
    rng = np.random.default_rng(2)
    trees = [(0.1, _random_tree(rng, 5, 6)) for _ in range(6)] + [(1.0, {0: (None, None, -1, -1, 0.5)})]
    x = np.round(rng.normal(size=(500, 7)), 1)
    x[:40, 0] = trees[0][1][0][1]                      # on a threshold
    lt = ts.build_tables(trees, x[:30])
    phi, margin = ts.explain_matrix(lt, x)
    assert np.allclose(phi, _leaf_by_leaf(lt, x)[0], atol=1e-12) and np.allclose(margin, _leaf_by_leaf(lt, x)[1], atol=1e-12)
    if most == 9:
        assert len(ts.group_leaves(lt).groups) * 4 < len(lt.values)


def test_shap_additivity_on_trained_model(spark, bundle):
    tables = {0: ts.build_tables(ts.read_trees(spark, bundle.binary),
                                 ts.background_matrix(bundle.data.limit(50)))}
    phi = ts.explain(spark, bundle.data, tables)
    err = phi.select(F.abs(F.aggregate("shap", F.lit(0.0), lambda a, v: a + v)
                           - (F.col("margin") - F.col("base"))).alias("e")).agg(F.max("e")).first()[0]
    assert err < 1e-9


def test_probabilities(spark, bundle):
    s = md.score_two_stage(spark, bundle.data, bundle.binary, bundle.attack, bundle.auto, link=bundle.link)
    assert s.count() == bundle.data.count()
    bad_p = s.where((F.col("p_attack") < 0) | (F.col("p_attack") > 1)).count()
    sums = s.where(F.col("probs").isNotNull()).select(
        F.aggregate("probs", F.lit(0.0), lambda a, v: a + v).alias("t"))
    assert bad_p == 0
    assert sums.where(F.abs(F.col("t") - 1) > 1e-9).count() == 0
    assert s.where((F.col("Binary_Route") == "BENIGN") & F.col("Anomaly")).count() == 0


def test_autoencoder_learns_and_round_trips(spark, bundle, tmp_shared):
    hist = bundle.auto.history
    assert len(hist) >= 1 and min(h[2] for h in hist) < hist[0][2]
    assert bundle.auto.threshold is not None and bundle.auto.threshold > 0
    v = ae.validation_frame(spark, bundle.auto).first()
    assert v.threshold == pytest.approx(v.err_mean + 3 * v.err_std)
    assert 0 <= v.anomalies <= v.n and v.n > 0
    ae.save(spark, bundle.auto, tmp_shared)
    back = ae.load(spark, tmp_shared)
    assert back.widths == bundle.auto.widths
    assert np.allclose(back.params, bundle.auto.params.astype(np.float32))
    assert back.threshold == pytest.approx(bundle.auto.threshold)
    assert ae.load(spark, tmp_shared + "-absent") is None
    assert ae.n_params(ae.widths_for(len(config.FEATURE_ORDER))) == 10602


def test_gradient_matches_finite_difference():
    widths = [5, 4, 2, 4, 5]
    rng = np.random.default_rng(0)
    p = ae.init_params(widths, 3)
    x = rng.normal(size=(7, 5)).astype(np.float32)
    _, g = ae.loss_and_grad(p, widths, x)
    for i in rng.choice(len(p), 8, replace=False):
        d = np.zeros_like(p)
        d[i] = 1e-3
        num = (ae.loss_and_grad(p + d, widths, x)[0] - ae.loss_and_grad(p - d, widths, x)[0]) / 2e-3
        assert num == pytest.approx(g[i], rel=5e-2, abs=1e-4)


def test_bundle_round_trip(spark, bundle, tmp_shared):
    from flowspark.sources.bundle import load_bundle, save_bundle
    save_bundle(spark, bundle, tmp_shared)
    loaded = load_bundle(spark, tmp_shared)
    a = md.score_two_stage(spark, bundle.data, bundle.binary, bundle.attack, bundle.auto, link=bundle.link)
    b = md.score_two_stage(spark, bundle.data, loaded.binary, loaded.attack, loaded.auto, link=loaded.link)
    cols = ["flow_id", "Final_Prediction", "Binary_Route", "Confidence", "Anomaly"]
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert loaded.params == bundle.params
    assert loaded.order == config.FEATURE_ORDER and loaded.threshold == config.ATTACK_THRESHOLD


def test_stream_equals_batch(spark, bundle):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    streamed = E.queries()["stream_model_score"](spark, SF_SMALL)
    batch = md.score_two_stage(spark, bundle.data, bundle.binary, bundle.attack, bundle.auto, link=bundle.link) \
        .select(*streamed.columns)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_scoring_without_autoencoder(spark, bundle):
    s = md.score_two_stage(spark, bundle.data, bundle.binary, bundle.attack, None, link=bundle.link)
    assert s.where("Anomaly").count() == 0
    assert s.where(F.col("mse").isNotNull()).count() == 0
    single = md.score_two_stage(spark, bundle.data, bundle.binary, bundle.attack, bundle.auto,
                                inclusive=True, link=bundle.link)
    assert single.count() == bundle.data.count()


def test_two_stratified_splits(spark, bundle):
    d = bundle.data.withColumn("bin", F.col("Label") != "BENIGN")
    for col, key in (("is_val_bin", "bin"), ("is_val", "Label")):
        for r in d.groupBy(key).agg(F.count("*").alias("n"), F.count_if(col).alias("v")).collect():
            assert r.v == int(r.n * 0.2 + 0.5)


def test_fused_validation_matches_separate_pass(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(2400, 3))
    x = np.concatenate([base, base @ rng.normal(size=(3, 5))], axis=1).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r], i % 5 == 0) for i, r in enumerate(x)],
                               "flow_id long, features array<float>, is_val boolean")
    tr_, va_ = df.where(~F.col("is_val")), df.where(F.col("is_val"))
    model = ae.train(spark, tr_, va_, 8, epochs=4, patience=5, shards=3)
    assert [h[0] for h in model.history] == [1, 2, 3, 4]
    best = min(h[2] for h in model.history)
    again = ae.mean_error(spark, model, va_.select("features"))
    assert again == pytest.approx(best, rel=1e-6)
    stopped = ae.train(spark, tr_, va_, 8, epochs=12, patience=1, shards=3, lr=0.05)
    h = stopped.history
    assert len(h) <= 12 and (len(h) == 12 or not h[-1][3])
    assert ae.mean_error(spark, stopped, va_.select("features")) == pytest.approx(
        min(r[2] for r in h), rel=1e-6)


def _benign_rows(spark, n=2000, width=6):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(n, 2))
    x = np.concatenate([base, base @ rng.normal(size=(2, width - 2))], axis=1)
    return spark.createDataFrame([(i, "BENIGN" if i % 4 else "Bot", [float(v) for v in r]) for i, r in enumerate(x)],
                                 "flow_id long, Label string, features array<float>")


def test_autoencoder_is_trained_on_all_benign_rows(spark, monkeypatch):
    """The smallest sample keys are those of the validation split: a sample
    that is far smaller than the table had no row to train on."""
    from flowspark.plans import training as tr
    monkeypatch.setattr(config, "AE_SAMPLE_ROWS", 100, raising=False)
    seen, train = [], ae.train
    monkeypatch.setattr(ae, "train", lambda spark, t, v, *a, **k: seen.extend([t.count(), v.count()]) or train(spark, t, v, *a, **k))
    model = tr.train_autoencoder(spark, _benign_rows(spark), epochs=3, width=6)
    assert sum(seen) == 1500 and model.validation["n"] == seen[1]
    assert all(h[1] > 0 for h in model.history) and model.history[-1][2] < model.history[0][2]


def test_failed_autoencoder_is_no_model(spark):
    """Nothing to train on, nothing to validate on, diverged: errors, not
    weights that were never fitted."""
    rows = _benign_rows(spark, 200).select("flow_id", "features")
    none = rows.where("flow_id < 0")
    for train, val, said in ((none, rows, "no training rows"), (none, none, "no training rows"), (rows, none, "no validation rows")):
        with pytest.raises(ValueError, match=said):
            ae.train(spark, train, val, 6, epochs=2, shards=2)
    huge = rows.select("flow_id", F.transform("features", lambda v: v * 1e30).alias("features"))
    with np.errstate(all="ignore"), pytest.raises(ArithmeticError, match="diverged"):
        ae.train(spark, huge, huge, 6, epochs=3, shards=2)


def test_more_benign_rows_are_more_shards(spark, monkeypatch):
    from flowspark.plans import training as tr
    shards, train = [], ae.train
    monkeypatch.setattr(ae, "train", lambda *a, **k: shards.append(k["shards"]) or train(*a, **k))
    for rows in (100_000, 150):
        monkeypatch.setattr(config, "AE_SHARD_ROWS", rows)
        tr.train_autoencoder(spark, _benign_rows(spark), epochs=1, width=6)
    assert shards == [config.AE_SHARDS, 10]


def test_models_are_trained_when_asked_for(spark, monkeypatch):
    """A query that needs one model waits for that one; several train together."""
    import threading

    from flowspark.plans import training as tr
    b = tr.train_prepared(spark, None, {"a": (0.0, 1.0)})
    meet, trained = threading.Barrier(2, timeout=20), []
    monkeypatch.setattr(b, "_autoencoder", lambda: trained.append("autoencoder") or "auto")
    monkeypatch.setattr(b, "_binary", lambda: meet.wait() is None or trained.append("binary") or ("model", [0.5], "link"))
    monkeypatch.setattr(b, "_attack", lambda: meet.wait() is None or trained.append("attack") or "softmax")
    assert b.auto == "auto" and trained == ["autoencoder"]
    b.fit(*tr.MODELS)
    assert sorted(trained) == ["attack", "autoencoder", "binary"] and b.auto == "auto"
    assert (b.binary, b.losses, b.link, b.attack) == ("model", [0.5], "link", "softmax")
    assert sorted(b.extras["seconds"]) == ["attack", "autoencoder", "binary"]
