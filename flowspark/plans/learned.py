"""Registered learned-operator queries.

Models are trained once per session and dataset (:func:`training.bundle_for`)
on the whole flow table; results are checked by properties in ``tests/``
(probabilities in range and summing to 1, SHAP additivity, loss decrease,
save/load equality), so these entries have no SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowspark import config
from flowspark.operators import autoencoder as ae
from flowspark.operators import explain as ex
from flowspark.operators import metrics as m
from flowspark.operators import models as md
from flowspark.operators import route as rt
from flowspark.operators import sampling as smp
from flowspark.operators import treeshap as ts
from flowspark.plans import sql as S
from flowspark.plans import training as tr
from flowspark.plans.catalog import register
from flowspark.session import scratch_path


def _val(b, binary: bool = False):
    """Hold-out rows: the binary model's split or the attack model's split."""
    return b.data.where(F.col("is_val_bin" if binary else "is_val"))


def _attack_types(b, model):
    """Probabilities and arg-max class of the hold-out attacks."""
    atk = md.with_vector(_val(b)).where(F.col(config.LABEL_NAME) != config.BENIGN)
    s = md.score_attack(model, atk)
    classes = F.array(*[F.lit(c) for c in model.classes])
    pred = F.element_at(classes, (rt.argmax_expr(F.col("probs")) + 1).cast("int"))
    return s.select("flow_id", F.col(config.LABEL_NAME).alias("actual"), pred.alias("predicted"), "probs")


@register("gbt_binary")
def gbt_binary(spark, sf):
    """M1/M2/M4: binary model on the 80 % split (stratified by the binary
    target), p_attack of the 20 % hold-out."""
    b = tr.bundle_for(spark, sf)
    s = md.score_binary(b.binary, md.with_vector(_val(b, binary=True)), b.link)
    return s.select("flow_id", rt.binary_target(F.col(config.LABEL_NAME)).alias("y"), "p_attack")


@register("ovr_attack")
def ovr_attack(spark, sf):
    """M3/M5, one-vs-rest form: attack-type probabilities and arg-max class of
    hold-out attacks."""
    return _attack_types(tr.bundle_for(spark, sf), tr.one_vs_rest_for(spark, sf))


@register("softmax_attack")
def softmax_attack(spark, sf):
    """M2/M3/M5: the same of the softmax model that scoring uses."""
    b = tr.bundle_for(spark, sf)
    return _attack_types(b, b.attack)


def _binary_holdout(b):
    """``Actual, p_attack, Final_Prediction`` of the binary model's hold-out,
    at the training decision p > 0.5."""
    s = md.score_binary(b.binary, md.with_vector(_val(b, binary=True)), b.link)
    return s.select(F.col(config.LABEL_NAME).alias("Actual"), "p_attack",
                    F.when(rt.train_decision(F.col("p_attack")) == 1, F.lit(config.ATTACK))
                    .otherwise(F.lit(config.BENIGN)).alias("Final_Prediction"))


@register("holdout_confusion")
def holdout_confusion(spark, sf):
    """Hold-out confusion matrices of both models, zeros kept."""
    b = tr.bundle_for(spark, sf, "binary", "attack")
    two = m.confusion_binary(_binary_holdout(b), "Actual", "Final_Prediction").withColumn("model", F.lit("binary"))
    types = _attack_types(b, b.attack).select(F.col("actual").alias("Actual"), F.col("predicted").alias("Final_Prediction"))
    return two.unionByName(m.confusion_multiclass(types).withColumn("model", F.lit("attack")))


@register("holdout_log_loss")
def holdout_log_loss(spark, sf):
    """Hold-out log loss of both models."""
    b = tr.bundle_for(spark, sf, "binary", "attack")
    two = m.log_loss_binary(_binary_holdout(b), rt.binary_target(F.col("Actual")), F.col("p_attack"))
    names = F.array(*[F.lit(c) for c in b.attack.classes])
    own = F.try_element_at("probs", F.array_position(names, F.col("actual")).cast("int"))
    types = m.log_loss_multi(_attack_types(b, b.attack), F.coalesce(own, F.lit(0.0)))
    return two.withColumn("model", F.lit("binary")).unionByName(types.withColumn("model", F.lit("attack")))


def _held(by: str, rows: str) -> str:
    """SQL: how many rows the stratified hold-out has."""
    return (f"(SELECT CAST(sum(floor(n * CAST({config.VALIDATION_FRACTION} AS DOUBLE) + 0.5)) AS BIGINT) "
            f"FROM (SELECT count(*) AS n FROM flows WHERE {rows} GROUP BY {by}))")


_ALL = "(SELECT count(*) FROM flows WHERE \"Label\" IS NOT NULL)"


@register("model_checks", S.with_chain(S.FLOWS_SQL.strip()) + f"""SELECT 'p_attack in range' AS "check",
  {_held("\"Label\" = 'BENIGN'", '"Label" IS NOT NULL')} AS n, CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'class probabilities', {_held('"Label"', "\"Label\" <> 'BENIGN'")}, 0
UNION ALL SELECT 'routes', {_ALL}, 0
UNION ALL SELECT 'saved and loaded', {_ALL}, 0
UNION ALL SELECT 'shap adds up', {_ALL}, 0""")
def model_checks(spark, sf):
    """M4-M6, E1, S9/S10 as rows that SQL foretells: how many rows each
    property was tried on, and how many break it."""
    from flowspark.sources.bundle import load_bundle, save_bundle
    b = tr.bundle_for(spark, sf, *tr.MODELS)

    def check(name, rows, broken):
        return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(broken).alias("violations")).select(
            F.lit(name).alias("check"), "n", "violations")

    p = F.col("p_attack")
    total = F.aggregate("probs", F.lit(0.0), lambda a, v: a + v)
    probs_wrong = (F.size("probs") != len(b.attack.classes)) | F.exists("probs", lambda v: (v < 0) | (v > 1)) | \
        (F.abs(total - 1) > 1e-9)
    routed = tr.score(spark, b)
    to_benign = F.col("Binary_Route") == config.BENIGN
    route_wrong = (to_benign != (p < b.threshold)) | (to_benign != (F.col("Final_Prediction") == config.BENIGN)) | \
        (to_benign & F.col("Anomaly")) | (F.col("Confidence") < 0) | (F.col("Confidence") > 1)
    path = scratch_path(spark, "bundle")
    save_bundle(spark, b, path)
    columns = ["flow_id", "p_attack", *rt.RESULT_COLUMNS]
    again = tr.score(spark, load_bundle(spark, path), b.data).select(F.col("flow_id").alias("id"), *[
        F.col(c).alias(f"{c}_loaded") for c in columns[1:]])
    both = routed.select(*columns).join(again, F.col("flow_id") == F.col("id"), "full_outer")
    differ = F.lit(False)
    for c in columns[1:]:
        differ = differ | ~F.col(c).eqNullSafe(F.col(f"{c}_loaded"))
    phi = ts.explain(spark, b.data, {0: ts.build_tables(ts.read_trees(spark, b.binary), _background(b))})
    gap = F.abs(F.aggregate("shap", F.lit(0.0), lambda a, v: a + v) - (F.col("margin") - F.col("base")))
    return check("p_attack in range", _binary_holdout(b), p.isNull() | (p < 0) | (p > 1)) \
        .union(check("class probabilities", _attack_types(b, b.attack), F.col("probs").isNull() | probs_wrong)) \
        .union(check("routes", routed, route_wrong)).union(check("saved and loaded", both, differ)) \
        .union(check("shap adds up", phi, gap > 1e-9))


@register("two_stage_models")
def two_stage_models(spark, sf):
    """Every flow scored by both models and the autoencoder."""
    s = tr.score(spark, tr.bundle_for(spark, sf, *tr.MODELS))
    return s.select("flow_id", "Actual", *rt.RESULT_COLUMNS, "p_attack")


@register("model_attack_distribution")
def model_attack_distribution(spark, sf):
    """A8 on model scores: attack types among predictions, % of all rows."""
    return m.attack_distribution(tr.score(spark, tr.bundle_for(spark, sf, *tr.MODELS)))


@register("ae_train")
def ae_train(spark, sf):
    """Per-epoch train and validation loss of the local-SGD autoencoder."""
    return ae.history_frame(spark, tr.bundle_for(spark, sf).auto)


@register("ae_validation")
def ae_validation(spark, sf):
    """A18/A19/M9 on the trained autoencoder: validation error statistics,
    the fitted threshold and how many validation rows it flags."""
    return ae.validation_frame(spark, tr.bundle_for(spark, sf).auto)


@register("ae_reconstruct")
def ae_reconstruct(spark, sf):
    """M8/M9/P20: reconstruction error of every flow against the fitted threshold."""
    b = tr.bundle_for(spark, sf)
    mse = ae.mse_col(spark, b.auto, F.col("features"))
    return b.data.select("flow_id", mse.alias("mse")) \
        .withColumn("above_threshold", F.col("mse") > F.lit(b.auto.threshold))


@register("ae_recon_top_features")
def ae_recon_top_features(spark, sf):
    """Per flow, the 15 features with the largest squared reconstruction error."""
    b = tr.bundle_for(spark, sf)
    rec = b.data.select("flow_id", "features",
                        ae.reconstruct_col(spark, b.auto, F.col("features")).alias("recon"))
    err = rt.recon_sq_errors(F.col("features"), F.col("recon"))
    return ex.top_k_per_row(rec, err, by_abs=False, value_name="reconstruction_error")


@register("holdout_report")
def holdout_report(spark, sf):
    """Hold-out classification reports (binary at p > 0.5, attack type)."""
    b = tr.bundle_for(spark, sf, "binary", "attack")
    s1 = md.score_binary(b.binary, md.with_vector(_val(b, binary=True)), b.link).select(
        rt.binary_label(F.col(config.LABEL_NAME)).alias("ya"),
        F.when(rt.train_decision(F.col("p_attack")) == 1, F.lit(config.ATTACK))
        .otherwise(F.lit(config.BENIGN)).alias("yp"))
    rb = m.classification_report(s1, "ya", "yp").withColumn("model", F.lit("binary"))
    atk = md.with_vector(_val(b)).where(F.col(config.LABEL_NAME) != config.BENIGN)
    classes = F.array(*[F.lit(c) for c in b.attack.classes])
    s2 = md.score_attack(b.attack, atk).select(
        F.col(config.LABEL_NAME).alias("ya"),
        F.element_at(classes, (rt.argmax_expr(F.col("probs")) + 1).cast("int")).alias("yp"))
    ra = m.classification_report(s2, "ya", "yp").withColumn("model", F.lit("attack"))
    return rb.unionByName(ra)


@register("model_class_accuracy")
def model_class_accuracy(spark, sf):
    """A17/F7 on the attack model's hold-out: per class samples, correct, accuracy."""
    b = tr.bundle_for(spark, sf)
    atk = md.with_vector(_val(b)).where(F.col(config.LABEL_NAME) != config.BENIGN)
    classes = F.array(*[F.lit(c) for c in b.attack.classes])
    s = md.score_attack(b.attack, atk).select(
        F.col(config.LABEL_NAME).alias("Actual"),
        F.element_at(classes, (rt.argmax_expr(F.col("probs")) + 1).cast("int"))
        .alias("Final_Prediction"))
    return m.class_accuracy(s)


@register("retrain")
def retrain(spark, sf):
    """Save the trained bundle, load it back, score with the
    loaded models, summarise."""
    from flowspark.sources.bundle import load_bundle, save_bundle
    b = tr.bundle_for(spark, sf, *tr.MODELS)
    path = scratch_path(spark, "bundle")
    save_bundle(spark, b, path)
    loaded = load_bundle(spark, path)
    s = md.score_two_stage(spark, b.data, loaded.binary, loaded.attack, loaded.auto,
                           threshold=loaded.threshold, link=loaded.link)
    return m.summary_percent(s)


def _background(b):
    sample = smp.sample_exact(b.data.select("flow_id", "features"), config.BACKGROUND_ROWS)
    return ts.background_matrix(sample)


@register("shap_binary")
def shap_binary(spark, sf):
    """Top-15 SHAP contributions of the binary model, every flow."""
    b = tr.bundle_for(spark, sf)
    tables = {0: ts.build_tables(ts.read_trees(spark, b.binary), _background(b))}
    phi = ts.explain(spark, b.data, tables)
    return ex.top_k_per_row(phi, F.col("shap"), by_abs=True, value_name="shap_value")


@register("shap_attack")
def shap_attack(spark, sf):
    """SHAP of the predicted class's margin, attack-routed flows."""
    b = tr.bundle_for(spark, sf, "binary", "attack")
    bg = _background(b)
    tables = {k: ts.build_tables(b.attack.nodes(k), bg) for k in range(len(b.attack.classes))}
    # only the route and class are needed: no autoencoder pass
    scored = md.score_two_stage(spark, b.data, b.binary, b.attack, None,
                                keep=("flow_id", "features"), link=b.link)
    classes = F.array(*[F.lit(c) for c in b.attack.classes])
    cls = (F.array_position(classes, F.col("Final_Prediction")) - 1).cast("int")
    rows = scored.where(F.col("Binary_Route") == config.ATTACK) \
        .select("flow_id", "features", cls.alias("cls"))
    phi = ts.explain(spark, rows, tables, class_col="cls")
    out = ex.top_k_per_row(phi, F.col("shap"), by_abs=True, value_name="shap_value",
                           keep=("flow_id", "cls"))
    return out.withColumn("class", F.element_at(classes, F.col("cls") + 1)).drop("cls")

