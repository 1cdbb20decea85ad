"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their SQL oracles.

Every query reads the driver tables (through the derived flow table or the
event table) and runs over all their rows.  Doubles that come out of sums in
a different order, or out of transcendental functions, are rounded to 9
decimals in both engines; everything else is compared as computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark import config
from flowspark.functions.cleaning import fcol
from flowspark.operators import explain as ex
from flowspark.operators import metrics as m
from flowspark.operators import prepare as prep
from flowspark.operators import route as rt
from flowspark.operators import sampling as smp
from flowspark.operators import scaler as sc
from flowspark.plans import fixtures as fx
from flowspark.plans import sql as S
from flowspark.session import scratch_path
from flowspark.sources import records
from flowspark.sources.flows import FLOW_FEATURES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
FEATS = config.FEATURE_ORDER
R9 = 9


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r9(c):
    return F.round(c, R9)


def _round_cols(df: DataFrame, cols) -> DataFrame:
    return df.select(*[r9(fcol(c)).alias(c) if c in cols else fcol(c) for c in df.columns])


def _w(*ctes: str) -> str:
    return S.with_chain(*ctes)


FLIST = ", ".join(S.q(n) for n in FEATS)

# ---------------------------------------------------------------- sources ----


@register("flow_profile", _w(S.FLOWS_SQL.strip()) +
          "SELECT CAST(19 AS INTEGER) AS n_columns, count(*) AS n_rows, true AS has_label FROM flows")
def flow_profile(spark, sf):
    """Column count, row count, label presence."""
    f = fx.flow_table(spark, sf)
    has_label = any(c.strip().lower() == "label" for c in f.columns)
    return f.agg(F.lit(len(f.columns)).alias("n_columns"), F.count(F.lit(1)).alias("n_rows"),
                 F.lit(has_label).alias("has_label"))


@register("flow_preview", _w(S.FLOWS_SQL.strip()) +
          f"SELECT * FROM flows ORDER BY flow_id LIMIT {config.PREVIEW_ROWS}")
def flow_preview(spark, sf):
    """First rows (by flow id)."""
    return fx.flow_table(spark, sf).orderBy("flow_id").limit(config.PREVIEW_ROWS)


@register("feature_order_fill", _w(S.FLOWS_SQL.strip()) + "SELECT flow_id,\n  " +
          S.feature_list((n, S.filled_expr(n)) for n in FEATS) + "\nFROM flows")
def feature_order_fill(spark, sf):
    """Model feature order, absent features 0, extras dropped."""
    f = fx.flow_table(spark, sf)
    return f.select("flow_id", *prep.filled_features(f))


@register("log1p_features", _w(S.FLOWS_SQL.strip()) + "SELECT flow_id,\n  " +
          S.feature_list((n, f"round({S.log1p_expr(n)}, {R9})") for n in FEATS) + "\nFROM flows")
def log1p_features(spark, sf):
    """log1p(clip(x, 0)) on the listed columns that are present."""
    f = fx.flow_table(spark, sf)
    return f.select("flow_id", *[r9(c).alias(n) for c, n in zip(prep.log1p_features(f), FEATS)])


CLEAN_SQL = _w(*S.CHAIN_PREP) + f"SELECT flow_id, {FLIST} FROM prep"


@register("clean_features", CLEAN_SQL)
def clean_features(spark, sf):
    """P5-P10: cleaned, clipped float32 model input."""
    return prep.prepare(fx.flow_table(spark, sf), keep=("flow_id",))


@register("json_records", CLEAN_SQL)
def json_records(spark, sf):
    """Flows as JSON records ``{"flow_id": .., "features": {..}}``, written
    and read by the record source (absent keys are 0)."""
    f = fx.flow_table(spark, sf, with_label=False)
    path = scratch_path(spark, "records")
    records.records_from_rows(f, list(FLOW_FEATURES.values()), with_id=True).select("value").write.text(path)
    return prep.prepare(records.read_records(spark, path), keep=("flow_id",))


# ----------------------------------------------------------------- scaler ----

@register("scaler_fit", _w(*S.CHAIN_SCALER) +
          f"SELECT idx, feature, round(q1, {R9}) AS q1, round(center, {R9}) AS center, "
          f"round(q3, {R9}) AS q3, round(scale, {R9}) AS scale FROM scaler")
def scaler_fit(spark, sf):
    """A3: per-feature quartiles on the (<= 100k rows) sample."""
    s = sc.fit_scaler(fx.prepared_table(spark, sf), absent=fx.ABSENT)
    return _round_cols(s, {"q1", "center", "q3", "scale"})


@register("scaler_summary", _w(*S.CHAIN_SCALER) +
          f"SELECT round(min(center), {R9}) AS center_min, round(max(center), {R9}) AS center_max, "
          f"round(min(scale), {R9}) AS scale_min, round(max(scale), {R9}) AS scale_max FROM scaler")
def scaler_summary(spark, sf):
    """A4: min / max of centers and scales."""
    out = sc.scaler_summary(sc.fit_scaler(fx.prepared_table(spark, sf), absent=fx.ABSENT))
    return _round_cols(out, set(out.columns))


@register("scaled_features", _w(*S.CHAIN_SCALED) + f"SELECT flow_id, {FLIST} FROM scaled")
def scaled_features(spark, sf):
    """Robust-scaled float32 model input."""
    return fx.scaled_flows(spark, sf).df.drop(config.LABEL_NAME)


@register("matrix_stats", _w(*S.CHAIN_SCALED) +
          f"""SELECT CAST(count(*) / {len(FEATS)} AS BIGINT) AS n_rows, CAST({len(FEATS)} AS BIGINT) AS n_cols,
  CAST(min(v) AS DOUBLE) AS min, CAST(max(v) AS DOUBLE) AS max,
  round(avg(CAST(v AS DOUBLE)), {R9}) AS mean, round(stddev_pop(CAST(v AS DOUBLE)), {R9}) AS std
FROM (UNPIVOT (SELECT {FLIST} FROM scaled) ON {FLIST} INTO NAME feature VALUE v)""")
def matrix_stats(spark, sf):
    """A5: statistics over all cells of the scaled matrix."""
    out = m.matrix_stats(prep.pack(fx.scaled_flows(spark, sf).df))
    return _round_cols(out, {"mean", "std"})


# ----------------------------------------------------------------- labels ----

@register("label_distribution", _w(S.FLOWS_SQL.strip()) +
          "SELECT \"Label\" AS label, count(*) AS count FROM flows GROUP BY 1")
def label_distribution(spark, sf):
    """A1: class counts."""
    return m.label_distribution(fx.flow_table(spark, sf))


@register("binary_counts", _w(S.FLOWS_SQL.strip()) +
          "SELECT CAST(count_if(\"Label\" = 'BENIGN') AS BIGINT) AS benign_0, "
          "CAST(count_if(\"Label\" <> 'BENIGN') AS BIGINT) AS attack_1 FROM flows")
def binary_counts(spark, sf):
    """Binary target counts."""
    return m.binary_counts(fx.flow_table(spark, sf))


@register("label_encode", _w(S.FLOWS_SQL.strip()) +
          "SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code FROM "
          "(SELECT DISTINCT \"Label\" AS label FROM flows WHERE \"Label\" IS NOT NULL "
          "AND \"Label\" <> 'BENIGN')")
def label_encode(spark, sf):
    """Sorted attack classes and their codes."""
    return m.distinct_classes(fx.flow_table(spark, sf))


@register("benign_only", _w(S.FLOWS_SQL.strip()) +
          "SELECT flow_id, \"Label\" FROM flows WHERE \"Label\" = 'BENIGN'")
def benign_only(spark, sf):
    """BENIGN rows (autoencoder training input)."""
    return fx.flow_table(spark, sf).select("flow_id", "Label").where(F.col("Label") == config.BENIGN)


@register("attack_only", _w(S.FLOWS_SQL.strip()) +
          "SELECT flow_id, \"Label\" FROM flows WHERE \"Label\" <> 'BENIGN'")
def attack_only(spark, sf):
    """attack rows (stage-2 training input)."""
    return fx.flow_table(spark, sf).select("flow_id", "Label").where(F.col("Label") != config.BENIGN)


# --------------------------------------------------------------- sampling ----

@register("sample_exact", _w(S.FLOWS_SQL.strip()) +
          f"SELECT flow_id, \"Label\" FROM flows ORDER BY {S.md5_key()} LIMIT {config.BACKGROUND_ROWS}")
def sample_exact(spark, sf):
    """Exact-n repeatable sample (background rows)."""
    return smp.sample_exact(fx.flow_table(spark, sf).select("flow_id", "Label"), config.BACKGROUND_ROWS)


@register("split_stratified", _w(S.FLOWS_SQL.strip()) +
          f"""SELECT flow_id, "Label", rn <= floor(cnt * CAST({config.VALIDATION_FRACTION} AS DOUBLE) + 0.5) AS is_val
FROM (SELECT flow_id, "Label", row_number() OVER (PARTITION BY "Label" ORDER BY {S.md5_key()}) AS rn,
             count(*) OVER (PARTITION BY "Label") AS cnt FROM flows)""")
def split_stratified(spark, sf):
    """Stratified 80/20 split."""
    out = smp.split_stratified(fx.flow_table(spark, sf).select("flow_id", "Label"), "Label")
    return out.select("flow_id", "Label", "is_val")


@register("split_by_cut", _w(S.FLOWS_SQL.strip()) +
          f"""SELECT flow_id, "Label", row_number() OVER (PARTITION BY "Label" ORDER BY {S.md5_key()})
  <= floor(count(*) OVER (PARTITION BY "Label") * {config.VALIDATION_FRACTION} + 0.5) AS is_val FROM flows""")
def split_by_cut(spark, sf):
    """The stratified split of whole rows by their class's cut key."""
    return smp.split_by_cut(fx.flow_table(spark, sf), "Label").select("flow_id", "Label", "is_val")


@register("split_counts", _w(S.FLOWS_SQL.strip()) +
          f"""SELECT "Label" AS label, rn <= floor(cnt * CAST({config.VALIDATION_FRACTION} AS DOUBLE) + 0.5) AS is_val,
       count(*) AS n
FROM (SELECT flow_id, "Label", row_number() OVER (PARTITION BY "Label" ORDER BY {S.md5_key()}) AS rn,
             count(*) OVER (PARTITION BY "Label") AS cnt FROM flows) GROUP BY 1, 2""")
def split_counts(spark, sf):
    """Rows per class and split."""
    out = smp.split_stratified(fx.flow_table(spark, sf).select("flow_id", "Label"), "Label")
    return m.split_counts(out)


@register("split_random", _w(S.FLOWS_SQL.strip()) +
          f"SELECT flow_id, substr({S.md5_key()}, 1, 8) < '33333334' AS is_val FROM flows")
def split_random(spark, sf):
    """Unstratified 80/20 split by key."""
    return smp.split_random(fx.flow_table(spark, sf).select("flow_id")).select("flow_id", "is_val")


@register("union_files", _w(S.FLOWS_SQL.strip()) +
          """SELECT 'flows' AS source, * FROM flows
UNION ALL BY NAME
SELECT 'events' AS source, event_id AS flow_id, CAST(user_id % 1024 AS DOUBLE) AS "Destination Port",
       value AS "Flow Duration",
       CASE WHEN value >= 50 THEN event_type ELSE 'BENIGN' END AS "Label" FROM events""")
def union_files(spark, sf):
    """Union by name of inputs with different (and padded) headers."""
    from flowspark.sources.csvsrc import strip_names, union_all
    a = fx.flow_table(spark, sf).select(F.lit("flows").alias("source"), "*")
    ev = fx.events(spark, sf)
    b = ev.select(F.lit("events").alias("source"), F.col("event_id").alias("flow_id"),
                  (F.col("user_id") % 1024).cast("double").alias(" Destination Port"),
                  F.col("value").alias("Flow Duration "),
                  F.when(F.col("value") >= 50, F.col("event_type")).otherwise(F.lit("BENIGN"))
                  .alias(" Label"))
    return union_all([strip_names(a), strip_names(b)])


# ---------------------------------------------------------------- routing ----

SCORED = _w(*S.chain_scored())
RESULT = '"Final_Prediction", "Binary_Route", "Confidence", "Anomaly"'


@register("route_batch", SCORED + f'SELECT flow_id, "Actual", {RESULT} FROM scored')
def route_batch(spark, sf):
    """M6 rules, F3 (p < t), P16-P18, L6: scored rows with the actual label."""
    return fx.rule_scored(spark, sf).scored.select(
        "flow_id", "Actual", *rt.RESULT_COLUMNS)


@register("route_single", _w(*S.chain_scored(inclusive=True)) +
          'SELECT flow_id, "Binary_Route" AS binary_prediction, "Final_Prediction" AS final_prediction, '
          '"Confidence" AS confidence, "Anomaly" AS anomaly FROM scored')
def route_single(spark, sf):
    """F3 (p <= t) + P15: single-flow response form for every flow."""
    s = fx.rule_scored(spark, sf, inclusive=True).scored
    return rt.rename_results(s.select("flow_id", *rt.RESULT_COLUMNS), rt.SINGLE_NAMES)


@register("train_decision", SCORED +
          "SELECT flow_id, CAST(\"Actual\" <> 'BENIGN' AS INTEGER) AS y_true, "
          f"CAST(p_attack > {config.TRAIN_DECISION_THRESHOLD} AS INTEGER) AS y_pred FROM scored")
def train_decision(spark, sf):
    """training-time decision p > 0.5 next to the binary target."""
    s = fx.rule_scored(spark, sf).scored
    return s.select("flow_id", rt.binary_target(F.col("Actual")).alias("y_true"),
                    rt.train_decision(F.col("p_attack")).alias("y_pred"))


@register("anomaly_flag", SCORED +
          f'SELECT flow_id, "Binary_Route", round(mse, {R9}) AS mse, "Anomaly" FROM scored')
def anomaly_flag(spark, sf):
    """Reconstruction MSE and the attack-only anomaly flag."""
    s = fx.rule_scored(spark, sf).scored
    return s.select("flow_id", "Binary_Route", r9(F.col("mse")).alias("mse"), "Anomaly")


@register("actual_join", SCORED + f'SELECT flow_id, "Actual", {RESULT} FROM scored')
def actual_join(spark, sf):
    """Results stored apart from the input, aligned by key (inner equi-join)."""
    s = fx.rule_scored(spark, sf).scored.select("flow_id", *rt.RESULT_COLUMNS)
    labels = fx.flow_table(spark, sf).select("flow_id", F.col("Label").alias("Actual"))
    return s.join(labels, "flow_id", "inner")


@register("results_json", SCORED +
          "SELECT flow_id, CAST(json_object('final_prediction', \"Final_Prediction\", "
          "'binary_route', \"Binary_Route\", 'confidence', \"Confidence\", 'anomaly', \"Anomaly\") "
          "AS VARCHAR) AS record FROM scored")
def results_json(spark, sf):
    """Result rows as JSON records with renamed keys."""
    return rt.result_record_json(fx.rule_scored(spark, sf).scored)


# ---------------------------------------------------------------- reports ----

@register("summary_counts", SCORED +
          "SELECT count(*) AS total_rows, CAST(count_if(\"Final_Prediction\" <> 'BENIGN') AS BIGINT) AS attack_rows, "
          "CAST(count_if(\"Final_Prediction\" = 'BENIGN') AS BIGINT) AS benign_rows FROM scored")
def summary_counts(spark, sf):
    """Batch response summary."""
    return m.summary_counts(fx.rule_scored(spark, sf).scored)


@register("summary_percent", SCORED + """SELECT total, benign_count, 100.0 * benign_count / total AS benign_pct,
  attack_count, 100.0 * attack_count / total AS attack_pct, anomaly_count FROM (
 SELECT count(*) AS total, CAST(count_if("Final_Prediction" = 'BENIGN') AS BIGINT) AS benign_count,
   CAST(count_if("Final_Prediction" <> 'BENIGN') AS BIGINT) AS attack_count,
   CAST(count_if("Anomaly") AS BIGINT) AS anomaly_count FROM scored)""")
def summary_percent(spark, sf):
    """Prediction summary with shares and anomalies."""
    return m.summary_percent(fx.rule_scored(spark, sf).scored)


@register("attack_distribution", SCORED + """SELECT "Final_Prediction", count, 100.0 * count / total AS pct FROM (
 SELECT "Final_Prediction", count(*) AS count, sum(count(*)) OVER () AS total FROM scored GROUP BY 1)
WHERE "Final_Prediction" <> 'BENIGN'""")
def attack_distribution(spark, sf):
    """Attack types with % of all rows."""
    return m.attack_distribution(fx.rule_scored(spark, sf).scored)


_BIN_ACT = "CASE WHEN \"Actual\" = 'BENIGN' THEN 'BENIGN' ELSE 'ATTACK' END"


@register("confusion_binary", SCORED + f"""SELECT a.l AS actual, p.l AS predicted, CAST(count(s.flow_id) AS BIGINT) AS count
FROM (VALUES ('BENIGN'), ('ATTACK')) a(l) CROSS JOIN (VALUES ('BENIGN'), ('ATTACK')) p(l)
LEFT JOIN (SELECT flow_id, {_BIN_ACT} AS ba, "Binary_Route" AS br FROM scored WHERE "Actual" IS NOT NULL) s
  ON s.ba = a.l AND s.br = p.l GROUP BY 1, 2""")
def confusion_binary(spark, sf):
    """Binary confusion matrix."""
    return m.confusion_binary(fx.rule_scored(spark, sf).scored)


@register("confusion_attack", SCORED.rstrip() + """,
atk AS (SELECT * FROM scored WHERE "Actual" <> 'BENIGN'),
labs AS (SELECT DISTINCT "Actual" AS l FROM atk)
SELECT a.l AS actual, p.l AS predicted, CAST(count(t.flow_id) AS BIGINT) AS count
FROM labs a CROSS JOIN labs p LEFT JOIN atk t ON t."Actual" = a.l AND t."Final_Prediction" = p.l
GROUP BY 1, 2""")
def confusion_attack(spark, sf):
    """A10: attack confusion matrix on attack-labelled rows."""
    return m.confusion_multiclass(fx.rule_scored(spark, sf).scored)


def _pc_sql(src: str, a: str, p: str) -> str:
    return f"""pairs AS (SELECT {a} AS a, {p} AS p, count(*) AS n FROM {src} GROUP BY 1, 2),
pc AS (SELECT cls, CAST(sum(sup) AS BIGINT) AS support, CAST(sum(tp) AS BIGINT) AS tp,
              CAST(sum(pr) AS BIGINT) AS pred FROM (
  SELECT a AS cls, n AS sup, CASE WHEN a = p THEN n ELSE 0 END AS tp, 0 AS pr FROM pairs
  UNION ALL SELECT p AS cls, 0, 0, n FROM pairs) GROUP BY cls),
per AS (SELECT cls AS class,
  CASE WHEN pred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pred END AS precision,
  CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END AS recall,
  CASE WHEN support + pred = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (support + pred) END AS f1_score,
  support, tp FROM pc)"""


def _report_sql(src_cte: str, a: str, p: str) -> str:
    return SCORED.rstrip() + ",\n" + src_cte + ",\n" + _pc_sql("src", a, p) + f"""
SELECT class, round(precision, {R9}) AS precision, round(recall, {R9}) AS recall,
       round(f1_score, {R9}) AS f1_score, support FROM per
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), {R9}), CAST(sum(support) AS BIGINT) FROM per
UNION ALL SELECT 'macro avg', round(avg(precision), {R9}), round(avg(recall), {R9}), round(avg(f1_score), {R9}),
       CAST(sum(support) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), {R9}),
       round(sum(recall * support) / sum(support), {R9}), round(sum(f1_score * support) / sum(support), {R9}),
       CAST(sum(support) AS BIGINT) FROM per"""


def _report_round(df: DataFrame) -> DataFrame:
    return _round_cols(df, {"precision", "recall", "f1_score"})


@register("report_binary", _report_sql(
    f"src AS (SELECT {_BIN_ACT} AS ya, \"Binary_Route\" AS yp FROM scored WHERE \"Actual\" IS NOT NULL)",
    "ya", "yp"))
def report_binary(spark, sf):
    """Binary classification report."""
    s = fx.rule_scored(spark, sf).scored.where(F.col("Actual").isNotNull())
    s = s.withColumn("ya", rt.binary_label(F.col("Actual")))
    return _report_round(m.classification_report(s, "ya", "Binary_Route"))


@register("report_attack", _report_sql(
    "src AS (SELECT \"Actual\" AS ya, \"Final_Prediction\" AS yp FROM scored WHERE \"Actual\" <> 'BENIGN')",
    "ya", "yp"))
def report_attack(spark, sf):
    """Attack classification report (attack-labelled rows)."""
    s = fx.rule_scored(spark, sf).scored.where(F.col("Actual") != config.BENIGN)
    return _report_round(m.classification_report(s, "Actual", "Final_Prediction"))


@register("accuracy_f1", SCORED.rstrip() + ",\n" +
          "src AS (SELECT \"Actual\" AS ya, \"Final_Prediction\" AS yp FROM scored WHERE \"Actual\" <> 'BENIGN'),\n" +
          _pc_sql("src", "ya", "yp") + f""",
b AS (SELECT avg(CAST(({_BIN_ACT}) = "Binary_Route" AS DOUBLE)) AS acc,
  CAST(count_if(({_BIN_ACT}) = 'ATTACK' AND "Binary_Route" = 'ATTACK') AS BIGINT) AS tp,
  CAST(count_if(({_BIN_ACT}) = 'BENIGN' AND "Binary_Route" = 'ATTACK') AS BIGINT) AS fp,
  CAST(count_if(({_BIN_ACT}) = 'ATTACK' AND "Binary_Route" = 'BENIGN') AS BIGINT) AS fn
  FROM scored WHERE "Actual" IS NOT NULL)
SELECT round(b.acc, {R9}) AS binary_accuracy,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END, {R9}) AS binary_f1,
  round(x.acc, {R9}) AS attack_accuracy, round(x.wf, {R9}) AS attack_weighted_f1
FROM b CROSS JOIN (SELECT sum(tp) / sum(support) AS acc, sum(f1_score * support) / sum(support) AS wf FROM per) x""")
def accuracy_f1(spark, sf):
    """Accuracy, F1 (ATTACK positive), weighted F1."""
    out = m.accuracy_f1(fx.rule_scored(spark, sf).scored)
    return _round_cols(out, set(out.columns))


def _roc_sql(score: str) -> str:
    return SCORED.rstrip() + f""",
g AS (SELECT {score} AS threshold,
        CAST(sum(CASE WHEN "Actual" <> 'BENIGN' THEN 1 ELSE 0 END) AS BIGINT) AS pos,
        CAST(sum(CASE WHEN "Actual" = 'BENIGN' THEN 1 ELSE 0 END) AS BIGINT) AS neg
      FROM scored WHERE "Actual" IS NOT NULL GROUP BY 1),
pts AS (SELECT threshold,
   sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tps,
   sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fps,
   sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g)
"""


PROXY = "CASE WHEN \"Binary_Route\" = 'ATTACK' THEN 1.0 - \"Confidence\" ELSE \"Confidence\" END"


@register("roc_curve", _roc_sql("p_attack") + """, w AS (SELECT *,
   lag(tps) OVER (ORDER BY threshold DESC) AS tp0, lead(tps) OVER (ORDER BY threshold DESC) AS tp2,
   lag(fps) OVER (ORDER BY threshold DESC) AS fp0, lead(fps) OVER (ORDER BY threshold DESC) AS fp2 FROM pts)
SELECT CAST('Infinity' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT threshold, CAST(fps AS DOUBLE) / N AS fpr, CAST(tps AS DOUBLE) / P AS tpr FROM w
WHERE tp0 IS NULL OR tp2 IS NULL OR tp0 - 2 * tps + tp2 <> 0 OR fp0 - 2 * fps + fp2 <> 0""")
def roc_curve(spark, sf):
    """ROC points of p_attack (ATTACK positive)."""
    s = fx.rule_scored(spark, sf).scored.where(F.col("Actual").isNotNull())
    return m.roc_curve(s, rt.binary_target(F.col("Actual")), F.col("p_attack"))


@register("roc_curve_proxy", _roc_sql(PROXY) + """, w AS (SELECT *,
   lag(tps) OVER (ORDER BY threshold DESC) AS tp0, lead(tps) OVER (ORDER BY threshold DESC) AS tp2,
   lag(fps) OVER (ORDER BY threshold DESC) AS fp0, lead(fps) OVER (ORDER BY threshold DESC) AS fp2 FROM pts)
SELECT CAST('Infinity' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT threshold, CAST(fps AS DOUBLE) / N AS fpr, CAST(tps AS DOUBLE) / P AS tpr FROM w
WHERE tp0 IS NULL OR tp2 IS NULL OR tp0 - 2 * tps + tp2 <> 0 OR fp0 - 2 * fps + fp2 <> 0""")
def roc_curve_proxy(spark, sf):
    """ROC points of the compatible confidence proxy score (Q3)."""
    s = fx.rule_scored(spark, sf).scored.where(F.col("Actual").isNotNull())
    return m.roc_curve(s, rt.binary_target(F.col("Actual")), rt.score_proxy(s))


def _auc_sql(score: str) -> str:
    return _roc_sql(score) + f""", c AS (
 SELECT CAST('Infinity' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
 UNION ALL SELECT threshold, CAST(fps AS DOUBLE) / N, CAST(tps AS DOUBLE) / P FROM pts)
SELECT round(sum(seg), {R9}) AS auc FROM (
 SELECT (fpr - lag(fpr) OVER (ORDER BY threshold DESC)) * (tpr + lag(tpr) OVER (ORDER BY threshold DESC)) / 2
        AS seg FROM c)"""


@register("roc_auc", _auc_sql("p_attack"))
def roc_auc(spark, sf):
    """AUC of p_attack."""
    s = fx.rule_scored(spark, sf).scored.where(F.col("Actual").isNotNull())
    out = m.roc_auc(s, rt.binary_target(F.col("Actual")), F.col("p_attack"))
    return _round_cols(out, {"auc"})


@register("roc_auc_proxy", _auc_sql(PROXY))
def roc_auc_proxy(spark, sf):
    """AUC of the compatible confidence proxy score."""
    s = fx.rule_scored(spark, sf).scored.where(F.col("Actual").isNotNull())
    out = m.roc_auc(s, rt.binary_target(F.col("Actual")), rt.score_proxy(s))
    return _round_cols(out, {"auc"})


@register("class_accuracy", SCORED + """SELECT "Actual" AS class, count(*) AS samples,
  CAST(count_if("Actual" = "Final_Prediction") AS BIGINT) AS correct,
  CAST(count_if("Actual" = "Final_Prediction") AS DOUBLE) / count(*) AS accuracy
FROM scored WHERE "Actual" <> 'BENIGN' GROUP BY 1""")
def class_accuracy(spark, sf):
    """Per attack class accuracy."""
    return m.class_accuracy(fx.rule_scored(spark, sf).scored)


@register("recon_threshold", _w(*S.CHAIN_REC) +
          f"SELECT round(err_mean, {R9}) AS err_mean, round(err_std, {R9}) AS err_std, "
          f"round(threshold, {R9}) AS threshold FROM thr")
def recon_threshold(spark, sf):
    """Reconstruction error statistics and threshold."""
    out = fx.recon_stats(fx.with_recon(fx.scaled_flows(spark, sf).df))
    return _round_cols(out, set(out.columns))


@register("anomaly_rate", _w(*S.CHAIN_REC) + """SELECT count(*) AS n, CAST(count_if(mse > t.threshold) AS BIGINT) AS anomalies,
  100.0 * count_if(mse > t.threshold) / count(*) AS rate_pct FROM rec CROSS JOIN thr t""")
def anomaly_rate(spark, sf):
    """Anomaly count and rate."""
    f = fx.with_recon(fx.scaled_flows(spark, sf).df)
    return m.anomaly_rate(f, "mse", fx.fit_threshold(f))


@register("log_loss", SCORED + f"""SELECT round(avg(CASE WHEN "Actual" <> 'BENIGN' THEN -ln(pc) ELSE -ln(1.0 - pc) END), {R9}) AS log_loss,
  count(*) AS n FROM (SELECT *, least(greatest(p_attack, 1e-15), 1 - 1e-15) AS pc FROM scored WHERE "Actual" IS NOT NULL)""")
def log_loss(spark, sf):
    """Binary log loss of p_attack."""
    s = fx.rule_scored(spark, sf).scored.where(F.col("Actual").isNotNull())
    out = m.log_loss_binary(s, rt.binary_target(F.col("Actual")), F.col("p_attack"))
    return _round_cols(out, {"log_loss"})


@register("log_loss_multi", SCORED + f"""SELECT round(avg(-ln(greatest(CASE WHEN hot = true_idx THEN 0.625 ELSE 0.125 END, 1e-15))), {R9}) AS log_loss,
  count(*) AS n FROM scored WHERE "Actual" <> 'BENIGN'""")
def log_loss_multi(spark, sf):
    """Multiclass log loss of the attack-class probabilities."""
    s = fx.rule_scored(spark, sf).scored.where(F.col("Actual") != config.BENIGN)
    classes = F.array(*[F.lit(c) for c in fx.FIXTURE_CLASSES])
    p_true = F.element_at(F.col("probs"), F.array_position(classes, F.col("Actual")).cast("int"))
    out = m.log_loss_multi(s, p_true)
    return _round_cols(out, {"log_loss"})


@register("class_actual_vs_predicted", SCORED + """, atk AS (SELECT * FROM scored WHERE "Actual" <> 'BENIGN')
SELECT coalesce(a.label, p.label) AS label, coalesce(a.actual_count, 0) AS actual_count,
       coalesce(p.predicted_count, 0) AS predicted_count
FROM (SELECT "Actual" AS label, count(*) AS actual_count FROM atk GROUP BY 1) a
FULL OUTER JOIN (SELECT "Final_Prediction" AS label, count(*) AS predicted_count FROM atk GROUP BY 1) p
ON a.label = p.label""")
def class_actual_vs_predicted(spark, sf):
    """Actual vs predicted class counts (full outer alignment)."""
    return m.actual_vs_predicted(fx.rule_scored(spark, sf).scored)


# ----------------------------------------------------------- explanations ----

def _topk_sql(value_expr_fn, value_name: str, with_abs: bool) -> str:
    rows = " UNION ALL ".join(
        f"SELECT flow_id, {i} AS idx, {S.s(n)} AS feature, {value_expr_fn(n)} AS v FROM src"
        for i, n in enumerate(FEATS))
    abs_col = ", abs(v) AS abs" if with_abs else ""
    order = "abs(v) DESC" if with_abs else "v DESC"
    return f"""long AS ({rows}),
rk AS (SELECT *, row_number() OVER (PARTITION BY flow_id ORDER BY {order}, idx) AS rn FROM long)
SELECT flow_id, CAST(rn AS INTEGER) AS rank, feature, v AS {value_name}{abs_col} FROM rk
WHERE rn <= {config.TOP_FEATURES}"""


@register("recon_top_features", _w(*S.CHAIN_SCALED) + ", src AS (SELECT * FROM scaled),\n" +
          _topk_sql(S.sq_err, "reconstruction_error", False))
def recon_top_features(spark, sf):
    """Per flow, the 15 features with the largest squared
    reconstruction error."""
    f = fx.with_recon(fx.scaled_flows(spark, sf).df)
    err = rt.recon_sq_errors(F.col("features"), F.col("recon"))
    return ex.top_k_per_row(f, err, by_abs=False, value_name="reconstruction_error")


@register("contrib_top_features", _w(*S.CHAIN_SCALED) + ", src AS (SELECT * FROM scaled),\n" +
          _topk_sql(lambda n: f"CAST({S.q(n)} AS DOUBLE)", "shap_value", True))
def contrib_top_features(spark, sf):
    """Per flow, the 15 largest |contribution| (given values: the
    scaled features stand in for contributions)."""
    f = prep.pack(fx.scaled_flows(spark, sf).df)
    return ex.top_k_per_row(f, F.col("features"), by_abs=True, value_name="shap_value")


@register("flow_with_summary", SCORED + f"""SELECT flow_id, {RESULT}, round(mse, {R9}) AS mse,
  mse > (SELECT threshold FROM thr) AS above_threshold FROM scored""")
def flow_with_summary(spark, sf):
    """Prediction summary next to the reconstruction error of each flow."""
    rs = fx.rule_scored(spark, sf)
    return rs.scored.select("flow_id", *rt.RESULT_COLUMNS, r9(F.col("mse")).alias("mse"),
                            (F.col("mse") > F.lit(rs.ae_threshold)).alias("above_threshold"))


@register("flow_unpivot", _w(S.FLOWS_SQL.strip()) +
          "SELECT flow_id, feature, CAST(value AS DOUBLE) AS value FROM flows UNPIVOT INCLUDE NULLS "
          f"(value FOR feature IN ({', '.join(S.q(n) for n in S.RAW_FEATURES)}))")
def flow_unpivot(spark, sf):
    """E5/F8: raw features of every flow as (feature, value) rows."""
    return ex.flow_unpivot(fx.flow_table(spark, sf), S.RAW_FEATURES)


# ------------------------------------------------------- batch monitor -------

@register("batch_attacks", _w(S.STREAM_RULE) +
          "SELECT batch, count(*) AS n, CAST(count_if(\"Binary_Route\" = 'ATTACK') AS BIGINT) AS attacks "
          "FROM ev GROUP BY batch")
def batch_attacks(spark, sf):
    """batch = position // batch size; attacks per batch."""
    from flowspark.streaming.monitor import per_batch
    return per_batch(fx.stream_rule(fx.events(spark, sf))).select("batch", "n", "attacks")


@register("batch_numbers", _w(S.STREAM_RULE) + f"""SELECT batch, count(*) AS n, min(event_id) AS first_event,
  max(event_id) AS last_event, CAST(count_if("Anomaly") AS BIGINT) AS anomalies
FROM (SELECT event_id, "Anomaly", (row_number() OVER (ORDER BY event_id) - 1) // {fx.STREAM_BATCH} AS batch
      FROM ev WHERE "Binary_Route" = 'ATTACK') GROUP BY batch""")
def batch_numbers(spark, sf):
    """Attack-routed events alone, whose ids have gaps, in batches by
    their position in arrival order."""
    from flowspark.streaming.monitor import with_batch
    attacks = fx.stream_rule(fx.events(spark, sf)).where(F.col("Binary_Route") == config.ATTACK).drop("batch")
    return with_batch(attacks, ["event_id"], fx.STREAM_BATCH).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"),
        F.count_if("Anomaly").alias("anomalies"))


@register("running_kpis", _w(S.STREAM_RULE) + """SELECT batch,
  CAST(sum(n) OVER w AS BIGINT) AS total, CAST(sum(attacks) OVER w AS BIGINT) AS attacks,
  CAST(sum(n - attacks) OVER w AS BIGINT) AS benign, CAST(sum(anomalies) OVER w AS BIGINT) AS anomalies
FROM (SELECT batch, count(*) AS n, count_if("Binary_Route" = 'ATTACK') AS attacks,
             count_if("Anomaly") AS anomalies FROM ev GROUP BY batch)
WINDOW w AS (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_kpis(spark, sf):
    """Running totals after each batch."""
    from flowspark.streaming.monitor import per_batch, running_totals
    return running_totals(per_batch(fx.stream_rule(fx.events(spark, sf))))


@register("result_head", SCORED + f'SELECT flow_id, "Actual", {RESULT} FROM scored '
          f"ORDER BY {S.md5_key()} LIMIT {config.SMOKE_SAMPLE_ROWS}")
def result_head(spark, sf):
    """X1 (n=20) + L4: the smoke run -- 20 repeatably sampled flows, scored,
    next to their actual label, in flow order."""
    s = fx.rule_scored(spark, sf).scored.select("flow_id", "Actual", *rt.RESULT_COLUMNS)
    return smp.sample_exact(s, config.SMOKE_SAMPLE_ROWS).orderBy("flow_id") \
        .limit(config.RESULT_HEAD_ROWS)
