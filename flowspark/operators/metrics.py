"""Evaluation reports as DataFrames.

Shape of every report: one grouped aggregate over the scored rows (map-side
partial aggregation, output bounded by the number of classes or of distinct
scores), then arithmetic on that small table.  No report gathers raw rows
into one task; the only unpartitioned windows run over per-class tables and
block totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark import config
from flowspark.operators.prefix import prefix_sums
from flowspark.operators.route import binary_label

EPS_LOGLOSS = 1e-15


def _div(a: Column, b: Column) -> Column:
    """a / b with 0 when b == 0 (scikit's zero_division=0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def label_distribution(df: DataFrame, label_col: str = config.LABEL_NAME) -> DataFrame:
    """A1: class counts, largest first."""
    return df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), "label")


def binary_counts(df: DataFrame, label_col: str = config.LABEL_NAME) -> DataFrame:
    """A2: rows per binary target (BENIGN = 0, ATTACK = 1)."""
    lab = F.col(label_col)
    return df.agg(F.count_if(lab == config.BENIGN).alias("benign_0"),
                  F.count_if(lab != config.BENIGN).alias("attack_1"))


def distinct_classes(df: DataFrame, label_col: str = config.LABEL_NAME,
                     exclude: Sequence[str] = (config.BENIGN,)) -> DataFrame:
    """Sorted distinct classes with their 0-based code."""
    lab = F.col(label_col)
    d = df.select(lab.alias("label")).where(lab.isNotNull() & ~lab.isin(*exclude)).distinct()
    return d.select("label", (F.row_number().over(Window.orderBy("label")) - 1)
                    .cast("int").alias("code"))


def summary_counts(scored: DataFrame) -> DataFrame:
    """Total / attack / benign by final prediction."""
    benign = F.col("Final_Prediction") == config.BENIGN
    return scored.agg(F.count(F.lit(1)).alias("total_rows"),
                      F.count_if(~benign).alias("attack_rows"),
                      F.count_if(benign).alias("benign_rows"))


def summary_percent(scored: DataFrame) -> DataFrame:
    """Counts, share of all rows, anomaly count (0 without the column)."""
    benign = F.col("Final_Prediction") == config.BENIGN
    anomaly = F.count_if(F.col("Anomaly")) if "Anomaly" in scored.columns else F.lit(0).cast("long")
    agg = scored.agg(F.count(F.lit(1)).alias("total"), F.count_if(benign).alias("benign_count"),
                     F.count_if(~benign).alias("attack_count"), anomaly.alias("anomaly_count"))
    return agg.select(
        "total", "benign_count",
        F.try_divide(F.lit(100.0) * F.col("benign_count"), F.col("total")).alias("benign_pct"),
        "attack_count",
        F.try_divide(F.lit(100.0) * F.col("attack_count"), F.col("total")).alias("attack_pct"),
        "anomaly_count")


def attack_distribution(scored: DataFrame) -> DataFrame:
    """Attack types among predictions, % of ALL rows, largest first."""
    g = scored.groupBy("Final_Prediction").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))   # over <= #classes rows
    return g.select("Final_Prediction", "count",
                    (F.lit(100.0) * F.col("count") / total).alias("pct")) \
        .where(F.col("Final_Prediction") != config.BENIGN) \
        .orderBy(F.desc("count"), "Final_Prediction")


def confusion_binary(scored: DataFrame, actual: str = "Actual",
                     pred: str = "Binary_Route") -> DataFrame:
    """2x2 matrix in long form, fixed label order, zeros kept."""
    a = binary_label(F.col(actual))
    p = F.col(pred)
    labels = [config.BENIGN, config.ATTACK]
    cells = [(x, y) for x in labels for y in labels]
    agg = scored.where(F.col(actual).isNotNull()).agg(
        *[F.count_if((a == x) & (p == y)).alias(f"c{i}") for i, (x, y) in enumerate(cells)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(x).alias("actual"), F.lit(y).alias("predicted"),
                 F.col(f"c{i}").alias("count")) for i, (x, y) in enumerate(cells)]))
    return agg.select(rows.alias("r")).select("r.*")


def confusion_multiclass(scored: DataFrame, actual: str = "Actual",
                         pred: str = "Final_Prediction") -> DataFrame:
    """A10: labels = sorted distinct actual attack classes; predictions
    outside them are dropped (scikit's ``labels=``); zeros kept.

    One scan: grouped counts become one row a class, with its counts by
    prediction, and each row is laid out over the list of classes.  Nothing
    is larger than the matrix, whatever the number of classes."""
    a, p = F.col(actual), F.col(pred)
    cells = scored.where(a.isNotNull() & (a != config.BENIGN)).groupBy(a.alias("actual"), p.alias("p")) \
        .agg(F.count(F.lit(1)).alias("n"))
    row = F.map_from_entries(F.collect_list(F.when(F.col("p").isNotNull(), F.struct("p", "n"))))
    rows = cells.groupBy("actual").agg(row.alias("counts")) \
        .withColumn("labels", F.collect_list("actual").over(Window.partitionBy(F.lit(1))))
    return rows.select("actual", "counts", F.explode("labels").alias("predicted")).select(
        "actual", "predicted", F.coalesce(F.try_element_at("counts", F.col("predicted")), F.lit(0)).cast("long").alias("count"))


def per_class_counts(scored: DataFrame, actual: str, pred: str) -> DataFrame:
    """``cls, support, tp, predicted`` for every class in actual or predicted."""
    pairs = scored.groupBy(F.col(actual).alias("a"), F.col(pred).alias("p")) \
        .agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    zero = F.lit(0).cast("long")
    contrib = F.explode(F.array(
        F.struct(F.col("a").alias("cls"), n.alias("support"),
                 F.when(F.col("a") == F.col("p"), n).otherwise(zero).alias("tp"),
                 zero.alias("pred")),
        F.struct(F.col("p").alias("cls"), zero.alias("support"), zero.alias("tp"),
                 n.alias("pred"))))
    return pairs.select(contrib.alias("c")).select("c.*").groupBy("cls").agg(
        F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("pred").alias("pred"))


def classification_report(scored: DataFrame, actual: str, pred: str) -> DataFrame:
    """Per-class precision / recall / F1 / support, then accuracy, macro
    and weighted averages (scikit layout, 0/0 -> 0)."""
    pc = per_class_counts(scored, actual, pred)
    per = pc.select(
        F.col("cls").alias("class"),
        _div(F.col("tp"), F.col("pred")).alias("precision"),
        _div(F.col("tp"), F.col("support")).alias("recall"),
        _div(2 * F.col("tp"), F.col("support") + F.col("pred")).alias("f1_score"),
        F.col("support").cast("long").alias("support"),
        F.col("tp"),
    )
    tot = F.sum("support")
    summ = per.agg(
        F.try_divide(F.sum("tp"), tot).alias("acc"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), tot).alias("wp"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), tot).alias("wr"),
        F.try_divide(F.sum(F.col("f1_score") * F.col("support")), tot).alias("wf"),
        tot.cast("long").alias("n"))
    nulld = F.lit(None).cast("double")
    extra = summ.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), nulld.alias("precision"), nulld.alias("recall"),
                 F.col("acc").alias("f1_score"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1_score"),
                 F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1_score"),
                 F.col("n").alias("support")),
    )).alias("r")).select("r.*")
    return per.drop("tp").unionByName(extra)


def accuracy_f1(scored: DataFrame, actual: str = "Actual") -> DataFrame:
    """Binary accuracy and F1 (ATTACK positive) of the route, and
    accuracy and support-weighted F1 of the final class on attack rows."""
    lab = scored.where(F.col(actual).isNotNull())
    yb = binary_label(F.col(actual))
    pb = F.col("Binary_Route")
    tp = F.count_if((yb == config.ATTACK) & (pb == config.ATTACK))
    fp = F.count_if((yb == config.BENIGN) & (pb == config.ATTACK))
    fn = F.count_if((yb == config.ATTACK) & (pb == config.BENIGN))
    b = lab.agg(F.avg((yb == pb).cast("double")).alias("binary_accuracy"),
                _div(2 * tp, 2 * tp + fp + fn).alias("binary_f1"))
    atk = lab.where(F.col(actual) != config.BENIGN)
    pc = per_class_counts(atk, actual, "Final_Prediction")
    f1 = _div(2 * F.col("tp"), F.col("support") + F.col("pred"))
    m = pc.agg(F.try_divide(F.sum("tp"), F.sum("support")).alias("attack_accuracy"),
               F.try_divide(F.sum(f1 * F.col("support")), F.sum("support"))
               .alias("attack_weighted_f1"))
    return _one_row_pair(b, m)


def _one_row_pair(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side-by-side of two single-row aggregates (joined on a constant key)."""
    k = F.lit(1).alias("_one")
    return a.select(k, "*").join(b.select(k, "*"), "_one").drop("_one")


def roc_points(df: DataFrame, y: Column, score: Column) -> DataFrame:
    """Cumulative TP/FP per distinct score, descending.

    Scores are grouped first (map-side combine) and summed over ranges of
    scores, block by block, so no task sees all of them."""
    g = df.groupBy(score.alias("threshold")).agg(
        F.sum(y.cast("long")).alias("pos"), F.sum((1 - y).cast("long")).alias("neg"))
    return prefix_sums(g, ["threshold"], {"tps": "pos", "fps": "neg"}, descending=True) \
        .withColumnsRenamed({"tps_total": "P", "fps_total": "N"})


def roc_curve(df: DataFrame, y: Column, score: Column, drop_intermediate: bool = True) -> DataFrame:
    """``threshold, fpr, tpr`` with the (0, 0) start point at +inf and
    collinear intermediate points dropped (scikit's default)."""
    pts = roc_points(df, y, score)
    if drop_intermediate:
        first = (F.col("tps") == F.col("pos")) & (F.col("fps") == F.col("neg"))
        pts = pts.where(first | F.col("tps_next").isNull() | (F.col("tps_next") != F.col("pos"))
                        | (F.col("fps_next") != F.col("neg")))
    curve = pts.select("threshold", F.try_divide(F.col("fps"), F.col("N")).alias("fpr"),
                       F.try_divide(F.col("tps"), F.col("P")).alias("tpr"))
    start = pts.agg(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                    F.lit(0.0).alias("tpr"))
    return start.unionByName(curve)


def roc_auc(df: DataFrame, y: Column, score: Column) -> DataFrame:
    """Trapezoidal area under the ROC curve: a step of ``neg`` false
    positives at the mean of the true positives before and after it."""
    p = roc_points(df, y, score)
    height = F.col("tps").cast("double") - F.col("pos") / F.lit(2.0)
    return p.agg(F.sum(F.try_divide(F.col("neg").cast("double"), F.col("N"))
                       * F.try_divide(height, F.col("P"))).alias("auc"))


def class_accuracy(scored: DataFrame, actual: str = "Actual",
                   pred: str = "Final_Prediction") -> DataFrame:
    """Per attack class: samples, correctly predicted, accuracy."""
    atk = scored.where(F.col(actual).isNotNull() & (F.col(actual) != config.BENIGN))
    g = atk.groupBy(F.col(actual).alias("class")).agg(
        F.count(F.lit(1)).alias("samples"),
        F.count_if(F.col(actual) == F.col(pred)).alias("correct"))
    return g.withColumn("accuracy", F.col("correct") / F.col("samples"))


def anomaly_rate(df: DataFrame, err_col: str, threshold: float) -> DataFrame:
    """Anomaly count and rate (%) of reconstruction errors above the threshold."""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col(err_col) > F.lit(threshold)).alias("anomalies")) \
        .withColumn("rate_pct", F.try_divide(F.lit(100.0) * F.col("anomalies"), F.col("n")))


def log_loss_binary(df: DataFrame, y: Column, p: Column) -> DataFrame:
    """Mean binary cross-entropy with p clipped to [1e-15, 1 - 1e-15]."""
    pc = F.least(F.greatest(p, F.lit(EPS_LOGLOSS)), F.lit(1 - EPS_LOGLOSS))
    loss = F.when(y == 1, -F.log(pc)).otherwise(-F.log(F.lit(1.0) - pc))
    return df.agg(F.avg(loss).alias("log_loss"), F.count(F.lit(1)).alias("n"))


def log_loss_multi(df: DataFrame, p_true: Column) -> DataFrame:
    """Mean multiclass cross-entropy of the true-class probability."""
    loss = -F.log(F.greatest(p_true, F.lit(EPS_LOGLOSS)))
    return df.agg(F.avg(loss).alias("log_loss"), F.count(F.lit(1)).alias("n"))


def actual_vs_predicted(scored: DataFrame, actual: str = "Actual",
                        pred: str = "Final_Prediction") -> DataFrame:
    """Per class, actual and predicted counts on attack-labelled rows
    (full outer alignment of the two count series, gaps -> 0)."""
    atk = scored.where(F.col(actual).isNotNull() & (F.col(actual) != config.BENIGN))
    a = atk.groupBy(F.col(actual).alias("label")).agg(F.count(F.lit(1)).alias("actual_count"))
    p = atk.groupBy(F.col(pred).alias("label")).agg(F.count(F.lit(1)).alias("predicted_count"))
    return a.join(p, "label", "full_outer").fillna(0, ["actual_count", "predicted_count"])


def matrix_stats(packed: DataFrame, col: str = "features") -> DataFrame:
    """A5: shape, min, max, mean, population std over ALL cells.  The
    explode feeds a map-side partial aggregate: no exploded row is shuffled."""
    cells = packed.select(F.explode(col).alias("v"), F.size(col).alias("w"))
    return cells.agg(
        (F.count(F.lit(1)) / F.max("w")).cast("long").alias("n_rows"),
        F.max("w").cast("long").alias("n_cols"),
        F.min("v").cast("double").alias("min"), F.max("v").cast("double").alias("max"),
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def split_counts(df: DataFrame, label_col: str = config.LABEL_NAME,
                 split_col: str = "is_val") -> DataFrame:
    """Rows per (class, split)."""
    return df.groupBy(F.col(label_col).alias("label"), F.col(split_col).alias("is_val")) \
        .agg(F.count(F.lit(1)).alias("n"))
