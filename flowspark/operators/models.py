"""Boosted-tree detector: binary model, attack-type model, two-stage scoring
(M1-M6, M10, M11).

* Binary (M1/M2/M4): ``GBTClassifier`` on the packed, scaled feature vector;
  ``p_attack`` is the margin's probability under an isotonic link fitted on
  rows held out of training (``probability[1]`` without one).  Early stopping follows the 10-round rule
  on the validation log loss: ``evaluateEachIteration`` gives the loss per
  round (one distributed pass), the best round is found on the driver (a
  list of <= max_iter numbers), and the trees after it are cut off.
* Attack type (M2/M3/M5): softmax boosting (:mod:`boosting`) over the classes
  in alphabetical order, trained on attack rows only, with the same early
  stopping.  ``OneVsRest(GBTClassifier)`` remains as the second form: its class
  margins ``m_k`` become probabilities ``sigmoid(2 m_k)`` normalised to sum 1.
* Two-stage scoring (M6/M10): stage 1 for every row; the attack-routed rows
  alone go through stage 2 and the autoencoder (a filter, so the Python UDF
  never sees BENIGN-routed rows), and the two branches are re-united.

GBT training caches its input (the training parquet table); trees are shipped
to the executors each round instead of caching node ids per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, OneVsRest,
                                       OneVsRestModel)
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark import config
from flowspark.operators import autoencoder as ae
from flowspark.operators import boosting as bo
from flowspark.operators import route as rt

VEC = "vec"


@dataclass
class GbtParams:
    max_iter: int = config.GBT_MAX_ROUNDS
    max_depth: int = config.GBT_MAX_DEPTH
    step: float = config.GBT_LEARNING_RATE
    subsample: float = config.GBT_BAGGING_FRACTION
    feature_fraction: float = config.GBT_FEATURE_FRACTION
    early_stop: int | None = config.GBT_EARLY_STOP
    max_bins: int = 32
    seed: int = config.SEED
    parallelism: int = 4


def with_vector(df: DataFrame, col: str = "features") -> DataFrame:
    """``array<float>`` features -> ML vector column ``vec``."""
    return df.withColumn(VEC, array_to_vector(F.col(col)))


def gbt(params: GbtParams, label: str) -> GBTClassifier:
    return GBTClassifier(featuresCol=VEC, labelCol=label, maxIter=params.max_iter,
                         maxDepth=params.max_depth, stepSize=params.step,
                         subsamplingRate=params.subsample,
                         featureSubsetStrategy=str(params.feature_fraction),
                         maxBins=params.max_bins, seed=params.seed,
                         # depth-5 trees are tiny to ship to executors; caching
                         # node ids per row (and checkpointing that cache) cost
                         # ~30 % more time here for the same model
                         cacheNodeIds=False)


def early_stop_round(losses: list[float], patience: int) -> int:
    """Rounds to keep: stop once ``patience`` rounds pass without a new best."""
    best, best_i = float("inf"), 0
    for i, loss in enumerate(losses):
        if loss < best:
            best, best_i = loss, i
        elif i - best_i >= patience:
            break
    return best_i + 1


def first_rounds(model: GBTClassificationModel, keep: int) -> GBTClassificationModel:
    """The model as it was after ``keep`` rounds: a round's tree does not
    depend on later ones."""
    sc = SparkContext.getOrCreate()
    jvm, java = sc._jvm, model._java_obj
    trees = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, keep)
    weights = sc._gateway.new_array(jvm.double, keep)
    for i, (tree, weight) in enumerate(zip(java.trees()[:keep], model.treeWeights[:keep])):
        trees[i], weights[i] = tree, weight
    short = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        model.uid, trees, weights, model.numFeatures, model.numClasses))
    return model._copyValues(short)


def fit_binary(train: DataFrame, val: DataFrame | None, params: GbtParams,
               label: str = "y") -> tuple[GBTClassificationModel, list[float]]:
    """M1/M2: binary model and its per-round validation losses."""
    est = gbt(params, label)
    model = est.fit(train)
    losses: list[float] = []
    if val is not None and params.early_stop:
        losses = list(model.evaluateEachIteration(val))
        keep = early_stop_round(losses, params.early_stop)
        if keep < params.max_iter:
            model = first_rounds(model, keep)
    return model, losses


def p_attack_col(prob_col: str = "probability") -> Column:
    """M4: probability of the ATTACK class."""
    return vector_to_array(F.col(prob_col))[1]


def fit_link(model: GBTClassificationModel, calibration: DataFrame, label: str = "y") -> IsotonicRegressionModel | None:
    """M4: probability by margin, fitted on rows that the model was not
    trained on.  A boosted model's own sigmoid stops short of 0 and 1 after
    few, small steps, so a route threshold of 0.01 would never be met.

    Margins are binned to 0.01 first: a model's margins are bounded by its
    tree weights, so the pooling of adjacent violators sees some thousand bins
    with their weights, however many rows there are.  None without rows of
    both classes."""
    margin = F.round(vector_to_array(F.col("rawPrediction"))[1], 2)
    bins = model.transform(calibration).groupBy(margin.alias("margin")).agg(
        F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias("weight"))
    span = bins.agg(F.min(label).alias("lo"), F.max(label).alias("hi")).first()
    if span["lo"] is None or span["hi"] == 0 or span["lo"] == 1:
        return None
    return IsotonicRegression(featuresCol="margin", labelCol=label, weightCol="weight", predictionCol="p_attack").fit(bins)


def score_binary(model: GBTClassificationModel, df: DataFrame, link: IsotonicRegressionModel | None = None) -> DataFrame:
    out = model.transform(df)
    if link is None:
        out = out.withColumn("p_attack", p_attack_col())
    else:
        out = link.transform(out.withColumn("margin", vector_to_array(F.col("rawPrediction"))[1])).drop("margin")
    return out.drop("rawPrediction", "probability", "prediction")


@dataclass
class AttackModel:
    ovr: OneVsRestModel
    classes: list[str]


def fit_attack(train: DataFrame, params: GbtParams, label_col: str = config.LABEL_NAME
               ) -> AttackModel:
    """M3: one-vs-rest boosted trees over the alphabetically coded classes."""
    indexer = StringIndexer(inputCol=label_col, outputCol="code",
                            stringOrderType="alphabetAsc").fit(train)
    coded = indexer.transform(train)
    ovr = OneVsRest(classifier=gbt(params, "code"), featuresCol=VEC, labelCol="code",
                    parallelism=params.parallelism).fit(coded)
    return AttackModel(ovr, list(indexer.labels))


def class_probs(raw: Column) -> Column:
    """M5: ``sigmoid(2 m_k)`` per class margin, normalised to sum 1."""
    s = F.transform(vector_to_array(raw), lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
    return F.transform(s, lambda x: x / F.aggregate(s, F.lit(0.0), lambda a, b: a + b))


def score_attack(model: AttackModel | bo.SoftmaxModel, df: DataFrame) -> DataFrame:
    if isinstance(model, bo.SoftmaxModel):
        return df.withColumn("probs", bo.probs_col(df.sparkSession, model, F.col("features")))
    out = model.ovr.transform(df).withColumn("probs", class_probs(F.col("rawPrediction")))
    return out.drop("rawPrediction", "prediction")


def score_two_stage(spark: SparkSession, df: DataFrame, binary: GBTClassificationModel,
                    attack: AttackModel | bo.SoftmaxModel, auto: ae.AEModel | None = None,
                    threshold: float = config.ATTACK_THRESHOLD, inclusive: bool = False,
                    keep: tuple[str, ...] = ("flow_id",),
                    link: IsotonicRegressionModel | None = None) -> DataFrame:
    """``flow_id, [Actual,] Final_Prediction, Binary_Route, Confidence,
    Anomaly, p_attack, probs, mse`` for every input row."""
    s1 = score_binary(binary, with_vector(df), link)
    is_atk = ~rt.is_benign(F.col("p_attack"), threshold, inclusive)
    benign = s1.where(~is_atk).withColumn("probs", F.lit(None).cast("array<double>")) \
        .withColumn("mse", F.lit(None).cast("double"))
    atk = score_attack(attack, s1.where(is_atk))
    if auto is not None:
        atk = atk.withColumn("mse", ae.mse_col(spark, auto, F.col("features")))
    else:
        atk = atk.withColumn("mse", F.lit(None).cast("double"))
    both = benign.unionByName(atk)
    thr = auto.threshold if auto is not None else None
    return rt.route(both, attack.classes, ae_threshold=thr, threshold=threshold,
                    inclusive=inclusive, keep=(*keep, "p_attack", "probs", "mse"))
