"""Retraining flow (M12): scaler -> autoencoder -> binary model -> attack model.

One shared preparation: the flows are prepared, robust-scaled, packed and
given both stratified 80/20 flags, and that table is written once as a
parquet table in the shared folder; every learner reads it from there (its
label filters pushed into the scan), so the raw tables are scanned a single
time per training run.

The scaler is fitted on all rows, the autoencoder's weights on all benign rows
of its training split and its threshold on all of its validation split; the
explanation background is 200 rows (X2).
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from flowspark import config
from flowspark.operators import autoencoder as ae
from flowspark.operators import boosting as bo
from flowspark.operators import models as md
from flowspark.operators import prepare as prep
from flowspark.operators import route as rt
from flowspark.operators import sampling as smp
from flowspark.operators import scaler as sc
from flowspark.session import write_table

# The contract's training parameters (200 boosting rounds, early stopping of
# both models): the default, and those of the registered queries.
CONTRACT_GBT = md.GbtParams()


@dataclass
class Bundle:
    data: DataFrame                      # flow_id, Label, features, is_val_bin, is_val
    params: dict[str, tuple[float, float]]
    binary: GBTClassificationModel
    losses: list[float]
    attack: bo.SoftmaxModel
    auto: ae.AEModel | None
    extras: dict = field(default_factory=dict)
    link: IsotonicRegressionModel | None = None     # probability by margin of the binary model
    order: list[str] = field(default_factory=lambda: list(config.FEATURE_ORDER))
    log1p: list[str] = field(default_factory=lambda: list(config.LOG1P_COLUMNS))
    threshold: float = config.ATTACK_THRESHOLD

    def prepare(self, raw: DataFrame, keep: tuple[str, ...] = ("flow_id", config.LABEL_NAME)) -> DataFrame:
        """New flows -> the model input, by the bundle's own contract."""
        return prepare_for_scoring(raw, self.params, keep, self.order, self.log1p)


def prepared_table(spark: SparkSession, raw: DataFrame, label_col: str = config.LABEL_NAME,
                   order: Sequence[str] = config.FEATURE_ORDER, log1p: Sequence[str] = config.LOG1P_COLUMNS
                   ) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Prepare, fit the scaler, scale, pack, split; the prepared flows are
    written once, for the scaler's passes and its application."""
    prepared = write_table(spark, prep.prepare(raw, ("flow_id", label_col), order, log1p), "prepared")
    absent = [n for n in order if n not in set(raw.columns)]
    params = sc.scaler_params(sc.fit_scaler(prepared, order, absent))
    return split_table(prep.pack(sc.apply_scaler(prepared, params, order), order), label_col), params


def split_table(scaled_packed: DataFrame, label_col: str = config.LABEL_NAME) -> DataFrame:
    """Labelled rows with both stratified 80/20 flags (X3), written once:
    ``is_val_bin`` stratified by the binary target (binary model) and
    ``is_val`` stratified by class (attack model: its attack rows)."""
    labelled = scaled_packed.where(F.col(label_col).isNotNull())   # Q8: null label = unlabelled
    binned = labelled.withColumn("_bin", rt.binary_label(F.col(label_col)))
    split = smp.split_by_cut(smp.split_by_cut(binned, "_bin", out="is_val_bin"), label_col).drop("_bin")
    # a parquet table: the learners' label filters (benign rows, attack rows)
    # are pushed into its scan
    return write_table(scaled_packed.sparkSession, split, "training")


def train_autoencoder(spark: SparkSession, data: DataFrame, label_col: str = config.LABEL_NAME,
                      epochs: int = config.AE_MAX_EPOCHS, width: int = len(config.FEATURE_ORDER)) -> ae.AEModel:
    """M7/M9: weights and threshold on all BENIGN rows (F2), 80/20."""
    benign = data.where(F.col(label_col) == config.BENIGN).select("flow_id", "features")
    split = smp.split_random(benign)
    tr, va = split.where(~F.col("is_val")), split.where(F.col("is_val"))
    # by the rows, not by the cores: the model is the same on any cluster
    shards = max(config.AE_SHARDS, -(-benign.count() // config.AE_SHARD_ROWS))
    model = ae.train(spark, tr, va, width, epochs=epochs, shards=shards)
    ae.fit_threshold(spark, model, va)
    return model


MODELS = ("autoencoder", "binary", "attack")


class TrainedBundle(Bundle):
    """The models of one split, each trained when it is first asked for:
    none needs another.  ``fit`` trains several at the same time; their jobs
    are many and short, so one model alone leaves most cores idle."""

    def __init__(self, spark: SparkSession, data: DataFrame, params: dict[str, tuple[float, float]], gbt: md.GbtParams,
                 with_autoencoder: bool, label_col: str):
        self.data, self.params = data, params
        self.extras: dict = {"seconds": {}}
        self.order, self.log1p, self.threshold = list(config.FEATURE_ORDER), list(config.LOG1P_COLUMNS), config.ATTACK_THRESHOLD
        self._spark, self._gbt, self._with_autoencoder, self._label = spark, gbt, with_autoencoder, label_col
        self._models: dict[str, object] = {}

    def fit(self, *names: str) -> TrainedBundle:
        """Trains the named models that are not trained yet."""
        missing = [n for n in dict.fromkeys(names) if n not in self._models]
        if missing:
            with ThreadPoolExecutor(len(missing)) as pool:
                running = {n: pool.submit(inheritable_thread_target(self._spark)(self._train), n) for n in missing}
            for n, f in running.items():
                self._models[n] = f.result()
        return self

    def _train(self, name: str) -> object:
        t0 = time.time()
        model = {"autoencoder": self._autoencoder, "binary": self._binary, "attack": self._attack}[name]()
        self.extras["seconds"][name] = round(time.time() - t0, 3)
        return model

    def _autoencoder(self) -> ae.AEModel | None:
        return train_autoencoder(self._spark, self.data, self._label, width=len(self.params)) if self._with_autoencoder else None

    def _binary(self) -> tuple[GBTClassificationModel, list[float], IsotonicRegressionModel | None]:
        vec = md.with_vector(self.data).withColumn("y", rt.binary_target(F.col(self._label)).cast("double"))
        # the link's rows are neither trained on nor reported on; a seed of their
        # own makes them independent of the split
        apart = smp.key_uniform(smp.sample_key("flow_id", config.SEED + 1)) < config.CALIBRATION_FRACTION
        fitted, held = vec.where(~F.col("is_val_bin")), vec.where(F.col("is_val_bin"))
        binary, losses = md.fit_binary(fitted.where(~apart), held, self._gbt)
        return binary, losses, md.fit_link(binary, fitted.where(apart))

    def _attack(self) -> bo.SoftmaxModel:
        attacks = self.data.where(F.col(self._label) != config.BENIGN)
        return bo.fit(attacks.where(~F.col("is_val")), attacks.where(F.col("is_val")), self._gbt, self._label)

    @property
    def binary(self) -> GBTClassificationModel:
        return self.fit("binary")._models["binary"][0]

    @property
    def losses(self) -> list[float]:
        return self.fit("binary")._models["binary"][1]

    @property
    def link(self) -> IsotonicRegressionModel | None:
        return self.fit("binary")._models["binary"][2]

    @property
    def attack(self) -> bo.SoftmaxModel:
        return self.fit("attack")._models["attack"]

    @property
    def auto(self) -> ae.AEModel | None:
        return self.fit("autoencoder")._models["autoencoder"]


def train(spark: SparkSession, raw: DataFrame, gbt: md.GbtParams = CONTRACT_GBT,
          with_autoencoder: bool = True, label_col: str = config.LABEL_NAME,
          order: Sequence[str] = config.FEATURE_ORDER, log1p: Sequence[str] = config.LOG1P_COLUMNS) -> Bundle:
    """M12 from raw flows; ``order`` and ``log1p`` (S6) stay with the bundle."""
    data, params = prepared_table(spark, raw, label_col, order, log1p)
    b = train_prepared(spark, data, params, gbt, with_autoencoder, label_col).fit(*MODELS)
    b.order, b.log1p = list(order), list(log1p)
    return b


def train_prepared(spark: SparkSession, data: DataFrame, params: dict[str, tuple[float, float]],
                   gbt: md.GbtParams = CONTRACT_GBT, with_autoencoder: bool = True,
                   label_col: str = config.LABEL_NAME) -> TrainedBundle:
    """M12 from the split, packed, scaled table (seconds by model in ``extras``)."""
    return TrainedBundle(spark, data, params, gbt, with_autoencoder, label_col)


_CACHE: dict[tuple, TrainedBundle] = {}
_OVR: dict[tuple, md.AttackModel] = {}


def bundle_for(spark: SparkSession, sf_dir: str, *models: str) -> TrainedBundle:
    """The fixture bundle of a dataset, each model trained at most once per
    session; ``models`` (of ``MODELS``) at the same time, others when they
    are asked for."""
    from flowspark.plans.fixtures import scaled_flows
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        s = scaled_flows(spark, sf_dir)      # the session's scaled table (fitted once)
        _CACHE[key] = train_prepared(spark, split_table(prep.pack(s.df)), s.params)
    return _CACHE[key].fit(*models) if models else _CACHE[key]


def one_vs_rest_for(spark: SparkSession, sf_dir: str) -> md.AttackModel:
    """The second form of the attack model on the same split, trained where
    it is asked for."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _OVR:
        rows = bundle_for(spark, sf_dir).data.where((F.col(config.LABEL_NAME) != config.BENIGN) & ~F.col("is_val"))
        _OVR[key] = md.fit_attack(md.with_vector(rows), CONTRACT_GBT)
    return _OVR[key]


def score(spark: SparkSession, b: Bundle, df: DataFrame | None = None,
          inclusive: bool = False) -> DataFrame:
    """Two-stage scoring of the prepared rows (default: every labelled flow)."""
    d = b.data if df is None else df
    return md.score_two_stage(spark, d, b.binary, b.attack, b.auto, threshold=b.threshold, inclusive=inclusive,
                              keep=("flow_id",), link=b.link)


def prepare_for_scoring(raw: DataFrame, params: dict[str, tuple[float, float]],
                        keep: tuple[str, ...] = ("flow_id", config.LABEL_NAME),
                        order: Sequence[str] = config.FEATURE_ORDER,
                        log1p: Sequence[str] = config.LOG1P_COLUMNS) -> DataFrame:
    """New flows -> the packed, scaled model input with the fitted scaler."""
    return prep.pack(sc.apply_scaler(prep.prepare(raw, keep, order, log1p), params, order), order)
