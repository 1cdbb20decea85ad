"""Autoencoder anomaly model.

Network: ``d -> 48 -> 24 -> 12 -> 24 -> 48 -> d`` linear layers, ReLU after
every hidden layer except the 12-wide bottleneck, linear output, MSE loss,
Adam (lr 1e-3), mini-batches of 1024.

Training is data-parallel local SGD (Zinkevich et al. 2010; Stich 2019):

* the training rows are hash-partitioned into ``shards`` once and the
  result is checkpointed (lineage cut in the shared checkpoint folder) as one
  matrix an Arrow batch, so epochs never reshuffle or unpack the data;
* one Spark job per epoch: ``mapInArrow`` runs Adam over its shard's rows,
  streaming their matrices through 1024-row mini-batches, starting from the
  broadcast global weights and optimiser moments, and emits its final
  parameter vector once;
* the vectors are averaged (weighted by rows) with a grouped aggregate over
  parameter positions -- the driver only ever receives the averaged model
  (10,602 weights + the two Adam moments), whatever the data size;
* the validation rows sit in the same shards: each epoch's job also sums
  their errors under the weights it started from (the previous epoch's
  result), so an epoch costs one pass; the best epoch's weights are kept,
  with early stopping after ``patience`` epochs without improvement.

Inference (M8) is an Arrow-batched ``pandas_udf`` with broadcast weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowspark import config
from flowspark.session import table_exists

ADAM_B1, ADAM_B2, ADAM_EPS = 0.9, 0.999, 1e-8


def widths_for(n_features: int, hidden: list[int] = config.AE_LAYERS) -> list[int]:
    return [n_features, *hidden, n_features]


def relu_after(widths: list[int]) -> list[bool]:
    """ReLU after each layer but the bottleneck and the output."""
    n = len(widths) - 1
    bottleneck = n // 2 - 1
    return [i not in (bottleneck, n - 1) for i in range(n)]


def n_params(widths: list[int]) -> int:
    return sum(a * b + b for a, b in zip(widths[:-1], widths[1:]))


def unflatten(flat: np.ndarray, widths: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    layers, o = [], 0
    for a, b in zip(widths[:-1], widths[1:]):
        w = flat[o:o + a * b].reshape(a, b)
        o += a * b
        layers.append((w, flat[o:o + b]))
        o += b
    return layers


def init_params(widths: list[int], seed: int = config.SEED) -> np.ndarray:
    """Uniform(+-1/sqrt(fan_in)) weights and biases (the usual linear-layer init)."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(widths[:-1], widths[1:]):
        bound = 1.0 / np.sqrt(a)
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts).astype(np.float64)


def forward(flat: np.ndarray, widths: list[int], x: np.ndarray) -> tuple[np.ndarray, list]:
    acts = [x]
    h = x
    for (w, b), relu in zip(unflatten(flat.astype(np.float32, copy=False), widths),
                            relu_after(widths)):
        h = h @ w + b
        if relu:
            h = np.maximum(h, 0.0)
        acts.append(h)
    return h, acts


def loss_and_grad(flat: np.ndarray, widths: list[int], x: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean squared error over all cells and its gradient (flat, float64)."""
    out, acts = forward(flat, widths, x)
    diff = out - x
    loss = float(np.mean(diff.astype(np.float64) ** 2))
    d = (2.0 / diff.size) * diff
    layers = unflatten(flat.astype(np.float32, copy=False), widths)
    relus = relu_after(widths)
    grads = []
    for i in range(len(layers) - 1, -1, -1):
        if relus[i]:
            d = d * (acts[i + 1] > 0)
        w, _ = layers[i]
        grads.append((acts[i].T @ d, d.sum(axis=0)))
        d = d @ w.T
    grads.reverse()
    return loss, np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in grads]) \
        .astype(np.float64)


def adam_step(p, m, v, g, t, lr):
    m = ADAM_B1 * m + (1 - ADAM_B1) * g
    v = ADAM_B2 * v + (1 - ADAM_B2) * g * g
    mh = m / (1 - ADAM_B1 ** t)
    vh = v / (1 - ADAM_B2 ** t)
    return p - lr * mh / (np.sqrt(vh) + ADAM_EPS), m, v


@dataclass
class AEModel:
    widths: list[int]
    params: np.ndarray
    threshold: float | None = None
    history: list[tuple[int, float, float, bool]] = field(default_factory=list)
    validation: dict = field(default_factory=dict)     # A18/A19 on the validation rows


def _matrix(series: pd.Series, width: int) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, width), dtype=np.float32)
    return np.stack(series.to_numpy()).astype(np.float32)


def reconstruct_col(spark: SparkSession, model: AEModel, x: Column) -> Column:
    """M8: reconstruction ``array<float>`` of the feature array ``x``."""
    bc = spark.sparkContext.broadcast(model.params.astype(np.float32))
    widths = list(model.widths)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _rec(s: pd.Series) -> pd.Series:
        out, _ = forward(bc.value, widths, _matrix(s, widths[0]))
        return pd.Series(list(out))

    return _rec(x)


def mse_col(spark: SparkSession, model: AEModel, x: Column) -> Column:
    """M8+P20: per-row mean squared reconstruction error (double)."""
    bc = spark.sparkContext.broadcast(model.params.astype(np.float32))
    widths = list(model.widths)

    @F.pandas_udf(T.DoubleType())
    def _mse(s: pd.Series) -> pd.Series:
        xm = _matrix(s, widths[0])
        out, _ = forward(bc.value, widths, xm)
        return pd.Series(np.mean((xm - out).astype(np.float64) ** 2, axis=1))

    return _mse(x)


_BLOCK = "n long, x binary, val binary"


def _pack(rows: DataFrame, width: int) -> DataFrame:
    """``features, is_val`` as one matrix an Arrow batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column("features").flatten(), dtype=np.float32).reshape(b.num_rows, width)
                val = b.column("is_val").to_numpy(zero_copy_only=False).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.num_rows], pa.int64()), pa.array([x.tobytes()], pa.binary()), pa.array([val.tobytes()], pa.binary())],
                    names=["n", "x", "val"])

    return rows.select("features", "is_val").mapInArrow(run, _BLOCK)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in batches:
        for n, x, val in zip(*(b.column(c) for c in ("n", "x", "val"))):
            yield (np.frombuffer(x.as_buffer(), np.float32).reshape(n.as_py(), width), np.frombuffer(val.as_buffer(), bool))


def _epoch_fn(bc_state, widths, lr, batch, epoch, seed):
    def run(batches):
        p, m, v, t0 = bc_state.value
        p, m, v = p.copy(), m.copy(), v.copy()
        p_start = p.astype(np.float32)
        t = t0
        val_sum, val_n = 0.0, 0
        # per shard and epoch; a retried task reads the same partition with the
        # same seed, so a lost executor does not change the result
        ctx = TaskContext.get()
        rng = np.random.default_rng([seed, epoch, ctx.partitionId() if ctx else 0])
        n_rows, loss_sum, steps = 0, 0.0, 0
        pending = []
        pending_n = 0

        def step(xb):
            nonlocal p, m, v, t, loss_sum, steps
            loss, g = loss_and_grad(p, widths, xb)
            t += 1
            p, m, v = adam_step(p, m, v, g, t, lr)
            loss_sum += loss
            steps += 1

        for x, is_val in _blocks(batches, widths[0]):
            if is_val.any():
                # validation rows: error of the weights this epoch started from
                xv = x[is_val]
                out, _ = forward(p_start, widths, xv)
                val_sum += float(np.mean((xv - out).astype(np.float64) ** 2, axis=1).sum())
                val_n += len(xv)
            xm = x[~is_val]
            if len(xm) == 0:
                continue
            xm = xm[rng.permutation(len(xm))]
            n_rows += len(xm)
            pending.append(xm)
            pending_n += len(xm)
            if pending_n >= batch:
                buf = np.concatenate(pending)
                full = (len(buf) // batch) * batch
                for i in range(0, full, batch):
                    step(buf[i:i + batch])
                pending = [buf[full:]] if full < len(buf) else []
                pending_n = len(buf) - full
        if pending_n:
            step(np.concatenate(pending))
        if n_rows or val_n:
            # not by way of pandas, which makes NaN null: a diverged shard must show in the average
            row = (n_rows, steps, loss_sum, val_sum, val_n, np.concatenate([p, m, v]))
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, _EPOCH_ARROW)], schema=_EPOCH_ARROW)
    return run


_EPOCH_SCHEMA = ("n long, steps long, loss_sum double, val_sum double, val_n long, "
                 "state array<double>")
_EPOCH_ARROW = pa.schema([("n", pa.int64()), ("steps", pa.int64()), ("loss_sum", pa.float64()), ("val_sum", pa.float64()),
                          ("val_n", pa.int64()), ("state", pa.list_(pa.float64()))])


def _average(out: DataFrame, size: int) -> tuple[np.ndarray, dict]:
    """Train-row-weighted mean of the shard states, by parameter position, in
    one grouped aggregate; step count, loss sum and validation error sum /
    count ride along as extra positions (summed, not averaged)."""
    names = ["steps", "loss_sum", "val_sum", "val_n"]
    extras = F.array(*[F.col(c).cast("double") for c in names])
    cells = out.select("n", F.posexplode(F.concat("state", extras)).alias("i", "v"))
    agg = cells.groupBy("i").agg(
        F.try_divide(F.sum(F.col("v") * F.col("n")), F.sum("n")).alias("mean"),
        F.sum("v").alias("total"), F.count(F.lit(1)).alias("shards"))
    vec = np.zeros(size, dtype=np.float64)
    stats = {"shards": 0}
    for r in agg.collect():          # one row per parameter position (model-sized)
        i = r["i"]
        if i < size:
            vec[i] = r["mean"] if r["mean"] is not None else 0.0
        else:
            stats[names[i - size]] = float(r["total"])
            stats["shards"] = int(r["shards"])
    return vec, stats


def mean_error(spark: SparkSession, model: AEModel, df: DataFrame, col: str = "features") -> float:
    mean = df.select(mse_col(spark, model, F.col(col)).alias("e")).agg(F.avg("e")).first()[0]
    return float("nan") if mean is None else float(mean)     # the udf's NaN is null


def train(spark: SparkSession, train_df: DataFrame, val_df: DataFrame, n_features: int,
          epochs: int = config.AE_MAX_EPOCHS, patience: int = config.AE_PATIENCE,
          lr: float = config.AE_LEARNING_RATE, batch: int = config.AE_BATCH_SIZE,
          shards: int | None = None, seed: int = config.SEED,
          key_col: str = "flow_id") -> AEModel:
    """M7: local-SGD training with best-epoch selection and early stopping.

    One pass over the data per epoch: the validation rows live in the same
    shards and each epoch's job scores them with the weights the epoch
    started from, i.e. the previous epoch's result, so the early-stopping
    decision for epoch e is made by job e+1 (one final evaluation covers the
    last epoch).  The history and the kept weights are those of the
    train-then-validate loop.

    An error without training or validation rows, and if no epoch has a finite
    validation loss: weights that were never fitted are no model."""
    from flowspark.session import shared_dir
    shared_dir(spark)
    widths = widths_for(n_features)
    size = n_params(widths)
    shards = shards or spark.sparkContext.defaultParallelism
    rows = train_df.select(key_col, "features", F.lit(False).alias("is_val")).unionByName(
        val_df.select(key_col, "features", F.lit(True).alias("is_val")))
    data = _pack(rows.repartition(shards, key_col), n_features).checkpoint()
    p = init_params(widths, seed)
    m = np.zeros_like(p)
    v = np.zeros_like(p)
    t = 0
    model = AEModel(widths, p.copy())
    best = {"loss": float("inf"), "p": p.copy(), "wait": 0}

    def record(epoch_no: int, train_loss: float, weights: np.ndarray, val_loss: float) -> bool:
        improved = val_loss < best["loss"]
        model.history.append((epoch_no, train_loss, val_loss, improved))
        if improved:
            best.update(loss=val_loss, p=weights, wait=0)
            return False
        best["wait"] += 1
        return best["wait"] >= patience

    pending = None                     # (epoch number, train loss, weights) awaiting validation
    stopped = False
    for epoch in range(epochs):
        bc = spark.sparkContext.broadcast((p, m, v, t))
        out = data.mapInArrow(_epoch_fn(bc, widths, lr, batch, epoch, seed), _EPOCH_SCHEMA)
        state, st = _average(out, 3 * size)
        bc.unpersist()
        if not st.get("steps") or not st.get("val_n"):
            raise ValueError(f"the autoencoder has no {'validation' if st.get('steps') else 'training'} rows")
        if pending is not None and record(*pending, st["val_sum"] / max(st["val_n"], 1.0)):
            stopped = True
            break
        p, m, v = state[:size], state[size:2 * size], state[2 * size:]
        t += max(1, round(st["steps"] / max(st["shards"], 1)))
        pending = (epoch + 1, st["loss_sum"] / max(st["steps"], 1.0), p.copy())
    if pending is not None and not stopped:
        record(*pending, mean_error(spark, AEModel(widths, pending[2]), val_df))
    if model.history and not np.isfinite(best["loss"]):
        raise ArithmeticError("the autoencoder's training diverged: no epoch has a finite validation loss")
    model.params = best["p"]
    return model


def error_stats(errors: DataFrame, err_col: str = "mse") -> DataFrame:
    """Mean, population std and threshold = mean + 3 std."""
    e = F.col(err_col)
    return errors.agg(F.avg(e).alias("err_mean"), F.stddev_pop(e).alias("err_std")) \
        .withColumn("threshold", F.col("err_mean") + 3 * F.col("err_std"))


def fit_threshold(spark: SparkSession, model: AEModel, val_df: DataFrame) -> float:
    """M9: threshold from the best weights' errors on the validation rows,
    then A19: how many validation rows it flags (errors are written once to
    the shared folder and read by both aggregates)."""
    from flowspark.session import write_table
    errs = write_table(spark, val_df.select(mse_col(spark, model, F.col("features")).alias("mse")),
                       "ae-val-errors")
    st = error_stats(errs).first()
    if st["threshold"] is None or not np.isfinite(st["threshold"]):
        raise ArithmeticError(f"the autoencoder's threshold is {st['threshold']}")
    model.threshold = float(st["threshold"])
    flagged = errs.agg(F.count(F.lit(1)).alias("n"),
                       F.count_if(F.col("mse") > F.lit(model.threshold)).alias("anomalies")).first()
    model.validation = {"err_mean": float(st["err_mean"]), "err_std": float(st["err_std"]),
                        "threshold": model.threshold, "n": int(flagged["n"]),
                        "anomalies": int(flagged["anomalies"])}
    return model.threshold


def validation_frame(spark: SparkSession, model: AEModel) -> DataFrame:
    """A18/A19 of the trained model: error mean/std, threshold, flagged rows."""
    v = model.validation
    rate = 100.0 * v["anomalies"] / v["n"] if v.get("n") else None
    return spark.createDataFrame(
        [(v.get("err_mean"), v.get("err_std"), v.get("threshold"), v.get("n"), v.get("anomalies"),
          rate)],
        "err_mean double, err_std double, threshold double, n long, anomalies long, "
        "rate_pct double")


def history_frame(spark: SparkSession, model: AEModel) -> DataFrame:
    """Epoch, train loss, validation loss, best-so-far flag."""
    schema = "epoch int, train_loss double, val_loss double, best boolean"
    return spark.createDataFrame(model.history, schema)


# ---- persistence (S9 / S10): weights as a small parquet table ----------------

def save(spark: SparkSession, model: AEModel, path: str) -> None:
    rows = [(i, a, b, w.astype(np.float32).ravel().tolist(), bb.astype(np.float32).tolist())
            for i, ((w, bb), a, b) in enumerate(zip(unflatten(model.params, model.widths),
                                                     model.widths[:-1], model.widths[1:]))]
    schema = "layer int, n_in int, n_out int, weight array<float>, bias array<float>"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/layers")
    spark.createDataFrame([(model.threshold,)], "threshold double").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/threshold")


def load(spark: SparkSession, path: str) -> AEModel | None:
    """The autoencoder is optional; None when either table is absent.  A
    table that is there but cannot be read is an error."""
    if not all(table_exists(spark, f"{path}/{part}") for part in ("layers", "threshold")):
        return None
    layers = sorted(spark.read.parquet(f"{path}/layers").collect(), key=lambda r: r["layer"])
    thr = spark.read.parquet(f"{path}/threshold").first()["threshold"]
    widths = [layers[0]["n_in"]] + [r["n_out"] for r in layers]
    flat = np.concatenate([np.concatenate([np.asarray(r["weight"], np.float64),
                                           np.asarray(r["bias"], np.float64)]) for r in layers])
    return AEModel(widths, flat, thr)
