"""Softmax boosting of the attack types (M2, M3, M5): Newton steps on
histograms that Spark adds up.

* Every feature is cut at quantiles of the training rows (``percentile_approx``,
  one aggregate over the features that vary) and a row becomes its bin numbers,
  one byte a feature that has cuts.  Some ten thousand rows are one block of
  matrices, feature by feature, kept by the executors between passes (spilled
  to disk where memory is short).
* A round grows one tree a class, all classes together, one pass over the
  blocks a level.  The round's first pass adds the last round's trees to the
  margins.  A task takes each class's gradient ``p - y`` and Hessian, and adds
  them up by (class, node, feature, bin); tasks add up the tasks' sums, the
  driver does so itself while they are few.  The result, ``classes x
  2^(depth-1) x features x bins`` cells at most however many rows there are,
  gives the splits on the driver.
* Of a split node's children only the one with fewer rows is counted; the other
  is what remains of the node.  Whole numbers leave no rounding.
* Two features share a table of their bins while rows are counted (its margins
  are the features' own sums), and a tree is walked for all rows of a block at
  once by the comparisons of its nodes as bytes.
* Gradients are whole multiples of 2^-24, so their sums, and with them the
  model, do not depend on partitions, order or retried tasks.
* The blocks are written to the shared folder every ``REFRESH`` rounds: a lost
  executor costs its tasks and a few rounds' trees.
* Early stop (M2): the validation rows' log loss comes with the first pass of
  the next round; after ``early_stop`` rounds without a better one the trees
  behind the best round are cut off.  Nothing is fitted twice.

Rows without a label are left out.  Without rows there are no classes; with
one class there are no trees.  A class that only validation rows have counts
there with the least probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowspark import config
from flowspark.session import write_table

if TYPE_CHECKING:
    from flowspark.operators.models import GbtParams

REFRESH = 10            # rounds between two writings of the margins
TASK_ROWS = 131_072     # training rows of a pass's task at least, where there are so many
BLOCK_ROWS = 65_536     # rows of a block at most, about
WALK_ROWS = 16_384      # rows that go through a tree at once: a few dozen byte columns of them fit the cache
MAX_TO_DRIVER = 32 << 20    # bytes of the tasks' sums that the driver adds up itself
MIN_ROWS = 20           # training rows a leaf holds at least
MIN_HESSIAN = 1e-3
RIDGE = 1.0             # added to a leaf's Hessian
ACCURACY = 10_000       # of the quantiles that cut the features
UNIT = float(1 << 24)   # gradients are counted in units of its inverse
LEAST_P = 1e-15
LEAF = -1


@dataclass
class Trees:
    """Trees of ``rounds x classes``, nodes in heap order; a node without a
    feature is a leaf."""
    feature: np.ndarray      # (R, K, N) int16, LEAF at a leaf
    cut: np.ndarray          # (R, K, N) uint8: a row goes left if its bin is at most this
    value: np.ndarray        # (R, K, N) float64, learning rate included

    @staticmethod
    def empty(rounds: int, classes: int, depth: int) -> Trees:
        shape = (rounds, classes, (2 << depth) - 1)
        return Trees(np.full(shape, LEAF, np.int16), np.zeros(shape, np.uint8), np.zeros(shape))

    def rounds(self, start: int, end: int | None = None) -> Trees:
        return Trees(self.feature[start:end], self.cut[start:end], self.value[start:end])

    def then(self, other: Trees) -> Trees:
        return Trees(*(np.concatenate([getattr(self, n), getattr(other, n)]) for n in ("feature", "cut", "value")))


@dataclass
class SoftmaxModel:
    classes: list[str]
    prior: np.ndarray                # (K,) margin before the first tree
    cuts: list[np.ndarray]           # per feature, ascending; the bin is the number of cuts below the value
    trees: Trees
    losses: list[float] = field(default_factory=list)

    @property
    def depth(self) -> int:
        return (self.trees.feature.shape[2] + 1).bit_length() - 2

    def nodes(self, k: int) -> list[tuple[float, dict]]:
        """Class ``k``'s trees as (weight, {node: (feature, threshold, left,
        right, value)}), its prior as a tree of one leaf."""
        out: list[tuple[float, dict]] = [(1.0, {0: (None, None, -1, -1, float(self.prior[k]))})]
        for r in range(len(self.trees.feature)):
            tree, todo = {}, [0]
            while todo:
                i = todo.pop()
                f, value = int(self.trees.feature[r, k, i]), float(self.trees.value[r, k, i])
                if f == LEAF:
                    tree[i] = (None, None, -1, -1, value)
                else:
                    tree[i] = (f, float(self.cuts[f][self.trees.cut[r, k, i]]), 2 * i + 1, 2 * i + 2, value)
                    todo += [2 * i + 1, 2 * i + 2]
            out.append((1.0, tree))
        return out


def bins_of(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Rows' bin numbers (R, F) as bytes."""
    out = np.zeros(x.shape, np.uint8)
    for f, c in enumerate(cuts):
        if len(c):
            out[:, f] = np.searchsorted(c, x[:, f], side="left")
    return out


def _merged(right: np.ndarray, a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
    """``b`` where ``right`` is 1, else ``a``; None is all zeros."""
    if a is None:
        return None if b is None else b & right
    if b is None:
        return a & (right ^ 1)
    return a ^ ((a ^ b) & right)


def _turns(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray, node: int, levels: int) -> list[np.ndarray | None]:
    """Per level below ``node`` which rows go right (bytes of 0 and 1); behind
    a leaf all go left."""
    f = feature[node]
    if not levels or f == LEAF:
        return [None] * levels
    right = (bins[f] > cut[node]).view(np.uint8)
    left_turns, right_turns = (_turns(feature, cut, bins, 2 * node + i, levels - 1) for i in (1, 2))
    return [right, *(_merged(right, a, b) for a, b in zip(left_turns, right_turns))]


def places_of(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray, level: int) -> np.ndarray:
    """Each row's place (R,) among the nodes of a level of one tree, of bins
    (F, R); a row whose way ends above has the leftmost place below its leaf."""
    out = np.zeros(bins.shape[1], np.uint8 if level <= 8 else np.int64)
    for start in range(0, len(out), WALK_ROWS):
        part = out[start:start + WALK_ROWS]
        for turn in _turns(feature, cut, bins[:, start:start + WALK_ROWS], 0, level):
            part <<= 1
            if turn is not None:
                part |= turn
    return out


def ends(feature: np.ndarray, level: int) -> np.ndarray:
    """Per place of a level the node of one tree at which its way ends."""
    node = np.zeros(1 << level, np.int64)
    for i in range(level):
        turn = (np.arange(1 << level) >> (level - 1 - i)) & 1
        node = np.where(feature[node] == LEAF, node, 2 * node + 1 + turn)
    return node


def _plus_trees(margin: np.ndarray, trees: Trees, bins: np.ndarray) -> np.ndarray:
    """Margins (K, R) with the trees' values added, of bins (F, R)."""
    rounds, n_classes, nodes = trees.feature.shape
    depth = (nodes + 1).bit_length() - 2
    margin = margin.copy()
    for k in range(n_classes):
        for r in range(rounds):
            if (feature := trees.feature[r, k])[0] == LEAF:
                margin[k] += trees.value[r, k, 0]
            else:
                margin[k] += trees.value[r, k, ends(feature, depth)][places_of(feature, trees.cut[r, k], bins, depth)]
    return margin


def add_trees(margin: np.ndarray, trees: Trees, bins: np.ndarray) -> np.ndarray:
    """Margins (R, K) with the trees' values added, of bins (R, F)."""
    return _plus_trees(np.ascontiguousarray(margin.T), trees, np.ascontiguousarray(bins.T)).T


def softmax(margin: np.ndarray) -> np.ndarray:
    """Probabilities of margins (K, R)."""
    if len(margin) == 0:
        return margin
    e = np.exp(margin - margin.max(axis=0))
    return e / reduce(np.add, e)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), width)


# --- cutting and packing ----------------------------------------------------

def fit_cuts(df: DataFrame, width: int, bins: int, col: str = "features") -> list[np.ndarray]:
    """At most ``bins - 1`` cuts a feature, each a value of it but the largest."""
    if width == 0:
        return []
    shares = [i / bins for i in range(1, bins)]
    x = [F.col(col)[i].cast("double") for i in range(width)]
    span = df.agg(*[f(x[i]).alias(f"{n}{i}") for i in range(width) for n, f in (("least", F.min), ("most", F.max))]).first()
    varied = [i for i in range(width) if span[f"least{i}"] != span[f"most{i}"]]
    found = df.agg(*[F.percentile_approx(x[i], shares, ACCURACY).alias(f"q{i}") for i in varied]).first() if varied else None
    return [np.array(sorted({v for v in found[f"q{i}"] or [] if v < span[f"most{i}"]}) if i in varied else []) for i in range(width)]


@dataclass
class Block:
    """Some training and validation rows: what a pass needs of them."""
    code: np.ndarray         # (R,) class, -1 if training rows have no such class
    val: np.ndarray          # (R,) bool
    draw: np.ndarray         # (R,) int64
    bins: np.ndarray         # (F, R) uint8, of the features that have cuts
    margin: np.ndarray       # (K, R) float64

    def plus(self, trees: Trees) -> Block:
        return Block(self.code, self.val, self.draw, self.bins, _plus_trees(self.margin, trees, self.bins))


BLOCK = "n long, code binary, val binary, draw binary, bins binary, margin binary"


def _block_batch(blocks: list[Block]) -> pa.RecordBatch:
    columns = [pa.array([len(b.code) for b in blocks], pa.int64())]
    for name in ("code", "val", "draw", "bins", "margin"):
        columns.append(pa.array([np.ascontiguousarray(getattr(b, name)).tobytes() for b in blocks], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in BLOCK.split(", ")])


def _block(row, width: int, n_classes: int) -> Block:
    n = row["n"]
    return Block(np.frombuffer(row["code"], np.int32), np.frombuffer(row["val"], bool), np.frombuffer(row["draw"], np.int64),
                 np.frombuffer(row["bins"], np.uint8).reshape(width, n),
                 np.frombuffer(row["margin"], np.float64).reshape(n_classes, n))


def _joined(blocks: list[Block]) -> Block:
    return Block(*(np.concatenate([getattr(b, n) for b in blocks]) for n in ("code", "val", "draw")),
                 *(np.concatenate([getattr(b, n) for b in blocks], axis=1) for n in ("bins", "margin")))


def _pack(df: DataFrame, cuts: list[np.ndarray], classes: list[str], prior: np.ndarray, label: str, val: Column) -> DataFrame:
    """The rows as blocks at the prior's margins, with the bins of the
    features that have cuts."""
    names = F.array(*[F.lit(c) for c in classes]) if classes else F.array().cast("array<string>")
    coded = df.select((F.array_position(names, F.col(label)) - 1).cast("int").alias("code"), val.alias("val"),
                      F.xxhash64("flow_id", "features").alias("draw"), "features")
    start = np.asarray(prior, np.float64)[:, None]
    used = [f for f, c in enumerate(cuts) if len(c)]

    def block(b: pa.RecordBatch) -> Block:
        x = _matrix(b.column("features"), len(cuts))
        return Block(b.column("code").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32),
                     b.column("val").to_numpy(zero_copy_only=False).astype(bool),
                     b.column("draw").to_numpy(zero_copy_only=False),
                     np.stack([np.searchsorted(cuts[f], x[:, f], side="left").astype(np.uint8) for f in used]),
                     np.tile(start, (1, b.num_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[Block] = []
        for b in batches:
            if b.num_rows:
                waiting.append(block(b))
                if sum(len(w.code) for w in waiting) >= BLOCK_ROWS:
                    yield _block_batch([_joined(waiting)])
                    waiting = []
        if waiting:
            yield _block_batch([_joined(waiting)])

    return coded.mapInArrow(run, BLOCK)


def _held(table: DataFrame, width: int, n_classes: int, tasks: int) -> RDD:
    """The table's blocks, kept by the executors between passes of ``tasks``
    tasks at most."""
    return table.coalesce(tasks).rdd.map(lambda r: _block(r, width, n_classes)).persist(StorageLevel.MEMORY_AND_DISK)


def _written(spark: SparkSession, blocks: RDD) -> DataFrame:
    """The blocks as a table: cuts their lineage."""
    def run(part: Iterator[Block]) -> Iterator[tuple]:
        for b in part:
            yield tuple(v[0].as_py() for v in _block_batch([b]).columns)

    return write_table(spark, spark.createDataFrame(blocks.mapPartitions(run), BLOCK), "boosting")


# --- one pass ---------------------------------------------------------------

def drawn(draw: np.ndarray, round_no: int, fraction: float) -> np.ndarray:
    """Which rows a round uses, by a mix of the row's hash and the round."""
    with np.errstate(over="ignore"):
        z = draw.astype(np.uint64) + np.uint64(round_no + 1) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) < np.uint64(min(int(fraction * 2.0 ** 64), 2 ** 64 - 1))


def _added(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b))


def _tables(cells: np.ndarray, place: np.ndarray, weights: tuple[np.ndarray | None, ...], n_nodes: int, n_bins: int) -> np.ndarray:
    """Sums (weights, nodes, features, bins) of the rows' weights, None for
    their number; ``cells`` are their bins (F, R).  All are whole numbers, so
    their sums are exact."""
    out = np.zeros((len(weights), n_nodes, len(cells), n_bins), np.int64)
    together = 2 if n_nodes * n_bins * n_bins <= max(len(place), 1) else 1
    node = place.astype(np.intp) * n_bins ** together
    for f in range(0, len(cells), together):
        both = f + 1 < len(cells) and together == 2
        at = node + (cells[f].astype(np.intp) if together == 1 else
                     cells[f].astype(np.uint16) * np.uint16(n_bins) + (cells[f + 1] if both else np.uint16(0)))
        for i, w in enumerate(weights):
            sums = np.bincount(at, w, n_nodes * n_bins ** together)
            if together == 1:
                out[i, :, f] = sums.reshape(n_nodes, n_bins)
            else:
                pair = sums.reshape(n_nodes, n_bins, n_bins)
                out[i, :, f] = pair.sum(axis=2)
                if both:
                    out[i, :, f + 1] = pair.sum(axis=1)
    return out


def _fewer_rows(grown: Trees, level: int, rows: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Which nodes (K, nodes) of the next level have fewer rows than their
    sibling, the left one of two equals; ``rows`` are a level's (K, nodes,
    used, bins)."""
    n_nodes = 1 << level
    out = np.zeros((len(rows), 2 * n_nodes), bool)
    for k, j in np.argwhere(grown.feature[0, :, n_nodes - 1:2 * n_nodes - 1] != LEAF):
        i = n_nodes - 1 + j
        at = rows[k, j, np.searchsorted(used, grown.feature[0, k, i])]
        out[k, 2 * j + int(2 * at[:grown.cut[0, k, i] + 1].sum() > at.sum())] = True
    return out


def _with_siblings(sums: np.ndarray, counted: np.ndarray, above: np.ndarray) -> np.ndarray:
    """A level's sums (3, K, nodes, used, bins), completed from those of the
    level above."""
    for k, j in np.argwhere(counted):
        sums[:, k, j ^ 1] = above[:, k, j >> 1] - sums[:, k, j]
    return sums


def _level_sums(blocks: RDD, grown: Trees, level: int, round_no: int, used: np.ndarray, n_bins: int,
                fraction: float, counted: np.ndarray) -> tuple[np.ndarray, int, int]:
    """One level's sums (3, cells) of gradients, Hessians and rows, a cell
    for each (class, node of the level, used feature, bin), all whole
    numbers, of the ``counted`` nodes (K, nodes), else 0; the validation rows'
    loss in units, and their number."""
    n_classes, n_nodes, n_used = grown.feature.shape[1], 1 << level, len(used)
    size = n_classes * n_nodes * n_used * n_bins

    def run(part: Iterator[Block]) -> Iterator[tuple]:
        sums = np.zeros((3, n_classes, n_nodes, n_used, n_bins), np.int64)
        loss, held = 0, 0
        for b in part:
            if level == 0 and b.val.any():
                p = softmax(b.margin[:, b.val])
                code = b.code[b.val]
                own = np.where(code >= 0, p[np.maximum(code, 0), np.arange(len(code))], 0.0)
                loss += int(np.rint(-np.log(np.maximum(own, LEAST_P)) * UNIT).sum())
                held += len(own)
            used_rows = np.flatnonzero(~b.val & (b.code >= 0) & drawn(b.draw, round_no, fraction))
            bins, margin, code = b.bins[:, used_rows], b.margin[:, used_rows], b.code[used_rows]
            p = softmax(margin)
            g = p.copy()
            g[code, np.arange(len(code))] -= 1.0
            h = p * (1.0 - p) * (n_classes / max(n_classes - 1, 1))
            g, h = np.rint(g * UNIT), np.rint(h * UNIT)
            for k in np.flatnonzero(counted.any(axis=1)):
                place = places_of(grown.feature[0, k], grown.cut[0, k], bins, level)
                if counted[k].all():
                    sums[:, k] += _tables(bins, place, (g[k], h[k], None), n_nodes, n_bins)
                else:
                    # places below a leaf of a level above are no nodes and never counted
                    here = np.flatnonzero(counted[k][place])
                    sums[:, k] += _tables(bins[:, here], place[here], (g[k][here], h[k][here], None), n_nodes, n_bins)
        yield sums.reshape(3, size), loss, held

    parts, none = blocks.mapPartitions(run), (np.zeros((3, size), np.int64), 0, 0)
    if blocks.getNumPartitions() * none[0].nbytes <= MAX_TO_DRIVER:
        found = parts.collect()
        return reduce(_added, found, none)
    # tasks add up the tasks' sums; the driver gets a few
    return parts.treeAggregate(none, _added, _added, 2)


# --- splits of one level ----------------------------------------------------

def _score(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def split_level(grown: Trees, level: int, sums: np.ndarray, used: np.ndarray, allowed: np.ndarray, step: float) -> bool:
    """Sets the level's best splits and the values of their children; ``sums``
    is (3, K, nodes, used, bins).  Ties go to the first feature and cut."""
    g, h, n = sums
    if level == 0:
        grown.value[0, :, 0] = -step * g[:, 0, 0].sum(1) / (h[:, 0, 0].sum(1) + RIDGE)
    left = np.cumsum(sums, axis=4)
    gl, hl, nl = left
    gr, hr, nr = left[..., -1:] - left
    gain = _score(gl, hl) + _score(gr, hr) - _score(gl + gr, hl + hr)
    fits = (nl >= MIN_ROWS) & (nr >= MIN_ROWS) & (hl >= MIN_HESSIAN) & (hr >= MIN_HESSIAN) & allowed[:, None, :, None]
    gain = np.where(fits, gain, 0.0)
    any_split = False
    n_bins = gain.shape[3]
    for k in range(gain.shape[0]):
        for j in range(gain.shape[1]):
            best = int(np.argmax(gain[k, j]))
            u, b = divmod(best, n_bins)
            if gain[k, j, u, b] <= 1e-9:
                continue
            any_split = True
            i = (1 << level) - 1 + j
            grown.feature[0, k, i], grown.cut[0, k, i] = used[u], b
            grown.value[0, k, 2 * i + 1] = -step * gl[k, j, u, b] / (hl[k, j, u, b] + RIDGE)
            grown.value[0, k, 2 * i + 2] = -step * gr[k, j, u, b] / (hr[k, j, u, b] + RIDGE)
    return any_split


# --- fitting ----------------------------------------------------------------

def fit(train: DataFrame, val: DataFrame | None, params: GbtParams, label: str = config.LABEL_NAME) -> SoftmaxModel:
    """M2/M3: softmax model of ``label`` over ``features`` and its validation
    log loss before the first and after every round."""
    spark = train.sparkSession
    train = train.where(F.col(label).isNotNull())
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(counts)
    total = sum(counts.values())
    prior = np.log([counts[c] / total for c in classes])
    first = train.select(F.size("features").alias("w")).first()
    width = first["w"] if first else 0
    cuts = fit_cuts(train, width, params.max_bins)
    used = np.flatnonzero([len(c) > 0 for c in cuts])
    model = SoftmaxModel(classes, prior, cuts, Trees.empty(0, len(classes), params.max_depth))
    if len(classes) < 2 or not len(used):
        return model

    columns = ["flow_id", "features", label]
    rows = train.select(*columns, F.lit(False).alias("_val"))
    stop = params.early_stop if val is not None else None
    if stop:
        rows = rows.union(val.where(F.col(label).isNotNull()).select(*columns, F.lit(True)))
    tasks = 1 + total // TASK_ROWS
    blocks = _held(write_table(spark, _pack(rows, cuts, classes, prior, label, F.col("_val")), "boosting"),
                   len(used), len(classes), tasks)
    # grown over the features that have cuts, numbered among themselves
    inner = SoftmaxModel(classes, prior, [cuts[f] for f in used], model.trees)
    try:
        for blocks in _rounds(spark, blocks, inner, np.arange(len(used)), params, stop, tasks):
            pass
    finally:
        blocks.unpersist()
    named = np.where(inner.trees.feature == LEAF, LEAF, used[inner.trees.feature]).astype(np.int16)
    model.trees, model.losses = Trees(named, inner.trees.cut, inner.trees.value), inner.losses
    return model


def _rounds(spark: SparkSession, blocks: RDD, model: SoftmaxModel, used: np.ndarray, params: GbtParams,
            stop: int | None, tasks: int) -> Iterator[RDD]:
    """Grows the model's trees round by round; yields the blocks in force."""
    width, n_classes = len(model.cuts), len(model.classes)
    n_bins = 1 + max(len(c) for c in model.cuts)
    share = max(1, round(params.feature_fraction * len(used)))
    best, best_at = np.inf, 0
    for r in range(params.max_iter + 1):
        last = r == params.max_iter
        if last and not stop:
            return
        allowed = np.zeros((n_classes, len(used)), bool)
        for k in range(n_classes):
            chosen = np.random.default_rng([params.seed, r, k]).permutation(len(used))[:share]
            allowed[k, chosen] = True
        before = blocks
        if r:
            # the last round's trees go into the margins with this round's first pass
            newest = model.trees.rounds(r - 1)
            blocks = blocks.map(lambda b, newest=newest: b.plus(newest))
            if r % REFRESH == 0:
                blocks = _held(_written(spark, blocks), width, n_classes, tasks)
            else:
                blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
            yield blocks
        grown = Trees.empty(1, n_classes, params.max_depth)
        split = False
        counted, above = np.ones((n_classes, 1), bool), None
        for level in range(params.max_depth):
            sums, loss, held = _level_sums(blocks, grown, level, r, used, n_bins, params.subsample, counted)
            if level == 0 and r:
                before.unpersist()
            if level == 0 and stop:
                loss = loss / UNIT / held if held else 0.0
                model.losses.append(float(loss))
                if loss < best:
                    best, best_at = loss, r
                if last or (held and r - best_at >= stop):
                    model.trees = model.trees.rounds(0, best_at if held else r)
                    return
            sums = sums.reshape(3, n_classes, -1, len(used), n_bins)
            above = _with_siblings(sums, counted, above) if level else sums
            cells = above.astype(np.float64)
            cells[:2] /= UNIT
            if not split_level(grown, level, cells, used, allowed, params.step):
                break
            counted = _fewer_rows(grown, level, above[2], used)
            split = True
        if not split:
            break
        model.trees = model.trees.then(grown)
    if stop and model.losses:
        model.trees = model.trees.rounds(0, best_at)


# --- scoring, saving --------------------------------------------------------

def probs_col(spark: SparkSession, model: SoftmaxModel, x: Column) -> Column:
    """M5: class probabilities ``array<double>`` of the feature array ``x``;
    the model is broadcast, its size is rounds x classes x 63 nodes."""
    bc = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def probs(s: pd.Series) -> pd.Series:
        m = bc.value
        if not len(s):
            return pd.Series([], dtype=object)
        bins = np.ascontiguousarray(bins_of(np.stack(s.to_numpy()).astype(np.float64), m.cuts).T)
        margin = _plus_trees(np.tile(np.asarray(m.prior, np.float64)[:, None], (1, len(s))), m.trees, bins)
        return pd.Series(list(np.ascontiguousarray(softmax(margin).T)))

    return probs(x)


def save(spark: SparkSession, model: SoftmaxModel, path: str) -> None:
    """One row a round and class, and one row of what all share."""
    trees = model.trees
    rows = [(r, k, trees.feature[r, k].tolist(), trees.cut[r, k].tolist(), trees.value[r, k].tolist())
            for r in range(len(trees.feature)) for k in range(len(model.classes))]
    spark.createDataFrame(rows, "round int, class int, feature array<int>, cut array<int>, value array<double>") \
        .coalesce(1).write.parquet(f"{path}/trees")
    spark.createDataFrame([(model.classes, [float(p) for p in model.prior], [c.tolist() for c in model.cuts], model.depth,
                            model.losses)],
                          "classes array<string>, prior array<double>, cuts array<array<double>>, depth int, "
                          "losses array<double>").coalesce(1).write.parquet(f"{path}/shared")


def load(spark: SparkSession, path: str) -> SoftmaxModel:
    s = spark.read.parquet(f"{path}/shared").first()
    rows = spark.read.parquet(f"{path}/trees").orderBy("round", "class").collect()
    k = len(s["classes"])
    trees = Trees.empty(len(rows) // max(k, 1), k, s["depth"])
    for row in rows:
        at = row["round"], row["class"]
        trees.feature[at], trees.cut[at], trees.value[at] = row["feature"], row["cut"], row["value"]
    return SoftmaxModel(list(s["classes"]), np.array(s["prior"]), [np.array(c) for c in s["cuts"]], trees, list(s["losses"]))
