"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

A fingerprint has a bit set where over half of the text's shingle hashes
have it.  Two fingerprints link if they differ in at most ``max_bits`` bits.
The join walks pairs of trie nodes: a pair of equal depth carries the number
of bits in which the two paths differ, its children are paired in turn, and
a pair beyond the budget is dropped with everything below it.

The upper levels are a table of node pairs, taken down ``STRIDE`` bits at a
time; a pair whose two nodes hold at most ``CAPACITY`` fingerprints is
finished in one task over their two sorted arrays, a larger one goes further
down.  So a crowded part of the trie is split until it fits, and the work of
a task is bounded whatever the data.  A task returns, for the links that it
finds, one star per group of linked fingerprints; the groups are then joined
by connected components.  Nothing is dropped or capped: equal fingerprints
are one node, everything else is compared unless its budget is exceeded.

Defined results: text without words (or null) has fingerprint 0 and links
like any other.  Rows with a null id get a fingerprint but neither link nor
component.  Rows that repeat an id link to each other.  Columns named like
the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import slices, small_side, staged, text_or_empty
from flowspark.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
STRIDE = 4          # bits by which the table of node pairs goes down
CAPACITY = 65_536   # fingerprints that a task joins at once
_SPACES = re.compile("[\x20\x09-\x0D]")
_PAIRS = 1 << 19    # node pairs that a task expands at once


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64 bits; only A-Z are lowered, words end at ASCII spaces.  A
    long text is read by slices, which share ``shingle - 1`` words."""
    bits, total, words = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for part in slices(text, _SPACES):
        words += part.encode("utf-8", "surrogatepass").lower().split()
        if len(words) < shingle:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begins = np.concatenate([[0], ends[:-shingle]]).tolist()
        h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(begins, (ends[shingle - 1:] - 1).tolist())),
                        np.uint64, len(begins))
        for some in np.array_split(h, -(-len(h) // 65_536)):
            bits += np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        total += len(h)
        words = words[len(words) - shingle + 1:]
    if not total:
        if not words:
            return 0
        return digest(b" ".join(words), SEED)
    return int(np.packbits(bits * 2 > total, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """``docs`` with ``fp``, the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))
    return docs.withColumn("fp", fp(text_or_empty(text)))


# -- the walk inside a task ---------------------------------------------------

def _levels(x: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each depth, where each trie node begins in the sorted array."""
    out = []
    for d in range(depth, 65):
        p = x >> np.uint64(64 - d) if d else np.zeros(len(x), np.uint64)
        out.append(np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])) if len(x) else np.empty(0, np.int64))
    return out


def _children(x: np.ndarray, up: np.ndarray, down: np.ndarray, d: int) -> np.ndarray:
    """Rows of (left, right): the nodes one level down, -1 where none."""
    out = np.full((len(up), 2), -1, np.int64)
    bit = (x[down] >> np.uint64(63 - d)) & np.uint64(1)
    out[np.searchsorted(up, down, "right") - 1, bit.astype(np.int64)] = np.arange(len(down))
    return out


def linked_pairs(a: np.ndarray, b: np.ndarray | None, depth: int, differ: int,
                 max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of all linked pairs between two sorted arrays of
    distinct fingerprints, whose first ``depth`` bits are the same within
    each array and differ in ``differ`` bits between them; with b None, pairs
    i < j within a."""
    alone = b is None
    la = _levels(a, depth)
    ca = [_children(a, la[k], la[k + 1], depth + k) for k in range(64 - depth)]
    b, cb = (a, ca) if alone else (b, None)
    if cb is None:
        lb = _levels(b, depth)
        cb = [_children(b, lb[k], lb[k + 1], depth + k) for k in range(64 - depth)]
    if not len(a) or not len(b):
        return
    todo = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, differ, np.int64))]
    while todo:
        k, i, j, e = todo.pop()
        if len(i) > _PAIRS:   # depth first, in parts
            h = len(i) // 2
            todo += [(k, i[:h], j[:h], e[:h]), (k, i[h:], j[h:], e[h:])]
            continue
        if k == 64 - depth:
            keep = i < j if alone else slice(None)
            yield i[keep], j[keep]
            continue
        ii, jj, ee = [], [], []
        for x in (0, 1):
            for y in (0, 1):
                p, q, n = ca[k][i, x], cb[k][j, y], e + (x != y)
                ok = (p >= 0) & (q >= 0) & (n <= max_bits)
                if alone:
                    ok &= p <= q
                ii.append(p[ok])
                jj.append(q[ok])
                ee.append(n[ok])
        i, j, e = np.concatenate(ii), np.concatenate(jj), np.concatenate(ee)
        if len(i):
            todo.append((k + 1, i, j, e))


def _least_labels(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n nodes the smallest node it is linked to, over any path."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            if (a == b).all():
                break
            low = np.minimum(a, b)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while (label != label[label]).any():
                label = label[label]
    return label


def _join_nodes(max_bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        depth, differ = int(pdf["depth"].iloc[0]), int(pdf["differ"].iloc[0])
        pdf = pdf.assign(ufp=pdf["fp"].to_numpy(np.int64).view(np.uint64))
        left = pdf[pdf["side"] == 0].sort_values("ufp")
        right = pdf[pdf["side"] == 1].sort_values("ufp")
        alone = pdf["a"].iloc[0] == pdf["b"].iloc[0]
        a, b = left["ufp"].to_numpy(), right["ufp"].to_numpy()
        node = left["node"].to_numpy() if alone else np.concatenate([left["node"].to_numpy(), right["node"].to_numpy()])
        shift = 0 if alone else len(a)
        pairs = linked_pairs(a, None if alone else b, depth, differ, max_bits)
        label = _least_labels(len(node), ((i, j + shift) for i, j in pairs))
        at = np.flatnonzero(label != np.arange(len(node)))
        return pd.DataFrame({"u": node[at], "v": node[label[at]]})
    return run


# -- the upper levels, as tables ----------------------------------------------

def _prefix(fp: Column | str, depth: int) -> Column:
    """The first ``depth`` bits."""
    col = F.col(fp) if isinstance(fp, str) else fp
    return F.shiftrightunsigned(col, 64 - depth) if depth < 64 else col


def _node_pairs(spark: SparkSession, nodes: DataFrame, max_bits: int):
    """Yields (depth, pairs): node pairs (a, b, differ) that are small enough
    to finish in a task.  The loop ends at the leaves at the latest."""
    depth, open_pairs = 0, None
    while depth < 64:
        depth += STRIDE
        count = staged(spark, nodes.groupBy(_prefix("fp", depth).alias("p")).agg(F.count(F.lit(1)).alias("n")), "trie")
        up = F.shiftrightunsigned("p", STRIDE)
        below = count.select(up.alias("up"), "p")
        if open_pairs is None:   # all children of the root, paired
            open_pairs = spark.createDataFrame([(0, 0, 0)], "a long, b long, differ int")
        pairs = (open_pairs.join(below.select(F.col("up").alias("a"), F.col("p").alias("pa")), "a")
                 .join(below.select(F.col("up").alias("b"), F.col("p").alias("pb")), "b")
                 .withColumn("differ", F.col("differ") + F.bit_count(F.col("pa").bitwiseXOR(F.col("pb"))))
                 .where((F.col("differ") <= max_bits) & ((F.col("a") != F.col("b")) | (F.col("pa") <= F.col("pb"))))
                 .select(F.col("pa").alias("a"), F.col("pb").alias("b"), "differ"))
        sized = (pairs.join(count.select(F.col("p").alias("a"), F.col("n").alias("na")), "a")
                 .join(count.select(F.col("p").alias("b"), F.col("n").alias("nb")), "b")
                 .withColumn("small", F.lit(depth == 64) | (F.when(F.col("a") == F.col("b"), F.col("na"))
                                                            .otherwise(F.col("na") + F.col("nb")) <= CAPACITY)))
        sized = staged(spark, sized, "node-pairs")
        yield depth, sized.where("small").select("a", "b", "differ")
        open_pairs = sized.where("NOT small").select("a", "b", "differ")
        if open_pairs.isEmpty():
            return


def links(spark: SparkSession, nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v): links between nodes (fp, node) with distinct fingerprints,
    enough of them to connect whatever is linked."""
    found = None
    for depth, pairs in _node_pairs(spark, nodes, max_bits):
        sides = (pairs.select(F.col("a").alias("p"), "a", "b", "differ", F.lit(0).alias("side"))
                 .unionByName(pairs.where("a <> b").select(F.col("b").alias("p"), "a", "b", "differ", F.lit(1).alias("side"))))
        rows = (nodes.withColumn("p", _prefix("fp", depth)).join(sides, "p").drop("p")
                .withColumn("depth", F.lit(depth)))
        part = rows.groupBy("a", "b").applyInPandas(_join_nodes(max_bits), "u long, v long")
        found = part if found is None else found.unionByName(part)
    return found


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``."""
    prints = staged(spark, with_fingerprints(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), shingle).drop("text"), "prints")
    named = prints.where(F.col("doc_id").isNotNull())
    nodes = staged(spark, named.groupBy("fp").agg(F.min("doc_id").alias("node")), "print-nodes")
    # an id with several fingerprints ties these together
    repeated = (named.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y")
                .select("doc_id").join(named, "doc_id").join(nodes, "fp")
                .select(F.col("doc_id").alias("u"), F.col("node").alias("v")))
    found = components(spark, links(spark, nodes, max_bits).unionByName(repeated))
    of_fp = nodes.join(found.withColumnRenamed("component", "_c"), "node", "left").select(
        "fp", F.coalesce("_c", "node").alias("component_id"))
    return (prints.join(of_fp, "fp", "left")
            .select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def group_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return digest(near_duplicates(spark, docs))


def keep_first(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id, with its
    columns; documents without an id all stay."""
    found = near_duplicates(spark, docs)
    gone = staged(spark, found.where(F.col("doc_id") != F.col("component_id"))
                  .select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    repeated = staged(spark, docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1")
                      .select(F.col("doc_id").alias("_repeated")), "repeated")
    kept = docs.join(small_side(gone), docs["doc_id"] == gone["_gone"], "left_anti")
    again = small_side(repeated)
    once = kept.join(again, kept["doc_id"] == repeated["_repeated"], "left_anti")
    # rows that repeat an id: the first by text stays
    several = kept.join(again, kept["doc_id"] == repeated["_repeated"], "left_semi")
    first = (several.select("doc_id", F.struct("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).alias("_by"))
             .groupBy("doc_id").agg(F.min("_by").alias("_by")))
    return once.unionByName(first.select("_by.row.*"))
