"""Repeatable sampling and splits.

Every row gets a key ``md5('<seed>:<id>')``; Spark and DuckDB agree on it,
for any id type.  Sampling keeps the ``n`` rows with the smallest keys.

Scale: a plain ``orderBy(key).limit(n)`` lets every partition send its own
top ``n`` to one merging task (partitions x n rows).  Instead, one pass counts
rows below 33 dyadic thresholds of the key's 32-bit prefix; the smallest
threshold holding at least ``n`` rows is used as a filter, which keeps a
*prefix* of the key order (so the result is identical) with between n and
about 2n rows, and only those reach the final top-n merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark import config
from flowspark.session import write_table

_PREFIX_BITS = 32
MAX_BROADCAST_CLASSES = 100_000     # one short row each


def sample_key(id_col: str | Column, seed: int = config.SEED) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def key_prefix(key: Column) -> Column:
    """First 32 bits of the md5 hex key as a non-negative long."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def key_uniform(key: Column) -> Column:
    """A uniform number in [0, 1) from the key prefix."""
    return key_prefix(key) / F.lit(float(2 ** _PREFIX_BITS))


def sample_exact(df: DataFrame, n: int, id_col: str = "flow_id",
                 seed: int = config.SEED) -> DataFrame:
    """Exactly ``min(n, count)`` rows, the same on every run."""
    key = sample_key(id_col, seed)
    pre = key_prefix(key)
    counts = df.select(pre.alias("_p")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("_p") < F.lit(1 << j)).alias(f"c{j}")
          for j in range(_PREFIX_BITS)],
    ).first()
    if counts["total"] <= n:
        return df
    bound = None
    for j in range(_PREFIX_BITS):
        if counts[f"c{j}"] >= n:
            bound = 1 << j
            break
    keyed = df.withColumn("_sample_key", key)
    if bound is not None:
        keyed = keyed.filter(key_prefix(F.col("_sample_key")) < F.lit(bound))
    return keyed.orderBy("_sample_key").limit(n).drop("_sample_key")


def split_random(df: DataFrame, fraction: float = config.VALIDATION_FRACTION,
                 id_col: str = "flow_id", seed: int = config.SEED) -> DataFrame:
    """Adds ``is_val`` (boolean) with P(val) = fraction, by key; no shuffle."""
    return df.withColumn("is_val", key_uniform(sample_key(id_col, seed)) < F.lit(fraction))


def split_stratified(df: DataFrame, label_col: str, fraction: float = config.VALIDATION_FRACTION,
                     id_col: str = "flow_id", seed: int = config.SEED) -> DataFrame:
    """Per class, the ``round(fraction * class size)`` rows with the
    smallest keys go to validation.

    The rank inside a class is computed without gathering a class into one
    task: the key prefix is bucketed into ranges (a range-partitioned
    shuffle), bucket sizes per class are summed to offsets (a tiny table:
    classes x buckets), and each row's rank is its offset plus its rank
    inside its (class, bucket) cell.  A class of a third of all rows is
    spread over all buckets.
    """
    buckets = 4096
    key = sample_key(id_col, seed)
    keyed = df.withColumn("_k", key).withColumn(
        "_b", (key_prefix(F.col("_k")) * buckets / F.lit(2 ** _PREFIX_BITS)).cast("int"))
    lab = F.col(label_col)
    cell = keyed.groupBy(lab.alias("_lab"), F.col("_b")).agg(F.count(F.lit(1)).alias("_cn"))
    wc = Window.partitionBy("_lab").orderBy("_b")
    offsets = cell.select(
        "_lab", "_b",
        (F.sum("_cn").over(wc.rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
        F.sum("_cn").over(wc.rowsBetween(Window.unboundedPreceding,
                                         Window.unboundedFollowing)).alias("_tot"),
    ).fillna(0, subset=["_off"])
    ranked = keyed.withColumn(
        "_r", F.row_number().over(Window.partitionBy(lab, F.col("_b")).orderBy("_k")))
    # offsets has classes x buckets rows; no broadcast hint: AQE measures its
    # runtime size and broadcasts it only below the broadcast threshold.
    joined = ranked.join(offsets, (lab.eqNullSafe(offsets["_lab"]))
                         & (ranked["_b"] == offsets["_b"]), "left")
    rank = F.col("_off") + F.col("_r")
    n_val = F.floor(F.col("_tot") * F.lit(fraction) + F.lit(0.5))
    return joined.select(
        *[ranked[c] for c in df.columns],
        rank.alias("split_rank"),
        (rank <= n_val).alias("is_val"),
    )


CUT_BUCKETS = 1 << 16


def cut_keys(df: DataFrame, label_col: str, fraction: float = config.VALIDATION_FRACTION,
             id_col: str = "flow_id", seed: int = config.SEED) -> DataFrame:
    """``label, cut``: per class, the key of its ``round(fraction * size)``-th
    row in key order; null if that is none.

    Keys are counted by class and prefix; only the rows of the prefix that
    holds a class's cut are ranked.  Nothing but label and key is shuffled."""
    keyed = df.select(F.col(label_col).alias("label"), sample_key(id_col, seed).alias("key")) \
        .withColumn("bucket", F.shiftright(key_prefix(F.col("key")), _PREFIX_BITS - 16))
    w = Window.partitionBy("label")
    cells = keyed.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "label", "bucket", "n", F.sum("n").over(w.orderBy("bucket")).alias("upto"),
        F.floor(F.sum("n").over(w) * F.lit(fraction) + F.lit(0.5)).alias("n_val"))
    # one prefix a class
    at = cells.where((F.col("n_val") <= F.col("upto")) & (F.col("n_val") > F.col("upto") - F.col("n"))) \
        .select(F.col("label").alias("_l"), F.col("bucket").alias("_b"), (F.col("n_val") - F.col("upto") + F.col("n")).alias("place"))
    near = keyed.join(at, F.col("label").eqNullSafe(F.col("_l")) & (F.col("bucket") == F.col("_b")))
    ranked = near.withColumn("r", F.row_number().over(w.orderBy("key")))
    return ranked.where(F.col("r") == F.col("place")).select("label", F.col("key").alias("cut"))


def split_by_cut(df: DataFrame, label_col: str, fraction: float = config.VALIDATION_FRACTION,
                 id_col: str = "flow_id", seed: int = config.SEED, out: str = "is_val") -> DataFrame:
    """X3 as a projection: ``out`` is true for the rows up to their class's cut
    key, the same rows as :func:`split_stratified` picks.  The rows themselves
    are never shuffled: cuts are one row a class.  Rows with one id fall on
    one side."""
    cuts = write_table(df.sparkSession, cut_keys(df, label_col, fraction, id_col, seed), "cuts")
    if cuts.count() <= MAX_BROADCAST_CLASSES:
        cuts = F.broadcast(cuts)
    return df.join(cuts, df[label_col].eqNullSafe(cuts["label"]), "left").select(
        *[df[c] for c in df.columns],
        F.coalesce(sample_key(df[id_col], seed) <= F.col("cut"), F.lit(False)).alias(out))
