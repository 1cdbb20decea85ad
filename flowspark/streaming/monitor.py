"""Flow monitor: per-batch series and running totals (W2, W3), batch and stream.

A "batch" is ``batch_size`` consecutive rows in arrival order.  Rows need no
dense key: their positions are counted over ranges (``prefix``).
Running totals are block sums of block sums: batches are grouped into blocks
of ``block`` consecutive numbers, the blocks' totals again, until one block is
left; then each level gives the one below its carries.  No window holds more
than ``block`` rows.  Spark's plain ``sum() over (order by batch)`` would pull
every batch into one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark import config
from flowspark.operators.prefix import positions
from flowspark.session import write_table

BLOCK = 1024


def per_batch(scored: DataFrame, batch_col: str = "batch") -> DataFrame:
    """Rows, attack-routed rows and anomalies per batch."""
    return scored.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("Binary_Route") == config.ATTACK).alias("attacks"),
        F.count_if(F.col("Anomaly")).alias("anomalies"))


def with_batch(rows: DataFrame, order: Sequence[str], size: int, batch_col: str = "batch") -> DataFrame:
    """``rows`` with their batch number, ``size`` rows a batch by
    ``order`` (which must tell all rows apart)."""
    at = positions(rows, order, "_position")
    return at.withColumn(batch_col, F.floor(F.col("_position") / size).cast("long")).drop("_position")


def running_sum(df: DataFrame, order_col: str, cols: list[str], block: int = BLOCK) -> DataFrame:
    """Cumulative sums of ``cols`` in ``order_col`` order (``order_col`` a
    non-negative long without repeats, e.g. a batch number).  Each level is
    written once, for its totals and its sums."""
    if block < 2:
        raise ValueError("a block holds at least two rows")
    rows = write_table(df.sparkSession, df.select(order_col, *cols), "running")
    last = rows.agg(F.max(order_col)).first()[0]
    sums = _running(rows.withColumnRenamed(order_col, "_at"), cols, block, -1 if last is None else last)
    return sums.select(F.col("_at").alias(order_col), *cols)


def _running(rows: DataFrame, cols: list[str], block: int, last: int) -> DataFrame:
    """Running sums of (``_at``, cols), ``_at`` at most ``last``."""
    blocked = rows.withColumn("_block", F.floor(F.col("_at") / block).cast("long"))
    within = Window.partitionBy("_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    inner = blocked.select("_block", "_at", *[F.sum(c).over(within).cast("long").alias(c) for c in cols])
    if last < block:
        return inner.drop("_block")
    totals = write_table(rows.sparkSession, blocked.groupBy(F.col("_block").alias("_at"))
                         .agg(*[F.sum(c).alias(c) for c in cols]), "running")
    # what all blocks up to this one hold, less its own: the carry of its rows
    upto = _running(totals, cols, block, last // block).alias("u").join(totals.alias("t"), "_at")
    carry = upto.select(F.col("_at").alias("_block"), *[(F.col(f"u.{c}") - F.col(f"t.{c}")).alias(f"_carry_{c}") for c in cols])
    return inner.join(carry, "_block").select("_at", *[(F.col(c) + F.col(f"_carry_{c}")).alias(c) for c in cols])


def running_totals(batches: DataFrame, batch_col: str = "batch") -> DataFrame:
    """Total / attacks / benign / anomalies after each batch."""
    b = batches.select(batch_col, "n", "attacks", (F.col("n") - F.col("attacks")).alias("benign"),
                       "anomalies")
    r = running_sum(b, batch_col, ["n", "attacks", "benign", "anomalies"])
    return r.select(batch_col, F.col("n").alias("total"), "attacks", "benign", "anomalies")
