"""Running sums over a whole table in a given order, without one task that
sees the whole table.

The rows are range-partitioned by the order and written, with the number of
their block; block totals (one row a block) give each block's carry, and the
running sum inside a block adds to it.  Rows with equal order values fall
into one block, so callers group by the order first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.session import write_table


def prefix_sums(df: DataFrame, order: Sequence[str], sums: Mapping[str, str], descending: bool = False,
                blocks: int | None = None) -> DataFrame:
    """``df`` with, for each ``out -> column`` of ``sums``, the sum ``out`` of
    ``column`` up to and including the row, its total over all rows
    ``out_total``, and ``out_next``: ``column`` of the next row (null in the
    last)."""
    spark = df.sparkSession
    by = [F.desc(c) if descending else F.asc(c) for c in order]
    n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = write_table(spark, df.repartitionByRange(n, *by).withColumn("_block", F.spark_partition_id()), "ranges")
    first = F.min_by if not descending else F.max_by
    key = F.struct(*order)
    totals = dealt.groupBy("_block").agg(
        *[F.sum(c).alias(f"_sum_{out}") for out, c in sums.items()],
        *[first(F.col(c), key).alias(f"_first_{out}") for out, c in sums.items()])
    # one row a block: as many rows as partitions, whatever the data
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole, nearby = Window.partitionBy(F.lit(1)), Window.orderBy("_block")
    carry = totals.select(
        "_block", *[F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_carry_{out}") for out in sums],
        *[F.sum(f"_sum_{out}").over(whole).alias(f"{out}_total") for out in sums],
        *[F.lead(f"_first_{out}").over(nearby).alias(f"_after_{out}") for out in sums])
    within = Window.partitionBy("_block").orderBy(*by)
    rows = dealt.select("*", *[F.sum(c).over(within.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_in_{out}")
                               for out, c in sums.items()],
                        *[F.lead(c).over(within).alias(f"_lead_{out}") for out, c in sums.items()])
    return rows.join(F.broadcast(carry), "_block").select(
        *df.columns, *[(F.col(f"_carry_{out}") + F.col(f"_in_{out}")).alias(out) for out in sums],
        *[f"{out}_total" for out in sums],
        *[F.coalesce(f"_lead_{out}", f"_after_{out}").alias(f"{out}_next") for out in sums])


def positions(df: DataFrame, order: Sequence[str], out: str, blocks: int | None = None) -> DataFrame:
    """``df`` with the number of rows before each one by ``order``, which must
    tell all rows apart."""
    sums = prefix_sums(df.withColumn("_one", F.lit(1).cast("long")), order, {"_upto": "_one"}, blocks=blocks)
    return sums.select(*df.columns, (F.col("_upto") - 1).alias(out))
