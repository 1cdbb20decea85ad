"""Connected components of an edge table, by alternating large and small
stars: every round moves links nearer to the smallest node of a component,
and the number of rounds grows with the logarithm of its size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import staged


def _large_star(e: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest one it knows."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the smallest."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    return (e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where(F.col("u") != F.col("v")).distinct())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its
    smallest node.  ``edges`` has columns u, v in any order; self links are
    ignored.  Each round is written to the shared folder."""
    e = staged(spark, edges.where(F.col("u") != F.col("v"))
               .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    # the links of a finished component form one star around its smallest node
    def state(x: DataFrame):
        return x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before, now = None, state(e)
    while now != before:
        e = staged(spark, _small_star(_large_star(e)), "links")
        before, now = now, state(e)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
