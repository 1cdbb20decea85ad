"""Flow table derived from the driver's order / line-item tables.

A flow is an order, its packets are the order's line items: forward =
line status ``O``, backward = ``F``; packet length = quantity; packet time =
ship day.  Seventeen of the 78 model features are derived, the other 61 stay
absent so that feature preparation has to fill them.  The label depends on
the features (plus a 5 % noise class) so models have something to learn.

Scale notes
-----------
* Line items are dealt by order once, as five narrow columns, into as many
  partitions as their files' bytes call for, so a task's memory does not grow
  with the table.  Sorting, gaps and sums of an order need no other shuffle.
* A hot order (a third of all rows) would be one task's work: line items are
  counted by buckets of keys first, and those of buckets with more than
  ``HOT_ITEMS`` rows are aggregated per ``(order, ship day)`` instead, with
  map-side partial aggregation, which splits an order over its days.
* There, inter-arrival gaps are taken over the *distinct days* of an order,
  whose number is bounded by the calendar (about 2.5 k days).  Duplicated days
  contribute a zero gap, which is exactly what a per-item ``lag`` yields.
* The per-day partial sums are combined with the parallel (Chan et al.)
  variance formula, so the sample standard deviation needs no second pass.
* The per-order aggregate keeps the partitioning by order; the join with
  ``orders`` shuffles only ``orders`` (or is turned into a broadcast by AQE
  when the runtime size of a side is below the broadcast threshold).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowspark.session import compiled_methods, folder_bytes

# fixed values: short fixture names -> model feature names
FLOW_FEATURES: dict[str, str] = {
    "port": "Destination Port",
    "dur": "Flow Duration",
    "nf": "Total Fwd Packets",
    "nb": "Total Backward Packets",
    "bytes": "Total Length of Fwd Packets",
    "mx": "Max Packet Length",
    "mn": "Min Packet Length",
    "av": "Packet Length Mean",
    "sd": "Packet Length Std",
    "fmx": "Fwd Packet Length Max",
    "bmx": "Bwd Packet Length Max",
    "iatm": "Flow IAT Mean",
    "iatx": "Flow IAT Max",
    "iatn": "Flow IAT Min",
    "ack": "ACK Flag Count",
    "bps": "Flow Bytes/s",
    "win_bwd": "Init_Win_bytes_backward",
}

LABEL = "Label"

PART_BYTES = 16 << 20    # of the line items' files that a task of the per-order statistics gets
KEY_BUCKETS = 1 << 16    # buckets of order keys whose line items are counted
HOT_ITEMS = 250_000      # line items of a bucket beyond which its orders are aggregated by day first
NO_DAY = -(1 << 31)      # before an order's first item


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flow_stats(lineitem: DataFrame, parts: int | None = None) -> DataFrame:
    """Per-order packet statistics (one row per order that has items), in
    ``parts`` partitions."""
    li = lineitem.select(
        F.col("l_orderkey").alias("k"),
        F.col("l_quantity").alias("len"),
        F.col("l_linestatus").alias("dir"),
        F.col("l_returnflag").alias("flag"),
        F.unix_date(F.to_date("l_shipdate")).alias("day"),
    )
    bucket = F.pmod(F.xxhash64("k"), F.lit(KEY_BUCKETS)).cast("int")
    hot = [r["b"] for r in li.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > HOT_ITEMS).collect()]      # KEY_BUCKETS numbers at most
    parts = parts or int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not hot:
        return _stats_by_item(li, parts)
    return _stats_by_item(li.where(~bucket.isin(hot)), parts).unionByName(_stats_by_day(li.where(bucket.isin(hot)))) \
        .repartition(parts, "k")


def _stats_by_item(li: DataFrame, parts: int) -> DataFrame:
    """Statistics of orders that one task can hold each."""
    fwd, bwd = F.col("dir") == "O", F.col("dir") == "F"
    rows = li.select("k", "day", "len", fwd.alias("fwd"), bwd.alias("bwd"), (F.col("flag") == "A").alias("acked")) \
        .repartition(parts, "k")
    before = F.lag("day", 1, NO_DAY).over(Window.partitionBy("k").orderBy("day"))
    # of items without a day the first has no gap, the others have a zero gap as those of one day
    gap = F.when(F.col("before") == NO_DAY, F.lit(None)).when(F.col("day").eqNullSafe(F.col("before")), F.lit(0)) \
        .otherwise(F.col("day") - F.col("before"))
    agg = rows.withColumn("before", before).withColumn("gap", gap).groupBy("k").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if("fwd").cast("double").alias("nf"),
        F.count_if("bwd").cast("double").alias("nb"),
        F.sum("len").alias("bytes"),
        F.max("len").alias("mx"),
        F.min("len").alias("mn"),
        F.avg("len").alias("av"),
        F.stddev_samp("len").alias("sd"),
        F.max(F.when(F.col("fwd"), F.col("len"))).alias("fmx"),
        F.max(F.when(F.col("bwd"), F.col("len"))).alias("bmx"),
        (F.max("day") - F.min("day")).cast("double").alias("dur"),
        F.max("gap").cast("double").alias("iatx"),
        F.min("gap").cast("double").alias("iatn"),
        F.count_if("acked").cast("double").alias("ack"),
    )
    return agg.withColumn("iatm", F.when(F.col("n_items") > 1, F.col("dur") / (F.col("n_items") - 1)))


def _stats_by_day(li: DataFrame) -> DataFrame:
    """The same statistics from sums per (order, ship day)."""
    fwd = F.col("dir") == "O"
    bwd = F.col("dir") == "F"
    per_day = li.groupBy("k", "day").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("len").alias("n_len"),
        F.sum(F.when(fwd, 1).otherwise(0)).alias("nf"),
        F.sum(F.when(bwd, 1).otherwise(0)).alias("nb"),
        F.sum("len").alias("s"),
        F.max("len").alias("mx"),
        F.min("len").alias("mn"),
        (F.var_pop("len") * F.count("len")).alias("m2"),
        F.max(F.when(fwd, F.col("len"))).alias("fmx"),
        F.max(F.when(bwd, F.col("len"))).alias("bmx"),
        F.sum(F.when(F.col("flag") == "A", 1).otherwise(0)).alias("ack"),
    )
    w = Window.partitionBy("k").orderBy("day")
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gap = F.col("day") - F.lag("day").over(w)
    dup_zero = F.when(F.col("n") > 1, F.lit(0))
    order_mean = F.try_divide(F.sum("s").over(w_all), F.sum("n_len").over(w_all))
    days = per_day.select(
        "*",
        F.greatest(gap, dup_zero).alias("gap_hi"),
        F.least(gap, dup_zero).alias("gap_lo"),
        (F.col("m2") + F.col("n_len") * F.pow(F.try_divide(F.col("s"), F.col("n_len")) - order_mean, 2))
        .alias("m2c"),
    )
    n_len = F.sum("n_len")
    agg = days.groupBy("k").agg(
        F.sum("n").alias("n_items"),
        F.sum("nf").cast("double").alias("nf"),
        F.sum("nb").cast("double").alias("nb"),
        F.sum("s").alias("bytes"),
        F.max("mx").alias("mx"),
        F.min("mn").alias("mn"),
        F.try_divide(F.sum("s"), n_len).alias("av"),
        F.when(n_len > 1, F.sqrt(F.sum("m2c") / (n_len - 1))).alias("sd"),
        F.max("fmx").alias("fmx"),
        F.max("bmx").alias("bmx"),
        (F.max("day") - F.min("day")).cast("double").alias("dur"),
        F.max("gap_hi").cast("double").alias("iatx"),
        F.min("gap_lo").cast("double").alias("iatn"),
        F.sum("ack").cast("double").alias("ack"),
    )
    return agg.withColumn(
        "iatm",
        F.when(F.col("n_items") > 1, F.col("dur") / (F.col("n_items") - 1)),
    )


def flows(spark: SparkSession, sf_dir: str, with_label: bool = True) -> DataFrame:
    """The raw flow table: ``flow_id``, 17 raw features (model names), ``Label``."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice")
    compiled_methods(spark)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-folder_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet") // PART_BYTES))
    stats = flow_stats(read_table(spark, sf_dir, "lineitem"), parts)
    j = orders.join(stats, orders.o_orderkey == stats.k, "left")
    dur = F.col("dur")
    bps = (F.when(dur.isNull(), F.lit(None).cast("double"))
           .when(dur == 0, F.lit(float("inf")))
           .otherwise(F.col("bytes") / dur))
    win_bwd = (F.when(F.col("o_orderkey") % 97 == 0, F.lit(-1.0))
               .otherwise(F.col("o_totalprice") / 10))
    label = (F.when(F.col("o_orderkey") % 20 == 0, "Bot")
             .when(F.col("nf") >= 5, "DDoS")
             .when(dur == 0, "PortScan")
             .when(F.col("bmx") >= 48, "SSH-Patator")
             .otherwise("BENIGN"))
    exprs = {
        "port": (F.col("o_custkey") % 1024).cast("double"),
        "bps": bps,
        "win_bwd": win_bwd,
    }
    cols = [F.col("o_orderkey").alias("flow_id")]
    for short, name in FLOW_FEATURES.items():
        cols.append(exprs.get(short, F.col(short)).alias(name))
    if with_label:
        cols.append(label.alias(LABEL))
    return j.select(*cols)


# DuckDB form of the same table (the oracle); the straightforward per-item
# window formulation, deliberately different from the Spark plan above.
FLOWS_SQL = """
flows AS (
 WITH pk AS (
  SELECT l_orderkey AS k, l_quantity AS len, l_linestatus AS dir, l_returnflag AS flag,
         l_shipdate AS t,
         lag(l_shipdate) OVER (PARTITION BY l_orderkey
                               ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS pt
  FROM lineitem),
 pi AS (SELECT *, CAST(date_diff('day', pt, t) AS DOUBLE) AS iat FROM pk),
 ag AS (
  SELECT k,
    CAST(sum(CASE WHEN dir='O' THEN 1 ELSE 0 END) AS DOUBLE) nf,
    CAST(sum(CASE WHEN dir='F' THEN 1 ELSE 0 END) AS DOUBLE) nb,
    sum(len) bytes, max(len) mx, min(len) mn, avg(len) av, stddev_samp(len) sd,
    max(CASE WHEN dir='O' THEN len END) fmx, max(CASE WHEN dir='F' THEN len END) bmx,
    CAST(date_diff('day', min(t), max(t)) AS DOUBLE) dur, avg(iat) iatm, max(iat) iatx,
    min(iat) iatn,
    CAST(sum(CASE WHEN flag='A' THEN 1 ELSE 0 END) AS DOUBLE) ack
  FROM pi GROUP BY k)
 SELECT o_orderkey AS flow_id,
   CAST(o_custkey % 1024 AS DOUBLE) AS "Destination Port",
   dur AS "Flow Duration", nf AS "Total Fwd Packets", nb AS "Total Backward Packets",
   bytes AS "Total Length of Fwd Packets", mx AS "Max Packet Length",
   mn AS "Min Packet Length", av AS "Packet Length Mean", sd AS "Packet Length Std",
   fmx AS "Fwd Packet Length Max", bmx AS "Bwd Packet Length Max",
   iatm AS "Flow IAT Mean", iatx AS "Flow IAT Max", iatn AS "Flow IAT Min",
   ack AS "ACK Flag Count",
   CASE WHEN dur IS NULL THEN NULL WHEN dur = 0 THEN CAST('Infinity' AS DOUBLE)
        ELSE bytes / nullif(dur, 0) END AS "Flow Bytes/s",
   CASE WHEN o_orderkey % 97 = 0 THEN -1.0 ELSE o_totalprice / 10 END
        AS "Init_Win_bytes_backward",
   CASE WHEN o_orderkey % 20 = 0 THEN 'Bot' WHEN nf >= 5 THEN 'DDoS'
        WHEN dur = 0 THEN 'PortScan' WHEN bmx >= 48 THEN 'SSH-Patator' ELSE 'BENIGN' END
        AS "Label"
 FROM orders LEFT JOIN ag ON o_orderkey = k)"""
