"""Registered file source / sink queries.

The flow table is written as CSV the way raw flow exports look (padded
header names, the duplicated ``Fwd Header Length`` header, an extra
column, shuffled column order, `` Label``) and read back through the CSV
source; results are written through the CSV and JSON sinks and read back.
Each round trip must give exactly what SQL computes from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowspark import config
from flowspark.operators import explain as ex
from flowspark.operators import prepare as prep
from flowspark.operators import route as rt
from flowspark.plans import fixtures as fx
from flowspark.plans import sql as S
from flowspark.plans.catalog import register
from flowspark.session import folder_bytes, scratch_path
from flowspark.plans.training import prepare_for_scoring
from flowspark.sources import bundle, csvsrc
from flowspark.sources.flows import FLOW_FEATURES

FHL = "Fwd Header Length"
HEADER_FACTOR = 20.0       # header bytes per forward packet in the CSV fixture
EXTRA = "Flow Extra"


def _csv_frame(spark, sf):
    """Flows in raw-export shape: shuffled columns, duplicated header column,
    an extra column, label last."""
    f = fx.flow_table(spark, sf)
    hdr = F.col("`Total Fwd Packets`") * F.lit(HEADER_FACTOR)
    feats = list(FLOW_FEATURES.values())
    shuffled = feats[::-1]
    cols = [F.col("flow_id").cast("double").alias("flow_id")]
    cols += [prep.fcol(n) for n in shuffled[:5]] + [hdr.alias(FHL)]
    cols += [prep.fcol(n) for n in shuffled[5:]] + [hdr.alias(FHL + "#2")]
    cols += [(F.col("flow_id") % 7).cast("double").alias(EXTRA), F.col("Label")]
    df = f.select(*cols)
    header = [n if i % 3 else " " + n for i, n in enumerate(df.columns)]
    header = [FHL if n.strip() == FHL + "#2" else n for n in header]
    header[-1] = " Label"
    return df, header


def _csv_sql() -> str:
    present = set(FLOW_FEATURES.values()) | {FHL, FHL + ".1"}

    def expr(n):
        if n not in present:
            return "CAST(0.0 AS FLOAT)"
        v = f"CAST({S.q(n)} AS DOUBLE)"
        if n in config.LOG1P_SET:
            v = f"ln(1 + greatest({v}, 0.0))"
        clean = f"CASE WHEN {v} IS NULL OR isnan({v}) OR isinf({v}) THEN 0.0 ELSE {v} END"
        return f"CAST(least(greatest({clean}, -1e9), 1e9) AS FLOAT)"

    fx_cte = (f"fx AS (SELECT *, \"Total Fwd Packets\" * {HEADER_FACTOR} AS {S.q(FHL)}, "
              f"\"Total Fwd Packets\" * {HEADER_FACTOR} AS {S.q(FHL + '.1')} FROM flows)")
    body = ",\n  ".join(f"{expr(n)} AS {S.q(n)}" for n in config.FEATURE_ORDER)
    return S.with_chain(S.FLOWS_SQL.strip(), fx_cte) + \
        f"SELECT flow_id, \"Label\",\n  {body}\nFROM fx"


@register("csv_scan", _csv_sql())
def csv_scan(spark, sf):
    """Raw-shaped CSV -> header mangling, explicit schema,
    label detection -> model input."""
    df, header = _csv_frame(spark, sf)
    path = scratch_path(spark, "flows-csv")
    csvsrc.write_flow_csv(df, path, header)
    back = csvsrc.read_flow_csvs(spark, [path])
    back = back.withColumn("flow_id", F.col("flow_id").cast("long"))
    return prep.prepare(back, keep=("flow_id", config.LABEL_NAME))


_SCORED_SQL = S.with_chain(*S.chain_scored())


@register("results_csv", _SCORED_SQL + 'SELECT flow_id, "Actual", "Final_Prediction", '
          '"Binary_Route", "Confidence", "Anomaly" FROM scored')
def results_csv(spark, sf):
    """Scored rows with the actual label first, through the CSV sink."""
    s = fx.rule_scored(spark, sf).scored.select("flow_id", "Actual", *rt.RESULT_COLUMNS)
    path = scratch_path(spark, "results-csv")
    csvsrc.write_results_csv(s, path)
    return spark.read.schema(s.schema).option("header", True).csv(path)


@register("results_json_sink", _SCORED_SQL + 'SELECT flow_id, "Final_Prediction" AS final_prediction, '
          '"Binary_Route" AS binary_route, "Confidence" AS confidence, "Anomaly" AS anomaly FROM scored')
def results_json_sink(spark, sf):
    """Result rows as JSON records with renamed keys, read back."""
    s = fx.rule_scored(spark, sf).scored.select("flow_id", *rt.RESULT_COLUMNS)
    path = scratch_path(spark, "results-json")
    csvsrc.write_results_json(s, path)
    schema = T.StructType([T.StructField("flow_id", T.LongType())] + [
        T.StructField(v, f.dataType) for k, v in rt.RECORD_NAMES.items()
        for f in s.schema.fields if f.name == k])
    return spark.read.schema(schema).json(path)


SPLIT_BYTES = 64 * 1024     # of the second read, at least: files are cut into many tasks
SPLITS = 2048               # about this many tasks of the second read at most
FLOW_NUMBER = 'CAST(row_number() OVER (ORDER BY flow_id) - 1 AS BIGINT)'


def _ordered_csv(spark, sf):
    """Flows as CSV files whose names and rows follow ``flow_id``, kept as
    the column ``key``."""
    df, header = _csv_frame(spark, sf)
    path = scratch_path(spark, "flows-ordered")
    csvsrc.write_flow_csv(df.repartitionByRange("flow_id").sortWithinPartitions("flow_id"), path,
                          ["key" if n.strip() == "flow_id" else n for n in header])
    return csvsrc.list_files(spark, path, ".csv")


def small_splits(total: int) -> int:
    """Bytes of the second read's splits: a task for every few rows of a large
    table would take longer than the rows."""
    return max(SPLIT_BYTES, -(-total // SPLITS))


@register("csv_row_ids", S.with_chain(S.FLOWS_SQL.strip()) +
          f"SELECT {FLOW_NUMBER} AS row_id, {FLOW_NUMBER} AS row_id_small_splits, flow_id FROM flows")
def csv_row_ids(spark, sf):
    """A row's number over all files, read in splits of the session's
    size and again in small ones."""
    paths = _ordered_csv(spark, sf)

    def read(name):
        return csvsrc.read_flow_csvs(spark, paths, row_ids=True).select(
            F.col("flow_id").alias(name), F.col("key").cast("long").alias("flow_id"))

    whole = read("row_id")
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    total = folder_bytes(spark, paths[0].rsplit("/", 1)[0]) if paths else 0
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(small_splits(total)))
    try:
        small = read("row_id_small_splits")      # its scan runs here: rows with numbers are written
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    return whole.join(small, "flow_id").select("row_id", "row_id_small_splits", "flow_id")


PICKED = (3, 17, 101)


@register("csv_pick_flows", S.with_chain(S.FLOWS_SQL.strip()) +
          f"SELECT row_id AS flow_id, feature, CAST(value AS DOUBLE) AS value FROM ("
          f"SELECT * FROM (SELECT *, {FLOW_NUMBER} AS row_id FROM flows) WHERE row_id IN {PICKED}) "
          f"UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(S.q(n) for n in S.RAW_FEATURES)}))")
def csv_pick_flows(spark, sf):
    """F8/E5: raw features of flows picked by their row numbers."""
    rows = csvsrc.read_flow_csvs(spark, _ordered_csv(spark, sf), row_ids=True)
    return ex.flow_unpivot(rows, S.RAW_FEATURES, PICKED)


FIRST_FILES, DEALT_FILES = 2, 3


@register("csv_first_files", S.with_chain(S.FLOWS_SQL.strip()) +
          f"SELECT CAST(flow_id % {DEALT_FILES} AS INT) AS file, count(*) AS n, sum(flow_id)::BIGINT AS ids "
          f"FROM flows WHERE flow_id % {DEALT_FILES} < {FIRST_FILES} GROUP BY ALL")
def csv_first_files(spark, sf):
    """S3: of several CSV sources in order of their paths the first ones."""
    df, header = _csv_frame(spark, sf)
    path = scratch_path(spark, "flows-dealt")
    paths = [f"{path}/{k}" for k in range(DEALT_FILES)]
    for k, p in enumerate(paths):
        csvsrc.write_flow_csv(df.where(F.col("flow_id").cast("long") % DEALT_FILES == k), p, header)
    rows = csvsrc.read_flow_csvs(spark, paths[::-1], max_files=FIRST_FILES).select(F.col("flow_id").cast("long"))
    return rows.groupBy((F.col("flow_id") % DEALT_FILES).cast("int").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("flow_id").alias("ids"))


@register("bundle_contract", S.with_chain(*S.CHAIN_SCALED) +
          f"SELECT flow_id, {', '.join(S.q(n) for n in config.FEATURE_ORDER)} FROM scaled")
def bundle_contract(spark, sf):
    """The fitted scaler and parameters are published with the
    features in reverse, read again, and prepare flows in the order they name."""
    path = scratch_path(spark, "bundle")
    saved = bundle.Contract(fx.scaled_flows(spark, sf).params, list(reversed(config.FEATURE_ORDER)),
                            list(config.LOG1P_COLUMNS), [], config.ATTACK_THRESHOLD)
    bundle.publish(spark, path, lambda version: bundle.save_contract(spark, saved, version))
    c = bundle.load_contract(spark, bundle.published(spark, path))
    packed = prepare_for_scoring(fx.flow_table(spark, sf), c.scaler, ("flow_id",), c.order, c.log1p)
    return prep.unpack(packed, c.order).select("flow_id", *[prep.fcol(n) for n in config.FEATURE_ORDER])
