"""Edge cases of the CSV source and feature preparation (FIXTURES.md §1)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from flowspark import config
from flowspark.operators import prepare as prep
from flowspark.operators import scaler as sc
from flowspark.sources import csvsrc

FHL = "Fwd Header Length"


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


RAW = (" Destination Port, Flow Duration,Total Fwd Packets, Fwd Header Length,"
       " Fwd Header Length,Flow Bytes/s,Extra Col, Label\n"
       "80,10,3,40,41,Infinity,1,BENIGN\n"
       "443,-5,-2,40,42,-Infinity,2,DDoS\n"
       "22,,7,40,43,inf,3,\n"
       "21,NaN,1,40,44,2e12,4,Bot\n")


def test_header_mangling_and_label(spark, tmp_path):
    path = _write(tmp_path, "a.csv", RAW)
    df = csvsrc.read_flow_csv(spark, path)
    assert df.columns == ["Destination Port", "Flow Duration", "Total Fwd Packets", FHL,
                          FHL + ".1", "Flow Bytes/s", "Extra Col", "Label"]
    rows = df.orderBy("Destination Port").collect()
    assert [r[FHL + ".1"] for r in rows] == [44.0, 43.0, 41.0, 42.0]
    assert [r["Destination Port"] for r in rows] == [21.0, 22.0, 80.0, 443.0]
    assert rows[1]["Label"] is None                     # empty label cell
    assert rows[2]["Flow Bytes/s"] == float("inf")      # Infinity parses
    assert rows[3]["Flow Bytes/s"] == float("-inf")
    assert rows[1]["Flow Bytes/s"] is None              # lower-case inf -> null (H2)
    assert math.isnan(rows[0]["Flow Duration"])          # NaN parses as NaN
    assert rows[1]["Flow Duration"] is None               # empty cell -> null


def test_prepare_values(spark, tmp_path):
    df = csvsrc.read_flow_csv(spark, _write(tmp_path, "b.csv", RAW))
    out = {r["Destination Port"]: r for r in
           prep.prepare(df, keep=(config.LABEL_NAME,)).withColumn(
               "Destination Port", F.col("`Destination Port`")).collect()}
    assert len(out[80]) == len(config.FEATURE_ORDER) + 1
    # +Inf in a log1p column -> log1p(inf) = inf -> 0
    assert out[80]["Flow Bytes/s"] == 0.0
    # -Inf clipped at 0 before log1p -> 0
    assert out[443]["Flow Bytes/s"] == 0.0
    # lower-case inf is read as null -> 0
    assert out[22]["Flow Bytes/s"] == 0.0
    # value above 1e9: log1p keeps it finite
    assert out[21]["Flow Bytes/s"] == pytest.approx(math.log1p(2e12), rel=1e-6)
    # negative in a log1p column -> clip 0 -> log1p(0) = 0
    assert out[443]["Total Fwd Packets"] == 0.0
    # negative in a plain column stays
    assert out[443]["Flow Duration"] == -5.0
    # empty and NaN cells -> 0
    assert out[22]["Flow Duration"] == 0.0 and out[21]["Flow Duration"] == 0.0
    # both header-length copies get log1p
    assert out[80][FHL + ".1"] == pytest.approx(math.log1p(41), rel=1e-6)
    # absent feature filled with 0, extra column dropped
    assert out[80]["Idle Min"] == 0.0
    assert "Extra Col" not in out[80]


def test_clip_large_plain_value(spark):
    df = spark.createDataFrame([(5e12,), (-7e12,)], "`Flow Duration` double")
    vals = sorted(r[0] for r in prep.prepare(df, keep=()).select("`Flow Duration`").collect())
    assert vals == [-1e9, 1e9]


def test_missing_label_and_union(spark, tmp_path):
    a = _write(tmp_path, "x1.csv", "Flow Duration,Label\n1,BENIGN\n")
    b = _write(tmp_path, "x2.csv", " Destination Port,Flow Duration\n80,2\n")
    df = csvsrc.read_flow_csvs(spark, [b, a])
    assert set(df.columns) == {"Flow Duration", "Label", "Destination Port"}
    assert df.count() == 2
    assert csvsrc.find_label([" Destination Port"]) is None
    with pytest.raises(ValueError):
        csvsrc.require_label(["a", "b"])
    assert csvsrc.find_label(["a", " LABEL "]) == " LABEL "


def test_max_files(spark, tmp_path):
    ps = [_write(tmp_path, f"f{i}.csv", f"Flow Duration\n{i}\n") for i in range(4)]
    df = csvsrc.read_flow_csvs(spark, ps[::-1], max_files=3)
    assert sorted(r[0] for r in df.collect()) == [0.0, 1.0, 2.0]


def test_zero_iqr_scales_by_one(spark):
    rows = [(i, 5.0, float(i)) for i in range(1, 10)]
    df = spark.createDataFrame(rows, "flow_id long, `Flow Duration` double, `Destination Port` double")
    p = prep.prepare(df, keep=("flow_id",))
    params = sc.scaler_params(sc.fit_scaler(p))
    assert params["Flow Duration"] == (5.0, 1.0)      # constant column: IQR 0 -> 1
    assert params["Destination Port"] == (5.0, 4.0)   # quartiles 3 and 7
    scaled = sc.apply_scaler(p, params).where("flow_id = 7").first()
    assert scaled["Flow Duration"] == 0.0 and scaled["Destination Port"] == 0.5


def test_absent_shortcut_equals_full_fit(spark):
    rows = [(i, float(i % 5), float(i * i)) for i in range(50)]
    df = spark.createDataFrame(rows, "flow_id long, `Flow Duration` double, `Destination Port` double")
    p = prep.prepare(df, keep=("flow_id",))
    absent = [n for n in config.FEATURE_ORDER if n not in df.columns]
    full = {r["feature"]: tuple(r)[2:] for r in sc.fit_scaler(p).collect()}
    fast = {r["feature"]: tuple(r)[2:] for r in sc.fit_scaler(p, absent=absent).collect()}
    assert full == fast


def test_full_width_preparation_stays_in_codegen(spark):
    cols = [F.col("id").alias("flow_id")] + [
        (F.col("id") % (i + 3)).cast("double").alias(n) for i, n in enumerate(config.FEATURE_ORDER)
    ] + [F.lit("BENIGN").alias("Label")]
    raw = spark.range(100).select(*cols)
    scaled = sc.apply_scaler(prep.prepare(raw), {n: (1.0, 2.0) for n in config.FEATURE_ORDER})
    plan = scaled._jdf.queryExecution().executedPlan().toString()
    assert len(scaled.columns) <= 100 and "*(" in plan      # WholeStageCodegen marker


def test_wide_preparation_runs_as_compiled_methods(spark):
    """The full-width stage is longer than what the JVM compiles, so it runs
    as split projections, with the same values; a given limit is left."""
    from flowspark.session import JIT_BYTES, METHOD_LIMIT
    code = spark._jvm.org.apache.spark.sql.catalyst.expressions.codegen
    assert JIT_BYTES == getattr(code, "CodeGenerator").DEFAULT_JVM_HUGE_METHOD_LIMIT()
    raw = spark.range(200).select(F.col("id").alias("flow_id"), F.lit("BENIGN").alias("Label"), *[
        ((F.hash("id", F.lit(i)) % 1000) / 7).alias(n) for i, n in enumerate(config.FEATURE_ORDER)]).cache()
    params = {n: (float(i), 2.0) for i, n in enumerate(config.FEATURE_ORDER)}

    def wide():
        return sc.apply_scaler(prep.prepare(raw), params)

    before = spark.conf.get(METHOD_LIMIT)
    try:
        spark.conf.set(METHOD_LIMIT, "65535")
        df = wide()
        assert spark.conf.get(METHOD_LIMIT) == str(JIT_BYTES)
        stages = df._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
        assert max(sizes) > JIT_BYTES
        split = df.collect()
        spark.conf.set(METHOD_LIMIT, "60000")
        assert wide().collect() == split and spark.conf.get(METHOD_LIMIT) == "60000"
    finally:
        spark.conf.set(METHOD_LIMIT, before)
        raw.unpersist()
