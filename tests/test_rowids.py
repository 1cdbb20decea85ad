"""Row numbers of files (S2, S5, F8) and batch numbers."""

from __future__ import annotations

import itertools
import json

import pytest
from pyspark.sql import functions as F

from flowspark.operators.prefix import positions
from flowspark.sources import csvsrc, records, rowids
from flowspark.streaming import monitor


@pytest.fixture()
def files(tmp_path):
    """Three files, two layouts; their rows are numbered in ``Idle Max``."""
    n = itertools.count()
    for name, rows, header in (("b.csv", 700, " Idle Max,Label"), ("a.csv", 0, "Idle Max,Label"), ("c.csv", 900, "Label, Idle Max ")):
        lines = [header]
        for _ in range(rows):
            k = next(n)
            lines.append(f"{k},BENIGN" if name != "c.csv" else f"BENIGN,{k}")
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    return [str(tmp_path / f"{c}.csv") for c in "cab"]


@pytest.mark.parametrize("split", ["134217728", "1000", "333"])
def test_numbers_hold_for_any_split(spark, files, split):
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = csvsrc.read_flow_csvs(spark, files, row_ids=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    got = rows.select("flow_id", "Idle Max").collect()
    assert sorted(r["flow_id"] for r in got) == list(range(1600))
    assert all(r["flow_id"] == r["Idle Max"] for r in got)


def test_numbers_without_broadcast(spark, files, monkeypatch):
    monkeypatch.setattr(rowids, "BROADCAST_SPLITS", 0)
    rows = csvsrc.read_flow_csvs(spark, files, row_ids=True)
    assert rows.count() == 1600 and rows.where("flow_id <> `Idle Max`").count() == 0


def test_given_ids_are_no_others(spark, tmp_path):
    lines = [{"flow_id": 5, "features": {"Idle Max": 1}}, {"features": {"Idle Max": 2}},
             {"flow_id": 1, "features": {}}, {"features": {"Idle Max": 3}}]
    (tmp_path / "r.json").write_text("".join(json.dumps(x) + "\n" for x in lines))
    got = {r["flow_id"]: r["Idle Max"] for r in records.read_records(spark, str(tmp_path / "r.json")).collect()}
    assert got == {5: 1.0, 1: None, 7: 2.0, 9: 3.0}


def test_positions_and_batches_of_gappy_keys(spark):
    df = spark.range(0, 3000).where("id % 7 in (1, 2, 5)").select((F.col("id") * 3 - 500).alias("k"))
    keys = sorted(r.k for r in df.collect())
    got = {r.k: r.at for r in positions(df, ["k"], "at", blocks=5).collect()}
    assert got == {k: i for i, k in enumerate(keys)}
    batches = {r.k: r.batch for r in monitor.with_batch(df, ["k"], 100).collect()}
    assert batches == {k: i // 100 for i, k in enumerate(keys)}


@pytest.mark.parametrize("block", [2, 3, 10, 1000])
def test_running_sums_over_levels(spark, block):
    rows = [(k, k % 5 - 1) for k in range(0, 300) if k % 11]
    df = spark.createDataFrame(rows, "b long, x long").repartition(4)
    got = {r.b: r.x for r in monitor.running_sum(df, "b", ["x"], block=block).collect()}
    assert got == dict(zip((k for k, _ in rows), itertools.accumulate(x for _, x in rows)))
    assert monitor.running_sum(df.limit(0), "b", ["x"], block=block).count() == 0


def test_small_splits_are_bounded_in_number():
    from flowspark.plans import files as fl
    assert fl.small_splits(0) == fl.small_splits(1_000_000) == fl.SPLIT_BYTES
    for total in (10 ** 9, 10 ** 10, 10 ** 12 + 1):
        assert -(-total // fl.small_splits(total)) <= fl.SPLITS
