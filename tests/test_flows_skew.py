"""Flow derivation under a hot key: one order holds a third of all line items
(many on the same day); the two-level plan must equal the per-item window."""

from __future__ import annotations

import datetime as dt

import duckdb
import numpy as np
import pandas as pd

from flowspark.sources import flows as fl
from flowspark.sources.flows import flow_stats

PER_ITEM_SQL = """
WITH pk AS (
 SELECT l_orderkey AS k, l_quantity AS len, l_linestatus AS dir, l_returnflag AS flag, l_shipdate AS t,
        lag(l_shipdate) OVER (PARTITION BY l_orderkey
                              ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS pt
 FROM li),
pi AS (SELECT *, CAST(date_diff('day', pt, t) AS DOUBLE) AS iat FROM pk)
SELECT k,
  CAST(sum(CASE WHEN dir='O' THEN 1 ELSE 0 END) AS DOUBLE) nf,
  CAST(sum(CASE WHEN dir='F' THEN 1 ELSE 0 END) AS DOUBLE) nb,
  sum(len) bytes, max(len) mx, min(len) mn, avg(len) av, stddev_samp(len) sd,
  max(CASE WHEN dir='O' THEN len END) fmx, max(CASE WHEN dir='F' THEN len END) bmx,
  CAST(date_diff('day', min(t), max(t)) AS DOUBLE) dur, avg(iat) iatm, max(iat) iatx, min(iat) iatn,
  CAST(sum(CASE WHEN flag='A' THEN 1 ELSE 0 END) AS DOUBLE) ack
FROM pi GROUP BY k"""

COLS = ["nf", "nb", "bytes", "mx", "mn", "av", "sd", "fmx", "bmx", "dur", "iatm", "iatx", "iatn", "ack"]


def _items(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    base = dt.datetime(1995, 1, 1)
    hot_n = 3000
    for i in range(hot_n):                          # order 7: a third of all rows, 40 days
        rows.append((7, i + 1, float(rng.integers(1, 50)), "O" if i % 3 else "F",
                     "A" if i % 5 == 0 else "N", base + dt.timedelta(days=int(rng.integers(0, 40)))))
    for k in range(100, 100 + 1500):               # 1500 small orders, 4 items each
        for j in range(4):
            rows.append((k, j + 1, float(rng.integers(1, 50)), "O" if (k + j) % 2 else "F",
                         "R", base + dt.timedelta(days=int(rng.integers(0, 300)))))
    rows.append((9, 1, 5.0, "O", "N", base))   # single-item order
    return pd.DataFrame(rows, columns=["l_orderkey", "l_linenumber", "l_quantity", "l_linestatus",
                                       "l_returnflag", "l_shipdate"]).assign(l_partkey=1, l_suppkey=1)


def test_hot_order_matches_per_item_window(spark):
    li = _items()
    sdf = spark.createDataFrame(li).selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", "l_linestatus", "l_returnflag",
        "CAST(l_shipdate AS TIMESTAMP_NTZ) AS l_shipdate", "l_partkey", "l_suppkey")
    got = flow_stats(sdf).toPandas().set_index("k").sort_index()
    con = duckdb.connect()
    con.register("li", li)
    want = con.sql(PER_ITEM_SQL).df().set_index("k").sort_index()
    assert list(got.index) == list(want.index)
    for c in COLS:
        g, w = got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float)
        assert np.allclose(g, w, rtol=1e-9, atol=1e-9, equal_nan=True), c
    assert got.loc[7, "iatn"] == 0.0 and got.loc[7, "nf"] + got.loc[7, "nb"] == 3000
    assert np.isnan(got.loc[9, "sd"]) or got.loc[9, "sd"] is None


def _frame(spark, rows):
    return spark.createDataFrame(rows, "l_orderkey long, l_quantity double, l_linestatus string, l_returnflag string, l_shipdate timestamp_ntz")


def test_both_forms_agree(spark, monkeypatch):
    """Orders dealt whole and orders summed by day first: the same statistics,
    with null days, lengths and keys, and in the partitions asked for."""
    day = dt.datetime(1996, 3, 1)
    rows = [(k % 40, None if k % 11 == 0 else float(k % 7), "OFX"[k % 3], "AN"[k % 2],
             None if k % 5 == 0 else day + dt.timedelta(days=k * k % 9)) for k in range(400)]
    rows += [(None, 2.0, "O", "A", day), (None, 3.0, None, None, None), (99, 1.0, "F", "A", None)]
    li = _frame(spark, rows)
    whole = flow_stats(li, 5)
    assert whole.rdd.getNumPartitions() == 5
    monkeypatch.setattr(fl, "HOT_ITEMS", 9)            # orders of ten items are hot
    mixed = flow_stats(li, 5)
    assert mixed.columns == whole.columns and mixed.rdd.getNumPartitions() == 5
    key = lambda r: (r["k"] is None, r["k"] or 0)
    for a, b in zip(sorted(whole.collect(), key=key), sorted(mixed.collect(), key=key), strict=True):
        for c in whole.columns:
            x, y = a[c], b[c]
            assert (x is None) == (y is None) and (x is None or np.isclose(x, y, rtol=1e-12, atol=1e-12)), (a["k"], c, x, y)


def test_a_hot_order_does_not_reach_one_task_whole(spark, monkeypatch):
    seen = []
    by_day = fl._stats_by_day
    monkeypatch.setattr(fl, "HOT_ITEMS", 1000)
    monkeypatch.setattr(fl, "_stats_by_day", lambda li: seen.append({r["k"] for r in li.select("k").distinct().collect()}) or by_day(li))
    day = dt.datetime(1996, 3, 1)
    li = _frame(spark, [(7 if i < 1500 else i, 1.0, "O", "A", day) for i in range(3000)])
    got = {r["k"]: r["n_items"] for r in flow_stats(li, 4).collect()}
    assert got[7] == 1500 and len(got) == 1501 and len(seen) == 1 and 7 in seen[0] and len(seen[0]) < 100
