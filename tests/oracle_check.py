"""Run registered queries in Spark and their SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if v is pd.NA:      # a null whole number; a null in a float column is NaN
        return "nan"
    if isinstance(v, (float, np.floating)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        if math.isinf(f):
            return "inf" if f > 0 else "-inf"
        return float(f"{f:.12g}")
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    return v


def canon(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sp = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    dk = con.sql(sql).df()
    t2 = time.time()
    ok_cols = sorted(sp.columns) == sorted(dk.columns)
    ok_n = len(sp) == len(dk)
    ok_v = ok_cols and ok_n and canon(sp) == canon(dk)
    status = "OK " if ok_v else "BAD"
    print(f"{status} {name:28s} rows={len(sp)}/{len(dk)} cols={'ok' if ok_cols else 'DIFF'} "
          f"spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s", flush=True)
    if not ok_cols:
        print("   spark:", sorted(sp.columns)[:10], "\n   duck: ", sorted(dk.columns)[:10])
    elif not ok_v:
        a, b = canon(sp), canon(dk)
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        for x, y in bad:
            print("   spark:", x, "\n   duck: ", y)
    return ok_v


def main(argv):
    sys.path.insert(0, ".")
    from flowspark.session import build_session
    import __spark_entry__ as E
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = build_session()
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad, ok, rows_only = [], 0, 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in orc:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROW {name:28s} rows={n} (no oracle) {time.time() - t0:.1f}s", flush=True)
            rows_only += 1
            continue
        try:
            if compare(spark, con, name, fn, orc[name], sf_dir):
                ok += 1
            else:
                bad.append(name)
        except Exception as e:  # noqa: BLE001
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad.append(name)
    print(f"SUMMARY oracle-equal={ok} failed={len(bad)} rows-only={rows_only}")
    print("FAILED:", bad)


if __name__ == "__main__":
    main(sys.argv)
