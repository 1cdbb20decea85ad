"""DuckDB oracle SQL: the same results written independently as plain SQL.

The CTE chain mirrors the scoring contract: ``flows`` -> ``prep`` (cleaned
float32 features) -> ``scaler`` (quartiles of all rows)
-> ``scaled`` -> ``rec`` (fixture reconstruction error) -> ``scored``.
"""

from __future__ import annotations

from flowspark import config
from flowspark.plans.fixtures import (FIXTURE_CLASSES, RECON_FACTOR, STREAM_ANOMALY_VALUE,
                                      STREAM_ATTACK_VALUE, STREAM_BATCH)
from flowspark.sources.flows import FLOW_FEATURES, FLOWS_SQL

FEATS = config.FEATURE_ORDER
PRESENT = set(FLOW_FEATURES.values())
RAW_FEATURES = list(FLOW_FEATURES.values())


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def md5_key(id_expr: str = "flow_id", seed: int = config.SEED) -> str:
    return f"md5('{seed}:' || CAST({id_expr} AS VARCHAR))"


def filled_expr(n: str) -> str:
    return f"CAST({q(n)} AS DOUBLE)" if n in PRESENT else "CAST(0.0 AS DOUBLE)"


def log1p_expr(n: str) -> str:
    if n in PRESENT and n in config.LOG1P_SET:
        return f"ln(1 + greatest(CAST({q(n)} AS DOUBLE), 0.0))"
    return filled_expr(n)


def prep_expr(n: str) -> str:
    if n not in PRESENT:
        return "CAST(0.0 AS FLOAT)"
    v = log1p_expr(n)
    clean = f"CASE WHEN {v} IS NULL OR isnan({v}) OR isinf({v}) THEN 0.0 ELSE {v} END"
    return f"CAST(least(greatest({clean}, -1e9), 1e9) AS FLOAT)"


def feature_list(exprs) -> str:
    return ",\n  ".join(f"{e} AS {q(n)}" for n, e in exprs)


PREP = "prep AS (SELECT flow_id, \"Label\",\n  " + feature_list(
    (n, prep_expr(n)) for n in FEATS) + "\n FROM flows)"

FEATURE_INDEX = "fi AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {s(n)})" for i, n in enumerate(FEATS)) + ") t(idx, feature))"

SCALER = f"""{FEATURE_INDEX},
ul AS (UNPIVOT prep ON {", ".join(q(n) for n in FEATS)} INTO NAME feature VALUE v),
scq AS (SELECT fi.idx, ul.feature,
   quantile_cont(CAST(v AS DOUBLE), 0.25) AS q1,
   quantile_cont(CAST(v AS DOUBLE), 0.5) AS center,
   quantile_cont(CAST(v AS DOUBLE), 0.75) AS q3
 FROM ul JOIN fi ON ul.feature = fi.feature GROUP BY fi.idx, ul.feature),
scaler AS (SELECT CAST(idx AS INTEGER) AS idx, feature, q1, center, q3,
   CASE WHEN q3 - q1 = 0 THEN 1.0 ELSE q3 - q1 END AS scale FROM scq),
scw AS (SELECT {", ".join(
    f"max(CASE WHEN idx = {i} THEN center END) AS c{i}, "
    f"max(CASE WHEN idx = {i} THEN scale END) AS s{i}" for i in range(len(FEATS)))} FROM scaler)"""

SCALED = "scaled AS (SELECT p.flow_id, p.\"Label\",\n  " + feature_list(
    (n, f"CAST((p.{q(n)} - w.c{i}) / w.s{i} AS FLOAT)") for i, n in enumerate(FEATS)) + \
    "\n FROM prep p CROSS JOIN scw w)"


def sq_err(n: str) -> str:
    x = f"CAST({q(n)} AS DOUBLE)"
    d = f"({x} - {x} * CAST({RECON_FACTOR} AS DOUBLE))"
    return f"({d} * {d})"


def _fold(terms: list[str]) -> str:
    acc = "0.0"
    for t in terms:
        acc = f"({acc} + {t})"
    return acc


REC = (f"rec AS (SELECT flow_id, \"Label\", {_fold([sq_err(n) for n in FEATS])} / {len(FEATS)} "
       f"AS mse FROM scaled)")
THR = "thr AS (SELECT avg(mse) AS err_mean, stddev_pop(mse) AS err_std, " \
      "avg(mse) + 3 * stddev_pop(mse) AS threshold FROM rec)"

_true_idx = "CASE \"Label\" " + " ".join(
    f"WHEN {s(c)} THEN {i}" for i, c in enumerate(FIXTURE_CLASSES)) + " ELSE 0 END"
_hot = f"(({_true_idx}) + CASE WHEN flow_id % 9 = 0 THEN 1 ELSE 0 END) % {len(FIXTURE_CLASSES)}"
_cls = "CASE hot " + " ".join(f"WHEN {i} THEN {s(c)}" for i, c in enumerate(FIXTURE_CLASSES)) + " END"
P_ATTACK = ("CASE WHEN flow_id % 211 = 0 THEN CAST(0.01 AS DOUBLE) "
            "WHEN \"Label\" = 'BENIGN' THEN (flow_id % 64) / CAST(4096 AS DOUBLE) "
            "ELSE (flow_id % 64) / CAST(64 AS DOUBLE) END")

RULE = f"""rule AS (SELECT r.flow_id, r."Label", r.mse, {P_ATTACK} AS p_attack,
   {_true_idx} AS true_idx, {_hot} AS hot FROM rec r)"""


def scored_cte(inclusive: bool = False) -> str:
    op = "<=" if inclusive else "<"
    return f"""scored AS (SELECT u.flow_id, u."Label" AS "Actual", u.p_attack, u.mse, u.true_idx, u.hot,
   CASE WHEN u.p_attack {op} {config.ATTACK_THRESHOLD} THEN 'BENIGN' ELSE {_cls} END AS "Final_Prediction",
   CASE WHEN u.p_attack {op} {config.ATTACK_THRESHOLD} THEN 'BENIGN' ELSE 'ATTACK' END AS "Binary_Route",
   round(CASE WHEN u.p_attack {op} {config.ATTACK_THRESHOLD} THEN 1.0 - u.p_attack
              ELSE CAST(0.625 AS DOUBLE) END, 4) AS "Confidence",
   (NOT (u.p_attack {op} {config.ATTACK_THRESHOLD})) AND coalesce(u.mse > t.threshold, false) AS "Anomaly"
 FROM rule u CROSS JOIN thr t)"""


def with_chain(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CHAIN_PREP = [FLOWS_SQL.strip(), PREP]
CHAIN_SCALER = CHAIN_PREP + [SCALER]
CHAIN_SCALED = CHAIN_SCALER + [SCALED]
CHAIN_REC = CHAIN_SCALED + [REC, THR]


def chain_scored(inclusive: bool = False) -> list[str]:
    return CHAIN_REC + [RULE, scored_cte(inclusive)]


STREAM_RULE = f"""ev AS (SELECT event_id, CAST(floor(event_id / {STREAM_BATCH}) AS BIGINT) AS batch,
   CASE WHEN value >= {STREAM_ATTACK_VALUE} THEN event_type ELSE 'BENIGN' END AS "Final_Prediction",
   CASE WHEN value >= {STREAM_ATTACK_VALUE} THEN 'ATTACK' ELSE 'BENIGN' END AS "Binary_Route",
   CASE WHEN value >= {STREAM_ATTACK_VALUE} THEN least(value / CAST(500 AS DOUBLE), 1.0)
        ELSE CAST(1.0 AS DOUBLE) END AS "Confidence",
   (value >= {STREAM_ATTACK_VALUE}) AND (value > {STREAM_ANOMALY_VALUE}) AS "Anomaly"
 FROM events)"""
