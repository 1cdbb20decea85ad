"""Exact quantiles of many columns over all rows.

1. One pass builds a mergeable KLL sketch of every column; its quantiles a
   little below and above the wanted ones bracket each of them.
2. One pass groups the cells by column: values inside a bracket by value (a
   few percent of the cells at most), all others by the gap between brackets
   in which they lie.
3. The wanted order statistics are found in the grouped cells by prefix sums
   over ranges (:mod:`flowspark.operators.prefix`).

A bracket that does not hold its order statistics (the sketch promises a
small probability) is opened to all values, so the result is always exact.
No task holds a column; the driver reads one row of sketches' quantiles and
the selected values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.functions.cleaning import fcol
from flowspark.operators.prefix import prefix_sums
from flowspark.session import write_table

SKETCH_K = 4096      # rank error of the sketch: about 0.13 %
MARGIN = 0.005       # ranks by which a bracket is wider than its quantile


def _merged(intervals: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The union of closed intervals as disjoint ones, ascending."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(intervals):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], hi)
        else:
            out.append((lo, hi))
    return out


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)
                    ) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of finite, non-null numeric columns;
    None for each if there are no rows."""
    columns = list(columns)
    if not columns:
        return {}
    value = [fcol(c).cast("double") for c in columns]
    around = F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in probs for d in (-MARGIN, MARGIN)])
    sketches = df.agg(F.count(F.lit(1)).alias("n"),
                      *[F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias(f"s{i}") for i, v in enumerate(value)])
    got = sketches.select("n", *[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(F.col(f"s{i}"), around))
                                 .alias(f"s{i}") for i in range(len(columns))]).first()
    n = got["n"]
    if not n:
        return {c: [None] * len(probs) for c in columns}
    # wanted order statistics: the two ranks around each position
    at = [p * (n - 1) for p in probs]
    brackets = {i: _merged([(got[f"s{i}"][2 * j], got[f"s{i}"][2 * j + 1]) for j in range(len(probs))]) for i in range(len(columns))}
    found: dict[int, dict[int, float]] = {}
    while brackets:
        selected = _select(df, value, brackets, sorted({r for x in at for r in (math.floor(x), math.ceil(x))}), n)
        missed = {i for i, ranks in selected.items() if None in ranks.values()}
        found |= {i: ranks for i, ranks in selected.items() if i not in missed}
        brackets = {i: [(-math.inf, math.inf)] for i in missed}

    def quantile(i: int, j: int) -> float:
        lo, hi = math.floor(at[j]), math.ceil(at[j])
        a, b = found[i][lo], found[i][hi]
        return a if a == b else (hi - at[j]) * a + (at[j] - lo) * b
    return {c: [quantile(i, j) for j in range(len(probs))] for i, c in enumerate(columns)}


def _region(v: Column, brackets: list[tuple[float, float]]) -> Column:
    """Where a value lies, ascending: 1, 3, .. inside the first bracket, the
    second, ..; even numbers are the gaps around them."""
    at = F
    for k, (lo, hi) in enumerate(brackets):
        at = at.when(v < F.lit(lo), F.lit(2 * k)).when(v <= F.lit(hi), F.lit(2 * k + 1))
    return at.otherwise(F.lit(2 * len(brackets)))


def _select(df: DataFrame, value: list[Column], brackets: dict[int, list[tuple[float, float]]], ranks: list[int], n: int
            ) -> dict[int, dict[int, float | None]]:
    """By column the values of the wanted ranks; None if one is in no bracket."""
    spark = df.sparkSession
    cells = F.array(*[F.struct(F.lit(i).alias("i"), _region(value[i], b).alias("r"), value[i].alias("v")) for i, b in brackets.items()])
    grouped = write_table(spark, df.select(F.explode(cells).alias("c")).select(
        "c.i", "c.r", F.when(F.col("c.r") % 2 == 1, F.col("c.v")).alias("v"))
        .groupBy("i", "r", "v").agg(F.count(F.lit(1)).alias("n")), "quantiles")
    rows = prefix_sums(grouped, ["i", "r", "v"], {"upto": "n"})
    # every column has n cells
    wanted = [(i, rank, k * n + rank) for k, i in enumerate(sorted(brackets)) for rank in ranks]
    targets = spark.createDataFrame(wanted, "i int, rank long, place long")   # two a quantile
    found = rows.join(F.broadcast(targets), "i").where(
        (F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("n")))
    out: dict[int, dict[int, float | None]] = {i: {} for i in brackets}
    for r in found.select("i", "rank", "v").collect():
        out[r["i"]][r["rank"]] = r["v"]
    return out
