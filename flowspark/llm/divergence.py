"""Audit of how sources of one language differ in their words.

Every (lang, source) group is a column of counts over its language's kept
terms.  Terms with equal counts in all groups are interchangeable, so the
vocabulary is reordered by its rows of counts: equal rows become one run, and
neighbouring rows mostly agree in most columns.  Each column is then
run-length encoded, a block of rows a task, and a pair of groups is compared
by intersecting the run boundaries of its two columns: the term
``f = floor((p - q)^2 / q)`` is computed once a run and multiplied by the
run's length.  Sums of blocks add up.

p and q are whole numbers (billionths, smoothed by one), computed in decimals
or Python integers; f and its sums stay below 2^63 as p sums to about 10^9.

Shuffles: counts by (lang, term, source), pre-aggregated in tasks; rows of
counts by their range.  No task holds a language's vocabulary: a language (or
source) with a third of all rows is spread by its terms.  What grows with the
square of the sources of a language is the result.

Defined results: null text, lang or source is ''.  Rows with one id are
documents of their own.  A language whose terms are all rare has V = 0: its
pairs have value 0 and no terms.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowspark.llm.common import slices, staged, text_or_empty

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
HELD = 500_000          # counts a task holds before it hands them on
BLOCK_CELLS = 400_000   # counts of a block of run-length columns
BLOCK_SIZE = 8_000_000  # its rows times its columns

_TERM, _GAP = re.compile(TERM), re.compile(r"[\x00-\x40\x5B-\x60\x7B-\x7F]")
COUNTS = "lang string, source string, term string, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, added up within a
    task as far as its memory goes."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(n)), pa.repeat(source, len(n)), pa.array(n.keys(), pa.string()),
                     pa.array(n.values(), pa.int64()), pa.array(map(docs.__getitem__, n), pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for lang, source, text in zip(*[c.to_pylist() for c in batch.slice(at, 64).columns]):
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                seen: set[str] = set()
                for part in slices(text, _GAP):
                    terms = _TERM.findall(part.encode().lower().decode())    # of bytes, lower() is A-Z alone
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                size += len(n) - before
            if size > HELD:
                yield from flush()
                size = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, kept columns): of every term in at least LEAST_DOCS
    documents of its language, ``cells``: (source, n) by source, and ``n``."""
    # one shuffle, by term: both groupings find their rows in place
    rows = (docs.select("lang", "source", "text").mapInArrow(_count, COUNTS).repartition("lang", "term")
            .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (rows.groupBy("lang", "term")
            .agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("cells"), F.sum("n").alias("n"),
                 F.sum("docs").alias("docs"))
            .where(F.col("docs") >= LEAST_DOCS).drop("docs"))


def share(n: Column, total: Column, v: Column) -> Column:
    """p of a count, exact: 1 + floor(SCALE * (n + 1) / (total + v))."""
    wide = "decimal(24,0)"
    return F.lit(1).cast("long") + F.call_function(
        "div", (F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast(wide)).cast("decimal(38,0)"),
        (total + v).cast(wide)).cast("long")


def penalty(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of whole numbers up to about 10^9."""
    return F.call_function("div", (p - q) * (p - q), q)


def _blocks(batches: Iterator[pa.RecordBatch], columns: dict[str, int]) -> Iterator[tuple[str, pa.Table]]:
    """Rows (lang, cells, length) in order, cut into blocks of one language.
    ``columns``: how many sources a language has."""
    held: list[pa.RecordBatch] = []
    lang, rows, size = None, 0, 0
    for batch in batches:
        codes = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.append(0, np.flatnonzero(np.diff(codes)) + 1).tolist() if len(codes) else []
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            for at in range(start, end, 1024):
                some = batch.slice(at, min(1024, end - at))
                its = some.column(0)[0].as_py()
                if held and (its != lang or size > BLOCK_CELLS or rows * columns[lang] > BLOCK_SIZE):
                    yield lang, pa.Table.from_batches(held)
                    held, rows, size = [], 0, 0
                lang = its
                held.append(some)
                rows += some.num_rows
                size += len(some.column(1).flatten())
    if held:
        yield lang, pa.Table.from_batches(held)


class Runs:
    """A column over the rows of a block, run-length encoded: which rows end
    a run, which run each row is in, and the runs' counts."""

    def __init__(self, column: np.ndarray):
        self.ends = np.append(column[1:] != column[:-1], True)
        self.run = np.cumsum(self.ends) - self.ends
        self.counts = column[self.ends]


def run_lengths(cells: pa.ListArray, sources: list[str]) -> dict[str, Runs]:
    """The columns of ``sources`` over rows of (source, n) lists; those
    without a count are one run of 0."""
    flat = cells.flatten()
    row = np.repeat(np.arange(len(cells)), cells.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    coded = flat.field("source").dictionary_encode()
    code, n = coded.indices.to_numpy(zero_copy_only=False), flat.field("n").to_numpy(zero_copy_only=False)
    by_code = np.argsort(code, kind="stable")
    bounds = np.searchsorted(code[by_code], np.arange(len(coded.dictionary) + 1))
    at = {s: by_code[bounds[k]:bounds[k + 1]] for k, s in enumerate(coded.dictionary.to_pylist())}
    none = Runs(np.zeros(len(cells), np.int64))
    out = {}
    for source in sources:
        if source in at:
            column = np.zeros(len(cells), np.int64)
            column[row[at[source]]] = n[at[source]]
            out[source] = Runs(column)
        else:
            out[source] = none
    return out


def _shares(counts: np.ndarray, total: int) -> np.ndarray:
    """p of each count; whole numbers beyond 64 bits on the way."""
    values, back = np.unique(counts, return_inverse=True)
    return np.array([1 + SCALE * (c + 1) // total for c in values.tolist()], np.int64)[back]


def _compare(totals: dict[str, dict[str, int]]):
    """Partial sums of f over the blocks of a task, by ordered pair of groups.
    ``totals``: N + V of the groups, by lang and source."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches, {k: len(v) for k, v in totals.items()}):
            before = np.append(0, np.cumsum(block.column("length").to_numpy()))    # terms before each row
            cells = pa.concat_arrays(block.column("cells").chunks)
            columns = run_lengths(cells, list(totals[lang]))
            shares = {s: _shares(c.counts, totals[lang][s]) for s, c in columns.items()}
            for a, x in columns.items():
                items, values = [], []
                for b, y in columns.items():
                    if a != b:
                        ends = np.flatnonzero(x.ends | y.ends)
                        p, q = shares[a][x.run[ends]], shares[b][y.run[ends]]
                        items.append(b)
                        values.append(int(((p - q) * (p - q) // q * np.diff(before[ends + 1], prepend=0)).sum()))
                if items:
                    yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(items)), pa.repeat(a, len(items)),
                                                      pa.array(items, pa.string()), pa.array(values, pa.int64())],
                                                     ["lang", "source", "item", "value"])
    return run


def audit(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) of (lang, source, text)."""
    docs = docs.select(*[text_or_empty(c).alias(c) for c in ("lang", "source", "text")])
    terms = staged(spark, term_counts(docs), "terms")
    kept = staged(spark, terms.select("lang", "term", F.explode("cells").alias("c"), F.col("n").alias("lang_n"))
                  .select("lang", "term", "c.source", "c.n", "lang_n"), "kept-terms")
    # one row a group, also of groups without kept terms, with the sizes of the group and its language
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    by_lang = terms.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("v"))
    groups = staged(spark, docs.select("lang", "source").distinct().join(by_group, ["lang", "source"], "left")
                    .join(by_lang, "lang", "left").fillna(0), "groups")

    return _ranked(_pairs(spark, terms, groups), "pair", None).unionByName(_ranked(_terms(kept, groups), "term", TOP_TERMS))


def _ranked(rows: DataFrame, part: str, top: int | None) -> DataFrame:
    """``rows`` with their rank in the group; Spark keeps only the first of a
    limited rank before it shuffles."""
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    if top:
        out = out.where(F.col("rank") <= top)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")


def _pairs(spark: SparkSession, terms: DataFrame, groups: DataFrame) -> DataFrame:
    """The value of every ordered pair of sources of a language."""
    # the rows of counts, each distinct one a run, in an order that keeps equal counts together
    rows = staged(spark, terms.groupBy("lang", "cells").agg(F.count(F.lit(1)).alias("length")), "count-rows")
    totals: dict[str, dict[str, int]] = {}
    for r in groups.where(F.col("v") > 0).select("lang", "source", (F.col("group_n") + F.col("v")).alias("t")).collect():
        totals.setdefault(r["lang"], {})[r["source"]] = r["t"]
    sums = (rows.repartitionByRange("lang", "cells").sortWithinPartitions("lang", "cells")
            .select("lang", "cells", "length").mapInArrow(_compare(totals), "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where(
        "source <> item")
    return pairs.join(sums, ["lang", "source", "item"], "left").fillna(0, subset=["value"])


def _terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """The value of every kept term that a group has more of than its language."""
    p = share(F.col("n"), F.col("group_n"), F.col("v"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    return (kept.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
            .where("p > q").select("lang", "source", "item", penalty(F.col("p"), F.col("q")).alias("value")))


AUDIT_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
size AS (SELECT g.lang, g.source, coalesce(sum(n.n), 0)::HUGEINT AS total,
    (SELECT count(*) FROM kept k WHERE k.lang = g.lang)::HUGEINT AS v,
    (SELECT coalesce(sum(k.lang_n), 0) FROM kept k WHERE k.lang = g.lang)::HUGEINT AS lang_total
  FROM g LEFT JOIN n ON g.lang = n.lang AND g.source = n.source GROUP BY g.lang, g.source),
p AS (SELECT s.lang, s.source, k.term, coalesce(n.n, 0) AS n,
    1 + ({SCALE} * (coalesce(n.n, 0) + 1)::HUGEINT) // (s.total + s.v) AS p,
    1 + ({SCALE} * (k.lang_n + 1)::HUGEINT) // (s.lang_total + s.v) AS q
  FROM size s JOIN kept k ON k.lang = s.lang
  LEFT JOIN n ON n.lang = s.lang AND n.source = s.source AND n.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
    coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // y.p) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
              WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT FROM terms)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
