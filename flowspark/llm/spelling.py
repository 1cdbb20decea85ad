"""Spelling variants of a corpus' words, by finite-state composition.

The vocabulary is a minimised acceptor, built from sorted words.  Composed
with a one-edit transducer and with the acceptor again, it accepts the pairs
of words that one inserted, deleted or replaced code point parts.  A state of
the composition is (state, edits left, state): with the edit unspent both
sides are one state, and with it spent the pair accepts what both states
accept.  Words are numbered by counting accepted strings, so an enumeration
handles numbers, never strings, and both kinds of states are solved once
however many words share them.

Initial states are dealt over tasks.  Of two words with one edit between
them, the longer of b code points, the first or the last half of b - 1 agree;
so a word enters the machine under its first and its last half, for b its own
length and one more.  A half that more than ``GROUP`` words share is refined:
the part between is halved again, until each initial state has few words or
only one code point is open.  Every pair is found at least once, and no task
holds a frequent beginning or ending whole.

Forms then follow the pairs: a word's form is its near word of largest count,
if that is at least ``TIMES`` its own; the root is the end of the chain,
found by pointer doubling (counts grow by ``TIMES`` a step, so chains are
short).

Defined results: null text has no words; a null id reads as ''; rows with one
id count separately.  Other columns are ignored.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import ASCII_LOWER, slices, staged, text_or_empty

RUN = r"[A-Za-zÀ-ÿ]+"
FOLD = 199              # runs whose crc32 it divides lose a code point
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5
GROUP = 2_000           # words of one initial state
HELD = 200_000          # counts, and words of an acceptor, that a task holds

_RUN, _GAP = re.compile(RUN), re.compile(r"[^A-Za-zÀ-ÿ]")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of words, added up within a task as far as its memory goes."""
    held: Counter = Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             ["word", "n"])
        held.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for doc, text in zip(*[c.to_pylist() for c in batch.slice(at, 64).columns]):
                start = zlib.crc32(f"{doc}:".encode())
                for part in slices(text, _GAP):
                    for run, n in Counter(_RUN.findall(part)).items():
                        run = run.translate(ASCII_LOWER)
                        size = len(run)
                        if size < LEAST_LENGTH:
                            continue
                        h = zlib.crc32(run.encode(), start)
                        if h % FOLD == 0:
                            run = run[:h % size] + run[h % size + 1:]
                            if size == LEAST_LENGTH:
                                continue
                        held[run] += n
                if len(held) > HELD:
                    yield from flush()
    yield from flush()


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words that occur often enough."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), text_or_empty(text).alias("text"))
    return (rows.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


# -- the machine ------------------------------------------------------------

class Acceptor:
    """A minimised acyclic acceptor of sorted words; states are numbered with
    children first.  ``accepted[s]``: how many strings state s accepts."""

    def __init__(self) -> None:
        self.known: dict[tuple, int] = {}
        self.states: list[tuple[bool, tuple]] = []
        self.accepted: list[int] = []
        # arcs by letter: (next state, accepted strings that come before it)
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self._both: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._near: dict[int, list[tuple[int, int]]] = {}

    def _state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, tuple(arcs))
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.states)
            self.states.append(key)
            n, by = int(final), {}
            for letter, to in arcs:
                by[letter] = to, n
                n += self.accepted[to]
            self.accepted.append(n)
            self.arcs.append(by)
        return at

    def add(self, words: list[str]) -> int:
        """The initial state of distinct words in order: ``words[i]`` is the
        string of number i that it accepts."""
        path: list[list] = [[False, []]]      # the last word's states, still open

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                path[-1][1][-1] = path[-1][1][-1][0], self._state(final, arcs)

        last = ""
        for word in words:
            shared = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                shared += 1
            close(shared)
            for letter in word[shared:]:
                path[-1][1].append((letter, -1))
                path.append([False, []])
            path[-1][0] = True
            last = word
        close(0)
        return self._state(*path[0])

    def both(self, p: int, q: int) -> list[tuple[int, int]]:
        """Numbers, from p and from q, of the strings that both accept: the
        composition's states with the edit spent."""
        if p > q:
            return [(i, j) for j, i in self.both(q, p)]
        got = self._both.get((p, q))
        if got is None:
            if p == q:
                got = [(i, i) for i in range(self.accepted[p])]
            else:
                got = [(0, 0)] if self.states[p][0] and self.states[q][0] else []
                other = self.arcs[q]
                for letter, (to, before) in self.arcs[p].items():
                    if letter in other:
                        to_q, before_q = other[letter]
                        got += [(before + i, before_q + j) for i, j in self.both(to, to_q)]
            self._both[p, q] = got
        return got

    def near(self, s: int) -> list[tuple[int, int]]:
        """Numbers of the accepted pairs one edit apart, each pair once: the
        composition's states with the edit unspent."""
        got = self._near.get(s)
        if got is None:
            arcs = list(self.arcs[s].items())
            got = []
            for k, (letter, (to, before)) in enumerate(arcs):
                got += [(before + i, before + j) for i, j in self.near(to)]          # no edit yet
                for _, (to_b, before_b) in arcs[k + 1:]:                              # replaced here
                    got += [(before + i, before_b + j) for i, j in self.both(to, to_b)]
                # deleted here: of equal letters in a row the last, so the rest must not begin with it
                beyond = before + self.accepted[to]
                got += [(before + i, j) for i, j in self.both(to, s) if not before <= j < beyond]
            self._near[s] = got
        return got


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (word, n, near, near_n), each once a group, of rows (context,
    longer, low, tail, word, n) in the order of their contexts."""
    machine, words = Acceptor(), 0

    def solve(group: list[tuple]) -> list[tuple]:
        nonlocal machine, words
        rows = sorted((word[low:len(word) - tail], word, n) for low, tail, word, n in group)
        deepest = 100 + 4 * max(len(r[0]) for r in rows)
        if sys.getrecursionlimit() < deepest:
            sys.setrecursionlimit(deepest)
        if words > HELD:
            machine, words = Acceptor(), 0
        words += len(rows)
        return [(rows[i][1], rows[i][2], rows[j][1], rows[j][2])
                for i, j in machine.near(machine.add([r[0] for r in rows]))]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        a, na, b, nb = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(na, pa.int64()), pa.array(b, pa.string()),
                                           pa.array(nb, pa.int64())], ["word", "n", "near", "near_n"])

    def groups() -> Iterator[tuple[int, list]]:
        last, longer, group = None, 0, []
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                for context, b, *row in zip(*[c.to_pylist() for c in batch.slice(at, 4096).columns]):
                    if context != last:
                        if len(group) > 1:
                            yield longer, group
                        last, longer, group = context, b, []
                    group.append(row)
        if len(group) > 1:
            yield longer, group

    found: list[tuple] = []
    for longer, group in groups():
        # two words of the lesser length meet under that length
        found += [x for x in solve(group) if len(x[0]) == longer or len(x[2]) == longer]
        if len(found) > 50_000:
            yield batch_of(found)
            found = []
    if found:
        yield batch_of(found)


# -- initial states ---------------------------------------------------------

def _halved(rows: DataFrame) -> DataFrame:
    """Each row's open part halved, first half shared and last half shared.
    ``low`` and ``tail`` code points at both ends are shared already."""
    half = F.ceil((F.col("longer") - F.col("low") - F.col("tail") - 1) / 2).cast("int")
    grown = F.array(F.struct((F.col("low") + half).alias("low"), F.col("tail").alias("tail")),
                    F.struct(F.col("low").alias("low"), (F.col("tail") + half).alias("tail")))
    out = rows.withColumn("_g", F.explode(grown)).select("longer", "_g.low", "_g.tail", "word", "n")
    return out.withColumn("context", _context())


def _context() -> Column:
    """The initial state: lengths, and the letters that its words share."""
    return F.concat_ws(":", "longer", "low", "tail", F.substring(F.col("word"), F.lit(1), F.col("low")), F.substring(
        F.col("word"), F.length("word") - F.col("tail") + 1, F.col("tail")))


def initial_states(spark: SparkSession, words: DataFrame, group: int = GROUP) -> DataFrame:
    """(context, longer, low, tail, word, n): every word under its initial
    states, of which none has more than ``group`` words unless a single code
    point is open."""
    rows = words.select(F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer"), F.lit(0).alias("low"),
                        F.lit(0).alias("tail"), "word", "n")
    rows, done = staged(spark, _halved(rows), "initial-states"), []
    while True:
        hot = (rows.groupBy("context", "longer", "low", "tail").agg(F.count(F.lit(1)).alias("_n"))
               .where((F.col("_n") > group) & (F.col("longer") - F.col("low") - F.col("tail") > 1)).select("context"))
        hot = staged(spark, hot, "hot-states")
        if hot.isEmpty():
            break
        done.append(rows.join(hot, "context", "left_anti"))
        rows = staged(spark, _halved(rows.join(hot, "context", "left_semi")), "initial-states")
    for d in done:
        rows = rows.unionByName(d)
    return rows.select("context", "longer", "low", "tail", "word", "n")


def near_pairs(spark: SparkSession, words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n, near, near_n): every two words one edit apart, both ways."""
    rows = initial_states(spark, words, group)
    found = (rows.repartition("context").sortWithinPartitions("context")
             .mapInArrow(_pairs, "word string, n long, near string, near_n long"))
    a, b = F.struct("word", "n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"))
    both = F.array(F.struct(a.alias("a"), b.alias("b")), F.struct(b.alias("a"), a.alias("b")))
    return (found.select(F.explode(both).alias("p")).select("p.a.word", "p.a.n", F.col("p.b.word").alias("near"),
                                                            F.col("p.b.n").alias("near_n")).distinct())


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last of the chain of forms.  Each
    step doubles how far a row's root is from it."""
    at = staged(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        at = staged(spark, at.join(following, "root", "left"), "roots")
        if at.where("_next IS NOT NULL").isEmpty():
            return at.select("word", "root")
        at = at.select("word", F.coalesce("_next", "root").alias("root"))


def group_words(spark: SparkSession, words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n)."""
    best = F.min(F.struct((-F.col("near_n")).alias("least"), F.col("near").alias("form")))
    stats = near_pairs(spark, words, group).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    counts = F.when(-F.col("best.least") >= TIMES * F.col("n"), -F.col("best.least"))
    stats = staged(spark, stats.select("word", "n_near", counts.alias("form_n"), F.when(counts.isNotNull(), F.col("best.form"))
                                       .alias("form")), "near-words")
    ends = roots(spark, stats.where("form IS NOT NULL"))
    return (words.join(stats, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))


def group_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of ``docs``."""
    return group_words(spark, staged(spark, vocabulary(docs), "vocabulary"))


# crc32 by its table: its 256 entries follow from eight shifts each
_STEP = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
_ENTRY = "i"
for _ in range(8):
    _ENTRY = f"list_transform([{_ENTRY}], lambda x: {_STEP})[1]"

SPELLING_SQL = f"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda i: {_ENTRY}) AS c),
d AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
      FROM documents),
r AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
      FROM d GROUP BY ALL),
x AS (SELECT run, n, hex(id || ':' || run) AS x FROM r WHERE length(run) >= {LEAST_LENGTH}),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda k:
          (16 * instr('123456789ABCDEF', substr(x, (2 * k + 1)::INT, 1))
           + instr('123456789ABCDEF', substr(x, (2 * k + 2)::INT, 1)))::BIGINT)),
          lambda a, b: xor(a >> 8, c[(xor(a, b) & 255) + 1])), 4294967295) AS h
      FROM x, crc_table),
w AS (SELECT CASE WHEN h % {FOLD} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
             ELSE run END AS word, n FROM h),
words AS (SELECT word, sum(n)::BIGINT AS n FROM w GROUP BY word HAVING length(word) >= {LEAST_LENGTH} AND sum(n) >= {LEAST_COUNT}),
cuts AS (SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest
         FROM (SELECT word, n, unnest(range(length(word)))::INT AS k FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT c.word, c.n, v.word, v.n FROM cuts c JOIN words v ON c.rest = v.word
  UNION SELECT v.word, v.n, c.word, c.n FROM cuts c JOIN words v ON c.rest = v.word),
best AS (SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
           row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM near),
forms AS (SELECT word, n_near, CASE WHEN near_n >= {TIMES} * n THEN near END AS form,
            CASE WHEN near_n >= {TIMES} * n THEN near_n END AS form_n FROM best WHERE r = 1),
chain AS (SELECT word, form AS root, 1 AS step FROM forms WHERE form IS NOT NULL
          UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT w.word, f.form, coalesce(e.root, w.word) AS root, w.n, coalesce(f.n_near, 0)::BIGINT AS n_near, f.form_n
FROM words w LEFT JOIN forms f USING (word) LEFT JOIN ends e USING (word)
"""
