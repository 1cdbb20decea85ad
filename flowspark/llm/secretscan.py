"""Secret scans with DataFrame expressions only.

Base rules find assignments, access keys and long hex strings.  On top of
them, two character Markov models, one of random strings and one of ordinary
identifiers, score every other long token by its log-likelihood ratio.  The
models are trained from labelled samples: the values that the base rules
matched are random; whole tokens made of words, of words and short numbers,
of parts joined by marks, and UUIDs are ordinary.  Part of the random model
is even over the alphabet, so it needs no samples.

The work on a text is close to linear in its matches: matches are extracted
once, positions and overlaps are prefix sums and maxima over blocks, and
redaction takes pieces from blocks of the text.

Positions are code points, end exclusive.  Defined results: null text counts
as empty; without ordinary samples no token is more likely random than
ordinary, so only base spans remain.  Columns named like the results are
replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import text_or_empty

# kind -> (pattern, group whose length counts, least length); in this order
# spans with one start are listed
RULES = {
    "assign": (r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 6),
    "access": (r"(AKIA[A-Z0-9]+)", 20),
    "hex": (r"([0-9a-f]{24,})", 24),
}
MODEL_KIND = "markov"
KINDS = [*RULES, MODEL_KIND]
TOKEN = r"([A-Za-z0-9+/_=-]{20,})"          # candidates of the models
# ordinary identifiers: whole tokens of these forms
_WORD = "[A-Za-z]{2,}"
ORDINARY = ("((?<![A-Za-z0-9+/_=-])(?:[A-Za-z_]{12,}"                       # words
            f"|{_WORD}[0-9]{{1,4}}(?:{_WORD}[0-9]{{0,4}}){{0,3}}"               # words and short numbers
            f"|{_WORD}(?:[-_/+=](?:{_WORD}[0-9]{{0,4}}|[0-9]{{1,4}}))+"           # parts joined by marks
            "|[0-9]{1,4}(?:[-_/][0-9]{1,4}){2,}"                              # dates, versions
            "|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"             # UUIDs
            ")(?![A-Za-z0-9+/_=-]))")
LEAST_SAMPLE = 8        # characters of an ordinary sample
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST_RATIO = 0.45      # nats a character by which a random string must be likelier
SMOOTHING = 0.5         # added to every character's count
BACKOFF = 20.0          # weight of a character's own share among its transitions
# share of a class's transitions that is even over the alphabet: random
# strings come in more alphabets than the samples show
EVEN = {True: 0.8, False: 0.02}
REDACTED = "[SECRET]"
_BLOCK = 256
_CHARS = 2048           # code points of a block of text
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _before(values: Column, zero: int, op: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values``, ``op`` over all before it; in blocks, so that
    the work stays far below the square of their number."""
    def over(a: Column) -> Column:
        return F.aggregate(a, F.lit(zero), lambda s, x: op(s, x))

    def scan(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int")),
                             lambda b: over(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK))))
        ahead = _bound(blocks, lambda bs: F.transform(bs, lambda _, b: over(F.slice(bs, F.lit(1), b))))
        return _bound(ahead, lambda hs: F.transform(v, lambda _, i: op(
            F.element_at(hs, F.floor(i / _BLOCK).cast("int") + 1),
            over(F.slice(v, (F.floor(i / _BLOCK) * _BLOCK).cast("int") + 1, i % _BLOCK)))))
    return _bound(values, lambda v: F.when(F.size(v) == 0, v).otherwise(scan(v)))


def matches(text: Column, pattern: str, kind: int, least: int) -> Column:
    """All leftmost non-overlapping matches of ``pattern`` whose first group
    has ``least`` characters, as (start, kind, end, value).  Each match is
    taken with the gap before it (\\G ties it to the one before), so the
    lengths add up to positions."""
    whole = F.lit(rf"\G(?s)(.*?)({pattern})")
    gap, hit, value = (F.regexp_extract_all(text, whole, F.lit(g)) for g in (1, 2, 3))
    rows = F.transform(F.arrays_zip(gap.alias("g"), hit.alias("h"), value.alias("v")), lambda x: F.struct(
        F.length(x["g"]).alias("g"), F.length(x["h"]).alias("h"), x["v"].alias("v")))

    def spans(r: Column) -> Column:
        begins = _before(F.transform(r, lambda x: x["g"] + x["h"]), 0, lambda a, b: a + b)
        placed = F.transform(F.arrays_zip(begins.alias("b"), r.alias("r")), lambda x: F.struct(
            (x["b"] + x["r"]["g"]).cast("int").alias("start"), F.lit(kind).alias("kind"),
            (x["b"] + x["r"]["g"] + x["r"]["h"]).cast("int").alias("end"), x["r"]["v"].alias("value")))
        return F.filter(placed, lambda x: F.length(x["value"]) >= least)
    return F.when(F.regexp_like(text, F.lit(pattern)), _bound(rows, spans)).otherwise(F.lit(None)).cast(_SPAN)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _none() -> Column:
    return F.array().cast(_SPAN)


def find_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base``: the spans of the rules, by start and kind."""
    t = text_or_empty(text)
    out = docs
    for i, (kind, (pattern, least)) in enumerate(RULES.items()):
        out = out.withColumn(f"_{kind}", F.coalesce(matches(t, pattern, i, least), _none()))
    return (out.withColumn("base", F.array_sort(F.concat(*[F.col(f"_{k}") for k in RULES])))
            .drop(*[f"_{k}" for k in RULES]))


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """(sample, random, n) of all documents: values that the rules match, and
    ordinary identifiers."""
    t = text_or_empty(text)
    found = []
    for kind, (pattern, least) in RULES.items():
        found.append(docs.where(F.regexp_like(t, F.lit(pattern)))
                     .select(F.explode(F.regexp_extract_all(t, F.lit(pattern), F.lit(1))).alias("sample"))
                     .where(F.length("sample") >= max(least, 16)).withColumn("random", F.lit(True)))
    found.append(docs.select(F.explode(F.regexp_extract_all(t, F.lit(ORDINARY), F.lit(1))).alias("sample"))
                 .where(F.length("sample") >= LEAST_SAMPLE).withColumn("random", F.lit(False)))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out.groupBy("sample", "random").agg(F.count(F.lit(1)).alias("n"))


def train(samples: DataFrame) -> list[float]:
    """The log-likelihood ratio of each pair of characters: len(ALPHABET)^2
    numbers, whatever the corpus, from transition counts of both classes."""
    rows = (samples.select("random", "n", F.explode(F.transform(
                F.sequence(F.lit(1), F.length("sample") - 1), lambda i: F.substring(F.col("sample"), i, 2))).alias("pair"))
            .groupBy("random", "pair").agg(F.sum("n").alias("n"))
            .where(F.regexp_like("pair", F.lit(r"^[A-Za-z0-9+/_=-]{2}$"))))
    a = len(ALPHABET)
    pair: dict[tuple[bool, str], int] = {(r["random"], r["pair"]): r["n"] for r in rows.collect()}
    first: dict[tuple[bool, str], int] = {}
    second: dict[tuple[bool, str], int] = {}
    total = {True: 0, False: 0}
    for (label, p), n in pair.items():
        first[label, p[0]] = first.get((label, p[0]), 0) + n
        second[label, p[1]] = second.get((label, p[1]), 0) + n
        total[label] += n

    def log_p(label: bool, x: str, y: str) -> float:
        alone = (second.get((label, y), 0) + SMOOTHING) / (total[label] + SMOOTHING * a)
        seen = (pair.get((label, x + y), 0) + BACKOFF * alone) / (first.get((label, x), 0) + BACKOFF)
        return math.log((1 - EVEN[label]) * seen + EVEN[label] / a)
    if not total[False]:
        return [0.0] * (a * a)
    return [log_p(True, x, y) - log_p(False, x, y) for x in ALPHABET for y in ALPHABET]


def ratio(value: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string of the alphabet, a character."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    # place of every ASCII code in the alphabet
    place = F.split(F.lit(",".join(str(ALPHABET.find(chr(c))) for c in range(128))), ",").cast("array<int>")
    codes = F.transform(F.sequence(F.lit(1), F.length(value)),
                        lambda i: F.element_at(place, F.ascii(F.substring(value, i, 1)) + 1))
    total = _bound(codes, lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda s, i: s + F.element_at(
        table, F.element_at(c, i) * len(ALPHABET) + F.element_at(c, i + 1) + 1)))
    return total / F.length(value)


def _clear(tokens: Column, base: Column) -> Column:
    """The tokens that touch no base span.  Both are put in one order by
    start; a token is clear if no span before it ends behind its start, and
    the next span after it begins behind its end."""
    markov, never = len(RULES), 2 ** 31 - 1

    def swept(rows: Column) -> Column:
        ends = _before(F.transform(rows, lambda x: F.when(x["kind"] == markov, 0).otherwise(x["end"])), 0, F.greatest)
        begins = F.reverse(_before(F.reverse(F.transform(
            rows, lambda x: F.when(x["kind"] == markov, never).otherwise(x["start"]))), never, F.least))
        zipped = F.arrays_zip(rows.alias("x"), ends.alias("e"), begins.alias("b"))
        return F.transform(F.filter(zipped, lambda z: (z["x"]["kind"] == markov) & (z["e"] <= z["x"]["start"])
                                    & (z["b"] >= z["x"]["end"])), lambda z: z["x"])
    return F.when((F.size(tokens) == 0) | (F.size(base) == 0), tokens).otherwise(
        _bound(F.array_sort(F.concat(base, tokens)), swept))


def find(docs: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: (start, kind, end, value) by
    start and kind.  A token counts if it has a letter and a digit, touches
    no base span, and is likelier random by LEAST_RATIO nats a character."""
    t = text_or_empty(text)
    out = find_base(docs, text)
    tokens = F.coalesce(matches(t, TOKEN, len(RULES), 20), _none())
    out = out.withColumn("_tokens", F.filter(tokens, lambda x: F.regexp_like(x["value"], F.lit("[0-9]"))
                                             & F.regexp_like(x["value"], F.lit("[A-Za-z]"))))
    likely = F.filter(_clear(F.col("_tokens"), F.col("base")), lambda x: ratio(x["value"], model) > LEAST_RATIO)
    likely = F.when(F.size("_tokens") > 0, likely).otherwise(_none())
    return out.withColumn("spans", F.array_sort(F.concat("base", likely))).drop("_tokens")


def redact(found: DataFrame, text: str = "text") -> Column:
    """The text with each run of overlapping spans replaced by REDACTED."""
    t = text_or_empty(text)

    def taken(blocks: Column, a: Column, b: Column) -> Column:
        """Code points a to b of a text in blocks."""
        first, last = F.floor(a / _CHARS).cast("int"), F.floor(b / _CHARS).cast("int")
        block = F.coalesce(F.get(blocks, first), F.lit(""))
        return F.when(first == last, F.substring(block, a % _CHARS + 1, b - a)).otherwise(F.concat(
            F.substring(block, a % _CHARS + 1, F.lit(_CHARS)),
            F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
            F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), b % _CHARS)))

    def cut(blocks: Column, spans: Column) -> Column:
        ends = F.transform(spans, lambda s: s["end"])
        rows = F.arrays_zip(_before(ends, 0, F.greatest).alias("b"), spans.alias("s"))
        # a piece stands before every span that begins behind all earlier ones
        rows = F.filter(F.transform(rows, lambda x, i: F.struct(
            x["b"].alias("a"), x["s"]["start"].alias("b"), ((x["s"]["start"] >= x["b"]) | (i == 0)).alias("own"))), lambda x: x["own"])
        pieces = F.transform(rows, lambda x: taken(blocks, x["a"], x["b"]))
        return F.concat(F.array_join(pieces, REDACTED), F.lit(REDACTED), taken(blocks, F.array_max(ends), F.length(t)))

    blocks = F.regexp_extract_all(t, F.lit(rf"(?s).{{1,{_CHARS}}}"), F.lit(0))
    return F.when(F.size("spans") == 0, F.col(text)).otherwise(
        _bound(blocks, lambda b: _bound(F.col("spans"), lambda s: cut(b, s))))


def digest(found: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, and both lists."""
    def count(i: int, kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(i, kind) for i, kind in enumerate(RULES)],
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"))


def scan_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return digest(find(docs, train(labelled_samples(docs))))


def redact_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents with their secrets replaced; ``n_chars``, if there, follows."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("text"))
    found = find(rows, train(labelled_samples(rows)))
    found = found.withColumn("_new", redact(found)).withColumn("_hit", F.size("spans") > 0)
    return found.select(*[
        F.col("_new").alias(c) if c == "text"
        else F.when(F.col("_hit"), F.length("_new").cast(docs.schema[c].dataType)).otherwise(F.col(f"_row.`{c}`")).alias(c)
        if c == "n_chars" else F.col(f"_row.`{c}`").alias(c) for c in names])
