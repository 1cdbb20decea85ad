"""Toxicity by class-conditional Kneser-Ney models of words.

Both classes have a character model of words: the probability of the next
character given up to ``ORDER - 1`` before it in the word, by absolute
discounting.  The discounted mass backs off to one model that both classes
share: the pooled counts, which in turn back off to continuation counts (in
how many contexts a character has been seen).  So an expression that a class
has seen in a few documents only gets the shared probability from both, and
its ratio is that of the backed-off mass.

A count is the number of training documents of the class that hold the word,
so one long or repetitive document counts once.  A document's evidence is
the sum, over its distinct words, of the log-likelihood ratio beyond
``MARGIN``, normalised by the logarithm of the number of words.  A logistic
curve turns evidence into a probability; it is fitted on training documents
scored by a model of the other half of the training documents.

In a context seen in no more toxic documents than ``DISCOUNT``, all toxic mass
is discounted, so the toxic class has only shared mass, and the ratio there is
taken as one.  This holds for any number of documents; no other context is
left out.

The models (of all training documents and of each half) are one written table
of weights by string.  A word's ratio is the sum of its strings' weights, by a
join of the distinct words' strings with that table; a document's evidence is
the sum over its words, by a join with the words beyond the margin.  A side of
a join is broadcast up to a fixed, counted number of rows, and shuffled beyond
it.  Weights are whole multiples of 1 / ``UNIT``, so no sum hangs on its order.

Defined results: null or empty text has evidence 0; with training rows of one
class or none every score is the share of toxic training documents (0 if
there are none).  A document with several labels counts as toxic if one says
so; rows without a label do not train.  Columns named like the results are
replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import id_crc, small_side, staged, text_or_empty

ORDER = 10
DISCOUNT = 2.5          # of the classes
SHARED_DISCOUNT = 0.75  # of the pooled counts
MARGIN = 2.0            # nats of a word that count as chance
UNIT = float(1 << 30)   # weights are whole multiples of its inverse
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
_WORD = re.compile(r"[^\W\d_]+")
_BEGIN, _END = "\x02", "\x03"
_FLUSH = 500_000
_SALTS = 1024


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def fold(doc_id: str = "doc_id") -> Column:
    return (id_crc(doc_id) % FOLDS).cast("int")


def held_out() -> Column:
    return F.coalesce(fold() == HELD_OUT, F.lit(False))


def labelled(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, half, toxic) of all documents; half and toxic are null
    where a document does not train.  Labels are broadcast up to a checked
    number, else joined by shuffle."""
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(~held_out())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_toxic")))
    marks = small_side(staged(spark, marks, "marks"))
    trains = F.col("_toxic").isNotNull() & F.col("text").isNotNull()
    return (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(marks, "doc_id", "left")
            .select("doc_id", text_or_empty("text").alias("text"),
                    F.when(trains, F.when(fold() == 0, 0).otherwise(1)).alias("half"),
                    F.when(trains, (F.col("_toxic") > 0).cast("int")).alias("toxic")))


# columns of counts: half 0 ordinary, half 0 toxic, half 1 ordinary, half 1 toxic
_COUNTS = ["n0", "n1", "n2", "n3"]
_UNTRAINED = len(_COUNTS)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, Counter] = {k: Counter() for k in range(_UNTRAINED)}
    seen: set[str] = set()      # words of documents that do not train

    def emit() -> Iterator[pa.RecordBatch]:
        held[_UNTRAINED] = dict.fromkeys(seen, 0)
        for k, c in held.items():
            if c:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(c), pa.int32()), pa.array(list(c)), pa.array(list(c.values()), pa.int64())],
                    ["k", "word", "n"])
            c.clear()
        seen.clear()

    for batch in batches:
        for text, half, toxic in zip(batch.column("text"), batch.column("half").to_pylist(), batch.column("toxic").to_pylist()):
            words = words_of(text.as_py())
            if half is None:
                seen |= words
            else:
                own = held[2 * half + toxic]
                own.update(words)
                own[""] += 1    # the number of documents
        if len(seen) + sum(map(len, held.values())) > _FLUSH:
            yield from emit()
    yield from emit()


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n0..n3): in how many training documents of each half and class,
    for every word of any document; the empty word counts the documents."""
    return (rows.select("text", "half", "toxic").mapInArrow(_count_words, "k int, word string, n long").groupBy("word")
            .agg(*[F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(_COUNTS)]))


def gram_counts(words: DataFrame) -> DataFrame:
    """(context, next, n0..n3) of every character of every word."""
    w = F.concat(F.lit(_BEGIN), F.col("word"), F.lit(_END))
    grams = F.transform(F.sequence(F.lit(2), F.length(w)), lambda i: F.struct(
        F.substring(w, F.greatest(i - (ORDER - 1), F.lit(1)), F.least(i - 1, F.lit(ORDER - 1))).alias("context"),
        F.substring(w, i, F.lit(1)).alias("next")))
    return (words.where("word <> '' AND n0 + n1 + n2 + n3 > 0").select(F.explode(grams).alias("g"), *_COUNTS)
            .groupBy("g.context", "g.next").agg(*[F.sum(c).alias(c) for c in _COUNTS]))


# (ordinary, toxic) columns of counts of the models: of half 1, which scores
# the documents of half 0; of half 0, which scores those of half 1; of both
MODELS = ((["n2"], ["n3"]), (["n0"], ["n1"]), (["n0", "n2"], ["n1", "n3"]))
_FULL = 2
_W = [f"w{m}" for m in range(len(MODELS))]
_E = [f"e{m}" for m in range(len(MODELS))]


def weights(grams: DataFrame) -> DataFrame:
    """(key, w0..w2): by hash of a string, what it adds to the log-likelihood
    ratio of a word under each model.  A context adds the ratio of the
    backed-off mass, a seen gram the difference of its own ratio to that."""
    models = range(len(MODELS))
    g = grams.select("context", "next", *[sum(F.col(c) for c in columns).alias(f"{side}{m}")
                                          for m, sides in enumerate(MODELS) for side, columns in zip("ot", sides)])
    seen = [F.col(f"o{m}") + F.col(f"t{m}") > 0 for m in models]
    # continuation counts: in how many contexts a character stands
    cont = g.groupBy("next").agg(*[F.count_if(seen[m]).alias(f"_types{m}") for m in models])
    n_types = g.agg(*[F.count_if(seen[m]) for m in models]).first()
    total = (g.groupBy("context").agg(*[c for m in models for c in (
        F.sum(f"o{m}").alias(f"_o{m}"), F.sum(f"t{m}").alias(f"_t{m}"), F.count_if(seen[m]).alias(f"_k{m}"),
        F.sum(F.least(f"o{m}", F.lit(DISCOUNT))).alias(f"_mo{m}"), F.sum(F.least(f"t{m}", F.lit(DISCOUNT))).alias(f"_mt{m}"))])
        .where(F.greatest(*[f"_t{m}" for m in models]) > DISCOUNT))

    def fixed(m: int, x: Column, where: Column) -> Column:
        return F.when(where, F.round(x * UNIT).cast("long")).otherwise(0).alias(_W[m])

    def back(m: int) -> Column:
        o, t, mo, mt = (F.col(f"{c}{m}") for c in ("_o", "_t", "_mo", "_mt"))
        return F.log((mt / t) / F.when(o > 0, mo / o).otherwise(1.0))

    def ratio(m: int) -> Column:
        o, t, tot_o, tot_t = (F.col(f"{c}{m}") for c in ("o", "t", "_o", "_t"))
        shared = ((F.greatest(o + t - SHARED_DISCOUNT, F.lit(0.0))
                   + SHARED_DISCOUNT * F.col(f"_k{m}") * F.col(f"_types{m}") / F.lit(float(max(n_types[m], 1)))) / (tot_o + tot_t))

        def p(n: Column, tot: Column, mass: str) -> Column:
            return F.when(tot > 0, (F.greatest(n - DISCOUNT, F.lit(0.0)) + F.col(mass) * shared) / tot).otherwise(shared)

        return F.log(p(t, tot_t, f"_mt{m}") / p(o, tot_o, f"_mo{m}"))

    used = [F.col(f"_t{m}") > DISCOUNT for m in models]
    own = (g.join(total, "context").join(cont, "next")
           .select(F.xxhash64(F.concat("context", "next")).alias("key"), *[fixed(m, ratio(m) - back(m), used[m] & seen[m]) for m in models]))
    contexts = total.select(F.xxhash64("context").alias("key"), *[fixed(m, back(m), used[m]) for m in models])
    return (own.unionByName(contexts).groupBy("key").agg(*[F.sum(w).alias(w) for w in _W])
            .where(" OR ".join(f"{w} <> 0" for w in _W)))


def _hash(s: str) -> int:
    """As Spark's xxhash64 of a string."""
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), 42)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, key): hashes of each word and of the contexts and grams in it."""
    for batch in batches:
        words, keys, size = [], [], []

        def rows() -> pa.RecordBatch:
            word = np.repeat(np.array(words, np.uint64), size)
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(np.array(keys, np.uint64).view(np.int64))], ["word", "key"])

        for w in batch.column(0).to_pylist():
            s, n = _BEGIN + w + _END, len(keys)
            # up to ORDER characters a context is the gram before
            keys += [_hash(s[:i]) for i in range(1, min(len(s), ORDER) + 1)]
            for i in range(ORDER, len(s)):
                keys += (_hash(s[i - ORDER + 1:i]), _hash(s[i - ORDER + 1:i + 1]))
            words.append(_hash(w))
            size.append(len(keys) - n)
            if len(keys) > 200_000:
                yield rows()
                words, keys, size = [], [], []
        if words:
            yield rows()


def word_ratios(words: DataFrame, weights: DataFrame) -> DataFrame:
    """(word, w0..w2): log-likelihood ratios, by hash, of the words with a
    ratio other than one."""
    strings = words.where("word <> ''").select("word").mapInArrow(_strings, "word long, key long")
    return strings.join(small_side(weights), "key").groupBy("word").agg(*[F.sum(w).alias(w) for w in _W])


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [list(words_of(text.as_py())) for text in batch.column("text")]
        size = np.fromiter(map(len, words), np.int32, len(words))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()),
                                         pa.array([w for own in words for w in own], pa.string()))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "half", "toxic", "h")), lists],
                                         ["doc_id", "half", "toxic", "h", "words"])


def evidence(rows: DataFrame, ratios: DataFrame, spark: SparkSession) -> DataFrame:
    """(doc_id, half, toxic, copies, e0..e2): evidence under each model, a row
    for each id and text and the number of rows that are alike."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    beyond = [F.greatest(F.col(w) - int(MARGIN * UNIT), F.lit(0)).alias(w) for w in _W]
    # of each document one word without weight finds a partner, so that none is lost
    mark = F.concat(F.lit("\0"), F.pmod("h", F.lit(_SALTS)).cast("string"))
    marks = spark.range(_SALTS).select(F.xxhash64(F.concat(F.lit("\0"), F.col("id").cast("string"))).alias("word"),
                                       *[F.lit(0).cast("long").alias(w) for w in _W], F.lit(1).alias("_row"))
    side = staged(spark, ratios.select("word", *beyond, F.lit(0).alias("_row")).where(F.greatest(*_W) > 0).unionByName(marks), "ratios")
    pairs = (rows.select("doc_id", "text", "half", "toxic", F.xxhash64("text").alias("h"))
             .mapInArrow(_document_words, f"doc_id {id_type}, half int, toxic int, h long, words array<string>")
             .select("doc_id", "half", "toxic", "h", F.size("words").alias("n"), F.explode(F.concat("words", F.array(mark))).alias("w"))
             .withColumn("word", F.xxhash64("w")).drop("w"))
    return (pairs.join(small_side(side), "word").groupBy("doc_id", "half", "toxic", "h", "n")
            .agg(F.sum("_row").alias("copies"), *[F.sum(w).alias(w) for w in _W])
            .select("doc_id", "half", "toxic", "copies",
                    *[(F.col(w) / F.col("copies") / UNIT / F.log(F.lit(2.0) + F.col("n"))).alias(e) for w, e in zip(_W, _E)]))


def _fit_curve(bins: pd.DataFrame) -> tuple[float, float]:
    """Logistic curve over (x, toxic, n) by Newton steps, slightly damped."""
    x, y, n = (bins[c].to_numpy(float) for c in ("x", "toxic", "n"))
    share = (y * n).sum() / n.sum()
    if share in (0.0, 1.0):
        return 0.0, 40.0 if share else -40.0
    a, b = np.column_stack([np.ones_like(x), x]), np.array([math.log(share / (1 - share)), 0.0])
    damp = np.diag([0.0, 0.01])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (n * q * (1 - q))[:, None]) + damp + 1e-9 * np.eye(2), a.T @ (n * (y - q)) - damp @ b)
        b = b + step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return float(max(b[1], 0.0)), float(b[0])


def curve(found: DataFrame, n: list[int]) -> tuple[float, float]:
    """Slope and intercept, from training documents under the other half's
    model; ``n`` are the numbers of training documents."""
    if not sum(n):
        return 0.0, -40.0
    own = F.when(F.col("half") == 0, F.col(_E[0])).otherwise(F.col(_E[1]))
    table = (found.where("half IS NOT NULL").groupBy((F.round(F.log1p(own) * 50) / 50).alias("x"), "toxic")
             .agg(F.sum("copies").alias("n")).toPandas().sort_values(["x", "toxic"]))
    slope, intercept = _fit_curve(table)
    toxic = n[1] + n[3]
    if slope == 0.0 and 0 < toxic < sum(n):
        intercept = math.log(toxic / (n[0] + n[2]))
    return slope, intercept


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = labelled(spark, docs, labels)
    words = staged(spark, word_counts(rows), "words")
    counts = words.where("word = ''").first()
    grams = staged(spark, gram_counts(words), "grams")
    ratios = word_ratios(words, staged(spark, weights(grams), "weights"))
    found = staged(spark, evidence(rows, ratios, spark), "evidence")
    slope, intercept = curve(found, [counts[c] for c in _COUNTS] if counts else [0] * len(_COUNTS))
    x = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), intercept + slope * F.log1p(_E[_FULL])))
    return (found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .withColumn("score", 1.0 / (1.0 + F.exp(-x)))
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
