"""Language identification with rank-order n-gram profiles.

A profile is a language's ``top`` most frequent letter n-grams, in order of
frequency.  A document is compared to each profile by the out-of-place
distance: the sum, over the document's own most frequent n-grams, of how far
apart the two ranks are, where an n-gram that the profile lacks costs
``top``.  The nearest profile wins.

Defined results: null text or text without a letter gives ``und`` and score
0; a tie goes to the language first in order; with no training rows every
document is ``und``.  Columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowspark.llm.common import id_crc, slices

UNKNOWN = "und"
TOP = 300          # n-grams in a profile, and in a document's own ranking
ORDERS = (1, 2, 3)
HELD_OUT_FOLDS = 5
MIN_SCORE = 0.02   # a document below this shares next to nothing with any profile
_SPACE = 1         # code of a run of characters that are no letters
_WHITE = re.compile(r"\s")
_GATHER = 500_000   # codes of a language that are counted at once
_FLUSH = 2_000_000  # codes and n-grams that a task holds before it emits them

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def _symbols(text: str) -> np.ndarray:
    """Letters in lower case, any other character a space."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letter_table()[a], a, np.uint32(_SPACE)).astype(np.uint64)


def gram_codes(text: str) -> Iterator[np.ndarray]:
    """The n-grams of a text as integers of 21 bits a character, slice by
    slice: letters in lower case, each run of other characters as one space,
    a space at both ends.  None if there is no letter."""
    before = np.array([_SPACE], np.uint64)      # the last symbols of the slice before
    for part in (*slices(text, _WHITE), ""):
        a = np.concatenate([before, _symbols(part) if part else np.array([_SPACE], np.uint64)])
        a = a[np.concatenate([[True], (a[1:] != _SPACE) | (a[:-1] != _SPACE)])]
        new = len(a) - len(before)
        if new > 0:
            own = a[len(before):]
            out, gram = [own[own != _SPACE]], a
            for n in ORDERS[1:]:
                if len(a) < n:
                    break
                gram = (gram[:-1] << np.uint64(21)) | a[n - 1:]
                out.append(gram[-new:] if len(gram) > new else gram)
            yield np.concatenate(out)
        before = a[-(ORDERS[-1] - 1):]


def top_codes(text: str, top: int) -> np.ndarray:
    """The ``top`` most frequent n-grams of a text, ties by code."""
    parts = list(islice(codes := gram_codes(text), 2))
    if len(parts) < 2 or len(text) <= _GATHER:
        return ranked(np.concatenate([*parts, *codes]) if parts else np.empty(0, np.uint64), top)
    counts = _Counts()
    for c in chain(parts, codes):
        counts.add(c)
    counts.count()
    return counts.grams[np.argsort(-counts.n, kind="stable")[:top]]


def ranked(codes: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent codes, ties by code."""
    u, n = np.unique(codes, return_counts=True)
    return u[np.argsort(-n, kind="stable")[:top]]


class _Counts:
    """Counts of n-grams; codes are counted whenever enough have gathered."""

    def __init__(self):
        self.grams, self.n = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.waiting, self.size = [], 0

    def add(self, codes: np.ndarray) -> None:
        self.waiting.append(codes)
        self.size += len(codes)
        if self.size > _GATHER:
            self.count()

    def count(self) -> None:
        if self.waiting:
            u, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            both, at = np.unique(np.concatenate([self.grams, u]), return_inverse=True)
            self.n = np.bincount(at, np.concatenate([self.n, n]), len(both)).astype(np.int64)
            self.grams, self.waiting, self.size = both, [], 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, _Counts] = defaultdict(_Counts)

    def emit() -> Iterator[pa.RecordBatch]:
        for lang, c in held.items():
            c.count()
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(c.n)), pa.array(c.grams.view(np.int64)), pa.array(c.n)], ["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            for codes in gram_codes(text.as_py()):
                held[lang].add(codes)
            if sum(len(c.n) + c.size for c in held.values()) > _FLUSH:
                yield from emit()
    yield from emit()


def learn_profiles(docs: DataFrame, top: int = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, rank): the profile of every language, counted over every
    row that has a text and a language.  Tasks count before the shuffle; the
    top of a language is taken in 64 shares first, then among the shares'
    winners, so no task sees all n-grams of a language."""
    counts = (docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
              .select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
              .mapInArrow(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = [F.col("n").desc(), F.col("gram")]
    return (counts.withColumn("share", F.pmod(F.xxhash64("gram"), F.lit(64)))
            .withColumn("r", F.row_number().over(W.partitionBy("lang", "share").orderBy(*order)))
            .where(F.col("r") <= top)
            .withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
            .where(F.col("r") <= top)
            .select("lang", "gram", (F.col("r") - 1).alias("rank")))


class Profiles:
    """Profiles as one sorted array of n-grams and a rank for each language.
    At most ``top`` rows a language: its size follows the number of
    languages, never that of the documents."""

    def __init__(self, rows: pd.DataFrame, top: int):
        self.top = top
        self.langs = sorted(rows["lang"].unique())
        self.grams = np.unique(rows["gram"].to_numpy(np.int64).view(np.uint64))
        self.ranks = np.full((len(self.grams), len(self.langs)), -1, np.int64)
        at = np.searchsorted(self.grams, rows["gram"].to_numpy(np.int64).view(np.uint64))
        self.ranks[at, rows["lang"].map({x: i for i, x in enumerate(self.langs)}).to_numpy(np.int64)] = rows["rank"]

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The nearest language and 1 - distance / the largest distance."""
        own = top_codes(text, self.top) if text else ()
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        r = np.where((self.grams[at] == own)[:, None], self.ranks[at], -1)
        d = np.where(r < 0, self.top, np.abs(r - np.arange(len(own))[:, None])).sum(0)
        best = int(d.argmin())
        return self.langs[best], 1.0 - float(d[best]) / (self.top * len(own))


def _found(spark: SparkSession, docs: DataFrame, profiles: DataFrame, top: int, text: str) -> DataFrame:
    model = spark.sparkContext.broadcast(Profiles(profiles.toPandas(), top))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.value.nearest(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn("_found", predict(F.col(text).cast("string")))


def identify(spark: SparkSession, docs: DataFrame, profiles: DataFrame, top: int = TOP,
             text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone."""
    found = _found(spark, docs, profiles, top, text)
    return (found.withColumn("lang_pred", F.col("_found.lang_pred"))
            .withColumn("score", F.col("_found.score")).drop("_found"))


def held_out() -> Column:
    return F.coalesce(id_crc("doc_id") % HELD_OUT_FOLDS == 0, F.lit(False))


def predict_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Profiles from the rows that are not held out, applied to every row."""
    return identify(spark, docs, learn_profiles(docs.where(~held_out())))


def keep_identified(spark: SparkSession, docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents in a language that some profile knows, with their columns."""
    found = _found(spark, docs, learn_profiles(docs.where(~held_out())), TOP, "text")
    return found.where((F.col("_found.lang_pred") != UNKNOWN) & (F.col("_found.score") >= min_score)).drop("_found")
