"""License scans with DataFrame expressions only: a positional index of rare
licence words.

Words are runs of digits, ASCII letters (in lower case) and characters beyond
ASCII.  Each template is a run of words; it has a key phrase that must stand
in place, and postings: its words of the highest inverse document frequency
(counted over all documents), with their positions.  A file's licence words
are looked up in the postings; a word at place p that a template has at
position q proposes that the template begins at p - q.  The postings that
agree on a beginning are intersected by relative position, the key phrase is
verified there, and the score is the share of the template's IDF that stands
in place.

Base phrases are templates that must match whole; notices may differ in a
few words.  Defined results: null text counts as empty, no words give counts
of 0, null places, empty labels and score 0.  Columns named like the results
are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import text_or_empty

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
POSTINGS = 3        # rarest words of a template that are indexed
LEAST_SCORE = 0.8   # share of a notice's IDF that must stand in place


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]        # key phrase, part of words
    base: bool = False

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i:i + n] == self.key)


def _base(label: str, phrase: str) -> Template:
    return Template(label, tuple(phrase.split()), tuple(phrase.split()), True)


def _notice(label: str, text: str, key: str) -> Template:
    return Template(label, tuple(text.split()), tuple(key.split()))


TEMPLATES = (
    _base("cc-by", "cc by"),
    _base("gpl", "general public license"),
    _base("reserved", "all rights reserved"),
    _notice("gnu-gpl", "licensed under the gnu general public license version", "gnu general public license"),
    _notice("apache", "licensed under the apache license version", "apache license"),
    _notice("mit", "released under the mit license", "mit license"),
    _notice("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    _notice("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files", "permission is hereby granted"),
    _notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
            "redistribution and use in source and binary forms"),
    _notice("mpl", "this source code form is subject to the terms of the mozilla public license",
            "mozilla public license"),
)


def words(text: str) -> Column:
    """The words of a text, in order."""
    w = F.split(F.translate(text_or_empty(text), ascii_uppercase, ascii_lowercase), SEPARATORS)
    # only the first and last piece of a split can be empty
    skip = F.when(F.element_at(w, 1) == "", 1).otherwise(0)
    cut = F.when((F.size(w) > 1) & (F.element_at(w, -1) == ""), 1).otherwise(0)
    return F.slice(w, skip + 1, F.greatest(F.size(w) - skip - cut, F.lit(0)))


def idf(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text: str = "text") -> dict[str, float]:
    """IDF of every template word over all documents; as many numbers as the
    templates have words."""
    vocabulary = sorted({w for t in templates for w in t.words})
    there = F.array_intersect(words(text), F.array(*[F.lit(w) for w in vocabulary]))
    rows = (docs.select(F.explode(F.concat(there, F.array(F.lit("")))).alias("w"))
            .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect())
    n = {r["w"]: r["n"] for r in rows}
    return {w: math.log((n.get("", 0) + 2) / (n.get(w, 0) + 1)) for w in vocabulary}


def postings(t: Template, weights: dict[str, float]) -> list[int]:
    """Positions of a template's rarest words; of a base phrase, the rarest."""
    order = sorted(range(len(t.words)), key=lambda i: (-weights[t.words[i]], i))
    return order[:1 if t.base else POSTINGS]


def _places(t: Template, weights: dict[str, float], w: Column, hits: Column) -> Column:
    """(at, score) of every place where the template stands."""
    index = postings(t, weights)
    # each licence word that is found proposes a beginning
    begins = F.array_distinct(F.flatten(F.array(*[
        F.transform(F.filter(hits, _is(w, t.words[i])), _shift(i)) for i in index])))
    total = sum(weights[x] for x in t.words) or 1.0

    def stands(at: Column, i: int) -> Column:
        return F.coalesce((at + i >= 0) & (F.get(w, at + i) == t.words[i]), F.lit(False))

    def verified(at: Column) -> Column:
        agreed = sum((stands(at, i).cast("int") for i in index), F.lit(0))
        key = F.lit(True)
        for i in range(t.key_at, t.key_at + len(t.key)):
            key = key & stands(at, i)
        return (agreed >= min(2, len(index))) & key

    def score(at: Column) -> Column:
        return sum((stands(at, i).cast("double") * F.lit(weights[x] / total) for i, x in enumerate(t.words)), F.lit(0.0))

    found = F.transform(F.filter(begins, verified), lambda at: F.struct(
        at.alias("at"), (F.lit(1.0) if t.base else F.least(score(at), F.lit(1.0))).alias("score")))
    return F.filter(found, lambda x: x["score"] >= LEAST_SCORE)


def _is(w: Column, word: str):
    return lambda at: F.get(w, at) == word


def _shift(i: int):
    return lambda h: h - i


def scan(docs: DataFrame, weights: dict[str, float], templates: tuple[Template, ...] = TEMPLATES,
         text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``places``: (label, base, at, score) of
    every place where a template stands."""
    rare = sorted({t.words[i] for t in templates for i in postings(t, weights)})
    w = F.col("_words")
    out = docs.withColumn("_words", words(text))
    known = F.array(*[F.lit(x) for x in rare])
    hits = F.when(F.arrays_overlap(w, known), F.filter(
        F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i).isin(rare)))
    out = out.withColumn("_hits", hits)
    places = F.flatten(F.array(*[F.transform(
        _places(t, weights, w, F.col("_hits")), _labelled(t)) for t in templates]))
    none = F.array().cast("array<struct<label:string,base:boolean,at:int,score:double>>")
    return (out.withColumn("places", F.when(F.col("_hits").isNotNull(), places).otherwise(none))
            .withColumn("n_words", F.size(w).cast("long")).drop("_words", "_hits"))


def _labelled(t: Template):
    return lambda x: F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"),
                              x["at"].cast("int").alias("at"), x["score"].alias("score"))


def digest(scanned: DataFrame) -> DataFrame:
    base = F.filter("places", lambda x: x["base"])
    starts = F.transform(base, lambda x: x["at"])

    def labels(a: Column | str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))), ",")

    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels("places").alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda x: x["score"])), F.lit(0.0)).alias("score"))


def scan_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return digest(scan(docs, idf(docs)))
