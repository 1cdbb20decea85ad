"""A training corpus from ``documents``, stage by stage: language ID,
near-duplicates, benchmark decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns all that it keeps; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowspark.llm import decontam, langid, packing, secretscan, simhash
from flowspark.llm.common import staged, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or like no language's profile, go."""
    return langid.keep_identified(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the smallest id stays."""
    return simhash.keep_first(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontam.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; all documents stay."""
    return secretscan.redact_documents(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence."""
    return packing.pack_documents(spark, docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("pack", pack)]

# fingerprints, the trained models and the tokenizer are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
