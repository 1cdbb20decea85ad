"""Registered queries of the operators, with DuckDB SQL where it can say the
same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowspark.llm import (bpe, chat, decontam, divergence, fingerprint, langid, license, packing, secretscan, simhash,
                           spelling, suffixdup, toxicity)
from flowspark.llm.common import table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict_documents(spark, docs)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan_documents(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_documents(spark, table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_documents(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdup.dedup_documents(spark, table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(spark, table(spark, sf_dir, "conversations"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(spark, sf_dir)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(spark, table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_documents(spark, table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language, op2_secrets, op3_simhash, op4_licenses, op5_suffixes, op6_packing, op7_chat,
                            op8_decontamination, op9_fingerprints, op10_toxicity, op11_bpe, op12_spelling, op13_divergence)}

ORACLE: dict[str, str] = {
    "op8_decontamination": decontam.LEAKS_SQL, "op12_spelling": spelling.SPELLING_SQL, "op13_divergence": divergence.AUDIT_SQL}
