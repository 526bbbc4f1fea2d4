"""Registered queries of the text operators, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontam, filteraudit, langid, mixing, multisethash, neardup, pii, quality, secrets, styletree, token_files, vecdup, whitening
from .common import table


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.token_report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return styletree.main_texts(table(spark, sf_dir, "pages"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multisethash.fingerprint_report(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_report(table(spark, sf_dir, "documents"), words=4)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vecdup.near_vectors(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_main_text": op2_main_text,
    "op3_pii": op3_pii,
    "op4_mixing": op4_mixing,
    "op5_fingerprints": op5_fingerprints,
    "op6_quality": op6_quality,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_language": op8_language,
    "op9_token_files": op9_token_files,
    "op10_secrets": op10_secrets,
    "op11_filter_audit": op11_filter_audit,
    "op12_whitening": op12_whitening,
    "op13_near_vectors": op13_near_vectors,
    "pipeline": pipeline,
}
SQL: dict[str, str] = {"op1_decontaminate": decontam.ORACLE, "op7_near_duplicates": neardup.ORACLE, "op11_filter_audit": filteraudit.ORACLE}
