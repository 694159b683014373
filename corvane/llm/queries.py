"""The queries opN_<name>: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import decontaminate, html_text, language, lz_fingerprint, mixing, packing, secrets, token_counts, url_filter
from corvane.llm.common import table
from corvane.llm.near_dup import near_duplicates


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.report(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(table(spark, sf_dir, "pages"))


def op4_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.report(table(spark, sf_dir, "documents"))


def op5_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.report(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_decontamination, op3_html_extraction, op4_lz_fingerprints, op5_token_packing, op6_secret_scan, op7_language_id, op8_minhash_near_dedup, op9_url_filter, op10_mixing)}
ORACLE = {"op2_decontamination": decontaminate.ORACLE, "op10_mixing": mixing.ORACLE}
