"""The registered queries of the training-data operators.

Each applies its operator, with its production parameters, to the whole of
its table.  ``ORACLES`` holds DuckDB SQL where SQL can say the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, hard_negatives, html_extract, line_dedup, minhash, mixing, pii, quality, simhash, spelling, substring_dedup, suffix_dedup, url_filter
from .common import read_table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(read_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.digest(read_table(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(read_table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(read_table(spark, sf_dir, "pages"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(read_table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.digest(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(read_table(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(read_table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_mixing, op3_quality_rules, op4_line_dedup, op5_html_extraction, op6_substring_dedup, op7_pii,
                              op8_url_filter, op9_suffix_dedup, op10_minhash, op11_hard_negatives, op12_spelling, op13_simhash)
}

ORACLES: dict[str, str] = {
    "op3_quality_rules": quality.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
}
