"""The queries of this folder: each applies one operator, with production settings, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import chunks, covertree, decontaminate, extract, jaccard, licenses, lines, mixing, quality, repair, spelling, toxicity, urlfilter
from starmart.llm.common import table
from starmart.llm.oracles import ORACLES  # noqa: F401


def op1_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.report(table(spark, d, "documents"), jaccard.Rule(k=3, num=90, den=100))


def op2_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.report(table(spark, d, "documents"))


def op3_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return lines.report(table(spark, d, "documents"))


def op4_embedding_neardup(spark: SparkSession, d: str) -> DataFrame:
    return covertree.report(table(spark, d, "embeddings"))


def op5_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.report(table(spark, d, "documents"), table(spark, d, "labels"))


def op6_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.report(table(spark, d, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.report(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op8_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return urlfilter.judge(table(spark, d, "pages"))


def op9_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return chunks.report(table(spark, d, "documents"))


def op10_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.report(table(spark, d, "documents"), table(spark, d, "labels"))


def op11_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    return repair.report(table(spark, d, "conversations"))


def op12_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling.report(table(spark, d, "documents"))


def op13_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return extract.extract(table(spark, d, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_license_scan, op3_line_dedup, op4_embedding_neardup, op5_quality, op6_source_mixing, op7_benchmark_decontamination, op8_url_filter, op9_substring_dedup, op10_toxicity,
    op11_conversation_repair, op12_spelling_variants, op13_html_extraction)}

