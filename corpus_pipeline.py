"""From raw documents to a training mix, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns documents with the
columns they came with. `run` writes each result as Parquet to the shared folder and reads it again, so a lost executor
costs a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.llm import decontaminate, jaccard, lines, mixing, quality
from starmart.llm.common import fresh, prepare, table
from starmart.session import materialize

NEAR = jaccard.Rule(k=5, num=80, den=100)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    prepare(spark)
    return quality.good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites stay in one place only; n_chars, where there is one, follows the text."""
    prepare(spark)
    out, removed = lines.dedup(docs), fresh(docs, "lines_removed")
    if "n_chars" in docs.columns and "text" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.drop(removed)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that five-word shingles link at a similarity of 0.8 the one with the smallest doc_id stays."""
    prepare(spark)
    return jaccard.one_of_each(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    prepare(spark)
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mixing", source_mixing),
]
# The classifier is trained, the mix is drawn: SQL cannot express them. tests/llm/test_pipeline.py holds the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
