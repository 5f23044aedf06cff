"""What the operators of this folder share: tables, row keys, batch settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.session import configure

# Arrow batches for Python workers: few rows, and a bound on bytes for tables with very long texts.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def text_key(text: Column) -> Column:
    """Together with doc_id this names a document's content: 128 bits, null apart from empty."""
    return F.when(text.isNull(), F.lit("")).otherwise(F.md5(text))


def fold_case(text: Column) -> Column:
    """A-Z to a-z, nothing else; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_text(rows: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and further columns of a few chosen documents: of several texts of one id always the same one."""
    first = F.min(F.struct(F.xxhash64("text").alias("order"), "text", *more))
    return rows.groupBy("doc_id").agg(first.alias("first")).select("doc_id", "first.text", *[f"first.{c}" for c in more])
