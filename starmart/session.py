"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# Settings the results or the plans rely on; all can be changed at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # overflow and bad casts fail instead of becoming null or wrapping
    "spark.sql.ansi.enabled": "true",
    # what runs write for themselves and for readers takes little more time than by Spark's default, and some two fifths less space
    "spark.sql.parquet.compression.codec": "zstd",
    "parquet.compression.codec.zstd.level": "1",
    # the JVM does not compile methods of more bytes: such stages run as several smaller projections
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # the folders of a table's months or buckets are listed without a job of their own
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "200",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder shared by all executors, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    root = tempfile.mkdtemp(prefix="starmart-")
    spark.sparkContext.setCheckpointDir(root)
    return root


_SCOPE = "starmart.scratch.scope"   # session setting, so that all threads of a session see it


def _scratch_folder(spark: SparkSession) -> str:
    scope = spark.conf.get(_SCOPE, "session")
    return f"{scratch_root(spark)}/starmart/{spark.sparkContext.applicationId}/{scope}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession, name: str):
    """What is materialized inside goes away at the end, also after a failure."""
    outer = spark.conf.get(_SCOPE, None)
    spark.conf.set(_SCOPE, f"{name}-{uuid.uuid4().hex[:6]}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    try:
        yield
    finally:
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        spark.conf.unset(_SCOPE) if outer is None else spark.conf.set(_SCOPE, outer)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several later jobs read, and read it back.

    A written table survives the loss of executors, is column-pruned by its readers, and
    has a known size, so the planner only broadcasts it when it is really small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The frame, and its row count once an action over it has run; counting costs no pass of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), lambda: int(seen.get.get("n") or 0)


def together(*work: Callable[[], object]) -> list:
    """Runs independent Spark jobs side by side, so that small ones do not queue behind large ones."""
    same_tags = inheritable_thread_target(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate())
    with ThreadPoolExecutor(len(work)) as pool:
        return [f.result() for f in [pool.submit(same_tags(w)) for w in work]]
