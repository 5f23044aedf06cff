"""Published tables: data folders per run, and numbered manifests that name the current ones.

A manifest is never changed or replaced. Publishing writes the next number, which only one writer can: the file is
complete before a rename, which fails if the number is taken, gives it its name. Readers take the highest
number once and then read plain Parquet. A run that fails leaves folders nobody refers to.
"""

from __future__ import annotations

import copy
import json
import uuid
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.operators.position import with_position
from starmart.schemas import STATES, TABLES, conform, empty

LOGS = ["etl_run_audit", "data_quality_results"]
# Tables kept in buckets of their natural key; a run writes the buckets it changes. The fact is kept by month, the rest as a whole.
BUCKETED = {"dim_customer": "customer_id", "dim_product": "product_id"}
BUCKETS = 64


EMPTY = {"version": 0, "run_id": None, "tables": {}, "buckets": {}, "months": {}, "states": {}, "repeated_keys": 0, "last_keys": {}, "watermarks": {}}


class PublishConflict(RuntimeError):
    pass


class ManifestLost(RuntimeError):
    pass


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        p = self._path(path)
        return p.getFileSystem(self._conf).exists(p)

    # ---- manifest

    def manifest(self) -> dict:
        """run_id; folders of whole tables, of buckets and of fact months; each month's state; last keys; watermarks. Empty at first."""
        folder = self._path(f"{self.root}/manifests")
        files = folder.getFileSystem(self._conf).globStatus(self._path(f"{self.root}/manifests/*.json"))
        names = sorted(f.getPath().getName() for f in files or [])
        if names:
            return {**EMPTY, **json.loads(self.spark.read.text(f"{self.root}/manifests/{names[-1]}", wholetext=True).first()[0])}
        if self.exists(f"{self.root}/data"):
            raise ManifestLost(f"{self.root} holds data, but no manifest says which of it is current")
        return copy.deepcopy(EMPTY)

    def begin(self) -> dict:
        """The current manifest; an empty warehouse gets its first one before any data is written."""
        current = self.manifest()
        if current["version"]:
            return current
        try:
            self.publish(current)
        except PublishConflict:   # another writer was first
            pass
        return self.manifest()

    def publish(self, manifest: dict) -> None:
        """Makes the manifest, which was made from the current one, the next one; fails if there is a next one already."""
        version = manifest["version"] + 1
        name = f"{self.root}/manifests/{version:010d}.json"
        temp, final = self._path(f"{name}.{uuid.uuid4().hex}"), self._path(name)
        store = temp.getFileSystem(self._conf)
        out = store.create(temp, False)
        out.write(bytearray(json.dumps(manifest | {"version": version}, indent=1).encode()))
        out.close()
        fs = self._jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
        options[0] = fs.Options.Rename.NONE
        try:
            fs.FileContext.getFileContext(final.toUri(), self._conf).rename(temp, final, options)
        except Py4JJavaError as e:
            store.delete(temp, False)
            if "FileAlreadyExistsException" in str(e.java_exception.getClass()):
                raise PublishConflict(f"version {version} has been published by another run") from None
            raise

    # ---- reading

    def tables(self, manifest: dict | None = None) -> dict[str, DataFrame]:
        m = manifest or self.manifest()
        return {name: self.table(name, m) for name in TABLES}

    def table(self, name: str, m: dict) -> DataFrame:
        if name == "etl_run_audit":
            return self.runs()
        if name in LOGS:
            return self._log(name)
        if name == "fact_sales":
            return self.parts(name, m["months"])
        parts = m["buckets"].get(name)
        return self.parts(name, parts) if parts else self._whole(name, m["tables"].get(name))

    def state(self, manifest: dict, name: str) -> DataFrame | None:
        path = manifest["tables"].get(name)
        return self.spark.read.schema(STATES[name]).parquet(path) if path else None

    def _whole(self, name: str, path: str | None) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(path) if path else empty(self.spark, TABLES[name])

    def parts(self, name: str, folders: dict[str, str]) -> DataFrame:
        """Folders of several runs under one base path; what is not among them is not opened."""
        schema = TABLES[name]
        if not folders:
            return empty(self.spark, schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data/{name}").parquet(*sorted(folders.values()))
        return rows.select(schema.names)

    # ---- writing

    def write_whole(self, df: DataFrame, name: str, run_id: str) -> str:
        path = f"{self.root}/data/{name}/run={run_id}"
        conform(df, (TABLES | STATES)[name]).write.parquet(path)
        return path

    def write_buckets(self, df: DataFrame, name: str, run_id: str) -> dict[str, str]:
        path = f"{self.root}/data/{name}/run={run_id}"
        rows = df.select(*TABLES[name].names, bucket(name).alias("bucket"))
        rows.repartition("bucket").write.partitionBy("bucket").parquet(path)
        return {str(b): f"{path}/bucket={b}" for b in range(BUCKETS) if self.exists(f"{path}/bucket={b}")}

    def write_fact(self, df: DataFrame, run_id: str, months: list[int], arrange: bool = True) -> dict[str, str]:
        """Ranges by month and key: a large month spreads over many tasks, and file statistics stay tight."""
        path = f"{self.root}/data/fact_sales/run={run_id}"
        order = ["month", "cart_id", "product_key"]
        rows = df.select(TABLES["fact_sales"].names)
        if arrange:
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        rows.write.partitionBy("month").parquet(path)
        return {str(m): f"{path}/month={m}" for m in months if self.exists(f"{path}/month={m}")}

    # ---- run audit and check results, kept apart so that failed runs are recorded too

    def _log(self, name: str) -> DataFrame:
        path = f"{self.root}/log/{name}"
        return self.spark.read.schema(TABLES[name]).parquet(path) if self.exists(path) else empty(self.spark, TABLES[name])

    def append(self, name: str, rows: list[tuple]) -> None:
        if rows:
            self.spark.createDataFrame(rows, TABLES[name]).coalesce(1).write.mode("append").parquet(f"{self.root}/log/{name}")

    def runs(self) -> DataFrame:
        """The latest state of each run."""
        states = self._log("etl_run_audit")
        latest = F.max_by(F.struct(*states.columns), F.coalesce("finished_at", F.lit(0).cast("timestamp")))
        return states.groupBy("run_id").agg(latest.alias("r")).select("r.*")

    def watermarks(self) -> DataFrame:
        """entity, watermark_value, run_id, updated_at: one row per entity."""
        rows = [(e, date.fromisoformat(w["value"]), w["run_id"], datetime.fromisoformat(w["updated_at"]))
                for e, w in self.manifest()["watermarks"].items()]
        return self.spark.createDataFrame(rows, "entity STRING, watermark_value DATE, run_id STRING, updated_at TIMESTAMP")

    def watermark(self, entity: str = "fact_sales") -> str | None:
        return self.manifest()["watermarks"].get(entity, {}).get("value")


def bucket(name: str) -> Column:
    return F.pmod(F.xxhash64(BUCKETED[name]), F.lit(BUCKETS)).cast("int")


def assign_keys(fresh: DataFrame, natural: list[str], key: str, last: int) -> DataFrame:
    """Surrogate keys after the last one given out, in natural-key order."""
    numbered = with_position(fresh, [F.col(c) for c in natural], key)
    return numbered.withColumn(key, F.col(key) + last)
