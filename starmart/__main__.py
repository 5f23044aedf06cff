"""spark-submit entry: one run over JSON Lines deliveries."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starmart.plans import job
from starmart.sources import records


def main() -> None:
    p = argparse.ArgumentParser(prog="starmart", description="Load one delivery into the warehouse.")
    for entity in job.ENTITIES:
        p.add_argument(f"--{entity}", required=True, help="folder or file of JSON records, one per line")
    p.add_argument("--arrays", action="store_true", help="each file holds one JSON array instead")
    p.add_argument("--zones", required=True, help="root folder of the raw, processed and rejected zones")
    p.add_argument("--warehouse", required=True, help="root folder of the published tables")
    p.add_argument("--full-refresh", action="store_true", help="read all carts, not only those after the watermark")
    p.add_argument("--lookback-days", type=int, default=job.Settings.lookback_days)
    p.add_argument("--max-reject-ratio", type=float, default=job.Settings.max_reject_ratio)
    p.add_argument("--keep-going", action="store_true", help="load even if a check fails")
    p.add_argument("--csv", action="store_true", help="write the processed zone as CSV")
    a = p.parse_args()
    spark = SparkSession.builder.appName("starmart").getOrCreate()
    read = records.read_json_arrays if a.arrays else records.read_json_lines
    settings = job.Settings(
        zones_root=a.zones, warehouse_root=a.warehouse, lookback_days=a.lookback_days, max_reject_ratio=a.max_reject_ratio,
        fail_on_quality_error=not a.keep_going, processed_form="csv" if a.csv else "parquet",
    )
    outcome = job.run(spark, settings, {e: read(spark, getattr(a, e)) for e in job.ENTITIES}, full_refresh=a.full_refresh or None)
    print(outcome)


if __name__ == "__main__":
    main()
