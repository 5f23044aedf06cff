"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores.
Loading the star and validating the delivery are timed once, cold; a query is the median of three
runs after one warm-up, results fetched.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from checkbook import mapping, registry
from starmart.operators import validate
from starmart.session import configure

RUNS = 3
ONCE = {
    "deliveries": mapping.deliveries,
    "validate_all": lambda spark, d: validate.validate_all(mapping.deliveries(spark, d)),
    "load_star": mapping.published,
    "end_to_end_load": mapping.full_run,
}
REPEATED = [n for n in registry.QUERIES if n.startswith(("q0", "q1", "agg_")) and n != "q15_run_health"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]").appName("starmart-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name, build in ONCE.items():
        start = time.perf_counter()
        build(spark, sf_dir)
        times[name] = round(time.perf_counter() - start, 3)
    queries = registry.queries()
    for name in REPEATED:
        taken = []
        for i in range(RUNS + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).collect()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    total = round(sum(times[n] for n in REPEATED), 3)
    print(json.dumps({"metric": "analytics and aggregate queries, total", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
