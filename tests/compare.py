"""Runs registered queries against their DuckDB answers: python tests/compare.py [sf_dir] [name..]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(v):
    return (v is None, str(type(v)), v if v is not None else 0)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple(_key(v) for v in r)), [columns[i] for i in order]


def compare(spark, con, sf_dir, name, query, sql) -> str | None:
    df = query(spark, sf_dir)
    got, columns = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    want, expected = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if columns != expected:
        return f"columns {columns} <> {expected}"
    if len(got) != len(want):
        return f"{len(got)} rows <> {len(want)}; extra {set(got) - set(want) and list(set(got) - set(want))[:2]}, missing {list(set(want) - set(got))[:2]}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} <> {b}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    duck, oracle = connect(sf), entry.oracle_sql()
    wrong = 0
    for n, q in entry.queries().items():
        if len(sys.argv) > 2 and n not in sys.argv[2:]:
            continue
        t = time.time()
        try:
            problem = compare(session, duck, sf, n, q, oracle.get(n))
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        wrong += problem is not None
        kind = "" if n in oracle else " (rows only)"
        print(f"{n:24s} {time.time() - t:6.2f}s {'ok' if problem is None else 'WRONG ' + problem}{kind}", flush=True)
    print(f"{wrong} wrong; oracles without query: {set(oracle) - set(entry.queries())}")
