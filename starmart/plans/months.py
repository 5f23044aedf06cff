"""What checks and constraints need to know of the fact, kept as one row per month.

A run works it out for the months it has rewritten, and merges it with the rows of the other months, which the
manifest holds. Rows, revenue, faulty rows and lines without a parent add up; cart ids have a lowest and a highest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.plans.aggregates import Tables
from starmart.plans.checks import FACT_FAULTS, FACT_REFERENCES, key_rows, parent_keys, union_all
from starmart.plans.constraints import row_tests
from starmart.session import materialize

# Columns of a month's state that count faults.
RULES = [f"rule_{i}" for i in range(len(row_tests("fact_sales")))]
FAULTS = [*FACT_FAULTS, *[name for name, _, _ in FACT_REFERENCES], *RULES]
SCHEMA = "month INT, rows BIGINT, revenue DECIMAL(30,2), first_cart BIGINT, last_cart BIGINT, " + ", ".join(f"{f} BIGINT" for f in FAULTS)


def month_states(fact: DataFrame, t: Tables) -> DataFrame:
    """Rows are folded by month where they are. Of the references only the distinct keys are exchanged; those without a parent, usually
    few or none, are written and met with the fact again to be counted per month."""
    tests = FACT_FAULTS | {name: test for name, (_, _, test) in zip(RULES, row_tests("fact_sales"))}
    measures = fact.groupBy("month").agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("line_total"), F.lit(0)).cast("decimal(30,2)").alias("revenue"),
        F.min("cart_id").alias("first_cart"), F.max("cart_id").alias("last_cart"), *[F.count_if(F.expr(test)).alias(name) for name, test in tests.items()],
        *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for _, c, _ in FACT_REFERENCES])
    used = key_rows(fact, [c for _, c, _ in FACT_REFERENCES]).filter("key IS NOT NULL").distinct()
    lost = materialize(used.join(parent_keys(t, [(c, p) for _, c, p in FACT_REFERENCES]), ["column", "key"], "left_anti"), "lost_keys")
    strays = union_all([
        fact.join(lost.filter(F.col("column") == c).select(F.col("key").alias(c)), c).groupBy("month").agg(F.count("*").alias("n")).select(
            F.col("month").alias("at"), F.lit(name).alias("name"), "n") for name, c, _ in FACT_REFERENCES])
    found = strays.groupBy("at").agg(*[F.sum(F.when(F.col("name") == name, F.col("n"))).alias(name) for name, _, _ in FACT_REFERENCES])
    return measures.join(found, F.col("month").eqNullSafe(F.col("at")), "left").withColumns(
        {name: F.col(f"no_{c}") + F.coalesce(name, F.lit(0)) for name, c, _ in FACT_REFERENCES}).select(
        [c.split(" ")[0] for c in SCHEMA.split(", ")])


def faulty(state: dict) -> bool:
    """Whether the month is to be looked at again: a missing parent may have come since."""
    return any(state[f] for f in FAULTS)


def overlapping(manifest: dict, low: int, high: int) -> dict[str, str]:
    """Folders of the months that may hold cart ids of a range; a month without a state may."""
    def meets(month: str) -> bool:
        s = manifest["states"].get(month)
        return s is None or s["first_cart"] is None or s["first_cart"] <= high and s["last_cart"] >= low
    return {m: path for m, path in manifest["months"].items() if meets(m)}


def broken_rules(states: list[dict]) -> list[tuple[str, str, int]]:
    """(rule, subject, violations) of the fact over the states of some months."""
    out = [(rule, subject, sum(s[name] for s in states)) for name, (rule, subject, _) in zip(RULES, row_tests("fact_sales"))]
    out += [(f"references {parent}", column, sum(s[name] for s in states)) for name, column, parent in FACT_REFERENCES]
    return [r for r in out if r[2]]
