"""Table constraints as counts of violating rows: one pass per table, one per key, one per child of references."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.plans.aggregates import Tables
from starmart.plans.checks import orphans, union_all

# Columns that may not be null.
NOT_NULL = {
    "dim_date": ["date_key", "full_date", "year", "quarter", "month", "month_name", "year_month", "week_of_year",
                 "day", "day_of_week", "day_name", "is_weekend"],
    "dim_customer": ["customer_key", "customer_id", "email", "username", "first_name", "last_name", "full_name", "city",
                     "created_at", "updated_at"],
    "dim_product": ["product_key", "product_id", "title", "category", "category_display", "price", "price_tier",
                    "rating_band", "created_at", "updated_at"],
    "fact_sales": ["sales_key", "cart_id", "customer_key", "product_key", "date_key", "quantity", "unit_price",
                   "line_total", "etl_run_id", "loaded_at", "updated_at"],
    "agg_daily_sales": ["date_key", "full_date", "orders", "units_sold", "revenue", "avg_order_value"],
    "agg_category_sales": ["category", "products_sold", "orders", "units_sold", "revenue", "revenue_share"],
    "agg_customer_summary": ["customer_key", "orders", "units_purchased", "revenue", "avg_order_value",
                             "first_order_date", "last_order_date", "customer_segment"],
    "etl_run_audit": ["run_id", "status", "started_at", "full_refresh"],
    "data_quality_results": ["run_id", "check_name", "entity", "status", "checked_at"],
}

# Conditions that may not be false.
CONDITIONS = {
    "dim_date": ["quarter between 1 and 4", "month between 1 and 12", "day between 1 and 31",
                 "day_of_week between 1 and 7"],
    "dim_product": ["price > 0", "price_tier in ('budget', 'standard', 'premium')", "rating_rate between 0 and 5",
                    "rating_count >= 0"],
    "fact_sales": ["quantity > 0", "unit_price >= 0", "line_total >= 0"],
    "etl_run_audit": ["status in ('RUNNING', 'SUCCESS', 'FAILED')"],
    "data_quality_results": ["status in ('PASS', 'FAIL', 'WARN')"],
}

# Longest texts.
LENGTHS = {
    "dim_date": {"month_name": 12, "year_month": 7, "day_name": 12},
    "dim_customer": {"email": 255, "username": 100, "first_name": 100, "last_name": 100, "full_name": 200, "phone": 50,
                     "city": 100, "street_address": 200, "zipcode": 20, "email_domain": 100},
    "dim_product": {"title": 500, "category": 100, "category_display": 100, "price_tier": 20, "rating_band": 20},
    "fact_sales": {"etl_run_id": 64},
    "agg_category_sales": {"category": 100},
    "agg_customer_summary": {"customer_segment": 20},
    "etl_run_audit": {"run_id": 64, "status": 20},
    "data_quality_results": {"run_id": 64, "check_name": 100, "entity": 100, "status": 10},
}

# Unique column sets.
UNIQUE = {
    "dim_date": [["date_key"], ["full_date"]],
    "dim_customer": [["customer_key"], ["customer_id"]],
    "dim_product": [["product_key"], ["product_id"]],
    "fact_sales": [["sales_key"], ["cart_id", "product_key"]],
    "agg_daily_sales": [["date_key"]],
    "agg_category_sales": [["category"]],
    "agg_customer_summary": [["customer_key"]],
    "etl_run_audit": [["run_id"]],
}

# References (table, column, referenced table).
REFERENCES = [
    ("fact_sales", "customer_key", "dim_customer"),
    ("fact_sales", "product_key", "dim_product"),
    ("fact_sales", "date_key", "dim_date"),
    ("agg_daily_sales", "date_key", "dim_date"),
    ("agg_customer_summary", "customer_key", "dim_customer"),
    ("data_quality_results", "run_id", "etl_run_audit"),
]


def _label(one_row: DataFrame, table: str, rules: list[tuple[str, str]]) -> DataFrame:
    rows = [
        F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(subject).alias("subject"),
                 F.coalesce(F.col(f"v{i}"), F.lit(0)).cast("bigint").alias("violations"))
        for i, (rule, subject) in enumerate(rules)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def row_tests(name: str, wanted: tuple[str, ...] = ("not null", "check", "length")) -> list[tuple[str, str, str]]:
    """(rule, subject, condition of a violating row) of a table."""
    rules = [("not null", c, f"{c} IS NULL") for c in NOT_NULL.get(name, [])]
    rules += [("check", test, f"NOT ({test})") for test in CONDITIONS.get(name, [])]
    rules += [("length", f"{c} <= {n}", f"char_length({c}) > {n}") for c, n in LENGTHS.get(name, {}).items()]
    return [r for r in rules if r[0] in wanted]


def row_rules(t: Tables, wanted: tuple[str, ...] = ("not null", "check", "length")) -> DataFrame:
    """All rules that look at one row, in one pass per table."""
    out = []
    for name in NOT_NULL:
        rules = row_tests(name, wanted)
        if rules and name in t:
            counts = t[name].agg(*[F.count_if(F.expr(test)).alias(f"v{i}") for i, (_, _, test) in enumerate(rules)])
            out.append(_label(counts, name, [(rule, subject) for rule, subject, _ in rules]))
    return union_all(out)


def unique(t: Tables, known: dict[tuple[str, str], int] | None = None) -> DataFrame:
    """Rows behind the first of their key; `known` are numbers found before, by table and subject."""
    out = []
    for name, sets in UNIQUE.items():
        for columns in sets if name in t else []:
            if known and (name, "+".join(columns)) in known:
                surplus = t[name].sparkSession.range(1).select(F.lit(known[name, "+".join(columns)]).alias("v0"))
            else:
                surplus = t[name].groupBy(*columns).agg(F.count("*").alias("n")).agg(F.sum(F.col("n") - 1).alias("v0"))
            out.append(_label(surplus, name, [("unique", "+".join(columns))]))
    return union_all(out)


def references(t: Tables, parents: Tables | None = None) -> DataFrame:
    """Rows without a parent, for every reference of the tables at hand: each child scanned once."""
    wanted = [r for r in REFERENCES if r[0] in t]
    found = orphans(t, wanted, parents or t)
    labels = t[wanted[0][0]].sparkSession.createDataFrame(
        [(child, column, f"references {parent}") for child, column, parent in wanted], "child STRING, column STRING, rule STRING")
    return labels.join(found, ["child", "column"], "left").select(
        F.col("child").alias("table_name"), "rule", F.col("column").alias("subject"), F.coalesce("orphans", F.lit(0)).alias("violations"))


def broken(written: Tables, tables: Tables, near: DataFrame | None = None, facts: list[tuple[str, str, int]] = ()) -> list[str]:
    """Every rule that the rows written by a run break; `tables` is the state they belong to.

    Of the fact, `near` is the part in which the run can have repeated a key, and `facts` are the rules of single rows that the states of
    the rewritten months show broken: rule, subject, violations.
    """
    found = [f"fact_sales: {rule} {subject} broken {n} times" for rule, subject, n in facts]
    parts = [row_rules(written), unique(written)] if written else []
    parts += [unique({"fact_sales": near})] if near is not None else []
    parts += [references(written, tables)] if any(r[0] in written for r in REFERENCES) else []
    if not parts:
        return found
    rows = union_all(parts).filter(F.col("violations") > 0).collect()
    return found + [f"{r['table_name']}: {r['rule']} {r['subject']} broken {r['violations']} times" for r in rows]
