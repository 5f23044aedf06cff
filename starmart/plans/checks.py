"""Data-quality checks before and after a load, and the table constraints.

Every check is a small frame (check_name, entity, status, expected, actual, details); a gate
collects their union once. Keys are counted per value before any join, so a hot key is one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.plans.aggregates import Tables
from starmart.schemas import FRAME_COLUMNS, FRAME_KEYS, PUBLISHED_COLUMNS

# Statuses.
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


class QualityError(RuntimeError):
    pass


def _check(name: Column | str, entity: Column | str, ok: Column, expected, actual, details="", severity="error") -> Column:
    text = lambda v: (v if isinstance(v, Column) else F.lit(str(v))).cast("string")
    failed = FAIL if severity == "error" else WARN
    return F.struct(
        text(name).alias("check_name"), text(entity).alias("entity"),
        F.when(ok, PASS).otherwise(failed).alias("status"),
        text(expected).alias("expected"), text(actual).alias("actual"), text(details).alias("details"),
    )


def _rows(one_row: DataFrame, checks: list[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*checks)))


def _zero(one_row: DataFrame, entity: str, details: str = "") -> DataFrame:
    """Each column of a one-row frame is a count that has to be 0, named after its check."""
    counts = one_row.select([F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in one_row.columns])
    return _rows(counts, [_check(c, entity, F.col(c) == 0, 0, F.col(c), details) for c in counts.columns])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_faults(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: null_keys, duplicate_keys (rows after the first of their key)."""
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(
        F.sum(F.when(any_null, F.col("n")).otherwise(0)).alias("null_keys"),
        F.sum(F.col("n") - 1).alias("duplicate_keys"),
    )


# ---- before the load

def record_counts(counts: DataFrame) -> DataFrame:
    total = F.col("valid_count") + F.col("rejected_count")
    details = F.format_string("valid=%d rejected=%d", "valid_count", "rejected_count")
    return counts.select(F.inline(F.array(_check(
        "record_count_reconciliation", F.col("entity"), total == F.col("input_count"), F.col("input_count"), total, details
    ))))


def reject_ratio(counts: DataFrame, max_ratio: float) -> DataFrame:
    share = F.format_string("%.1f%%", F.col("reject_ratio") * 100)
    details = F.format_string("%d/%d rejected", "rejected_count", "input_count")
    return counts.select(F.inline(F.array(_check(
        "reject_ratio_threshold", F.col("entity"), F.col("reject_ratio") <= max_ratio, f"<= {max_ratio:.0%}", share, details
    ))))


def frame_schemas(frames: Tables) -> DataFrame:
    out = []
    for name, frame in frames.items():
        want, have = FRAME_COLUMNS[name], frame.columns
        out.append((name, PASS if want == have else FAIL, str(want), str(have)))
    spark = next(iter(frames.values())).sparkSession
    rows = spark.createDataFrame(out, "entity STRING, status STRING, expected STRING, actual STRING")
    return rows.select(F.lit("processed_schema").alias("check_name"), "entity", "status", "expected", "actual",
                       F.lit("").alias("details"))


def frame_keys(frames: Tables) -> DataFrame:
    return union_all([
        _zero(key_faults(frame, FRAME_KEYS[name]), name, f"key={FRAME_KEYS[name]}") for name, frame in frames.items()
    ])


def before_load(counts: DataFrame, frames: Tables, max_ratio: float) -> DataFrame:
    return union_all([record_counts(counts), reject_ratio(counts, max_ratio), frame_schemas(frames), frame_keys(frames)])


def unique_frame(results: list, name: str) -> bool:
    """Whether the checks of a run have found every key of a frame to be there, and once."""
    passed = {r["check_name"] for r in results if r["entity"] == name and r["status"] == PASS}
    return {"null_keys", "duplicate_keys"} <= passed


# ---- after the load

def table_schemas(spark: SparkSession, t: Tables) -> DataFrame:
    out = []
    for name, want in PUBLISHED_COLUMNS.items():
        missing = [c for c in want if c not in t[name].columns]
        out.append((name, FAIL if missing else PASS, f"missing={missing}"))
    rows = spark.createDataFrame(out, "entity STRING, status STRING, actual STRING")
    return rows.select(F.lit("warehouse_schema").alias("check_name"), "entity", "status",
                       F.lit("all expected columns").alias("expected"), "actual", F.lit("").alias("details"))


def sales_keys(sales: DataFrame, products: DataFrame) -> DataFrame:
    """cart_id, product_key of the sales lines whose product is known."""
    return sales.select("cart_id", "product_id").join(products.select("product_id", "product_key"), "product_id").select("cart_id", "product_key")


def sales_met(sales: DataFrame, fact: DataFrame, products: DataFrame) -> DataFrame:
    """One row: surplus (fact rows behind the first of their key) and hits (sales lines whose key the fact has). The fact's
    keys are exchanged and grouped once for the two."""
    keys = BUSINESS_KEYS["fact_sales"]
    side = lambda df, loaded: df.select(*keys, F.lit(loaded).alias("loaded"))
    groups = side(fact, 1).unionByName(side(sales_keys(sales, products), 0)).groupBy(*keys).agg(
        F.sum("loaded").alias("n"), F.count("*").alias("both"))
    met = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]) & (F.col("n") > 0)
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("surplus"),
        F.coalesce(F.sum(F.when(met, F.col("both") - F.col("n"))), F.lit(0)).alias("hits"))


def loaded_rows(frames: Tables, t: Tables, met: dict[str, int] | None = None) -> DataFrame:
    """Every staged key has to be in the new tables; of the fact, `t` may hold the part that the staged carts can be in. `met` are numbers
    of staged rows found in their table before."""
    out = []
    for name, frame in frames.items():
        keys, found = FRAME_KEYS[name], t[name]
        staged = frame.select(*keys)
        if name == "fact_sales":
            staged = sales_keys(frame, t["dim_product"])
            keys = BUSINESS_KEYS[name]
        if met and name in met:
            hits = frame.sparkSession.range(1).select(F.lit(met[name]).cast("bigint").alias("hits"))
        else:
            hits = staged.join(found.select(*keys), keys, "left_semi").agg(F.count("*").alias("hits"))
        wanted = frame.agg(F.count("*").alias("n"))
        both = hits.select("hits", wanted.scalar().alias("n"))
        out.append(_rows(both, [_check("loaded_row_count", name, F.col("hits") == F.col("n"), F.col("n"), F.col("hits"))]))
    return union_all(out)


# The business key of each table.
BUSINESS_KEYS = {
    "dim_customer": ["customer_id"], "dim_product": ["product_id"], "dim_date": ["date_key"],
    "fact_sales": ["cart_id", "product_key"],
}


def business_keys(t: Tables, known: dict[str, int] | None = None) -> DataFrame:
    """Repeated keys; of the fact, `t` may hold the part in which a batch can have caused them. `known` are numbers found before."""
    out = []
    for name, keys in BUSINESS_KEYS.items():
        if known and name in known:
            out.append(_zero(t[name].sparkSession.range(1).select(F.lit(known[name]).alias("duplicate_business_keys")), name))
            continue
        groups = t[name].groupBy(*keys).agg(F.count("*").alias("n"))
        # the fact counts repeated keys, a dimension counts surplus rows
        faults = F.count_if(F.col("n") > 1) if name == "fact_sales" else F.sum(F.col("n") - 1)
        out.append(_zero(groups.agg(faults.alias("duplicate_business_keys")), name))
    return union_all(out)


# The fact's references, by the name of their check: column, table; a key has the same name in both.
FACT_REFERENCES = [
    ("orphan_customer_fk", "customer_key", "dim_customer"),
    ("orphan_product_fk", "product_key", "dim_product"),
    ("orphan_date_fk", "date_key", "dim_date"),
]


def key_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """All keys of some columns as rows (column, key), from one scan."""
    each = [F.struct(F.lit(c).alias("column"), (F.col(c) if _is_text(df, c) else F.col(c).cast("bigint")).alias("key")) for c in columns]
    return df.select(F.inline(F.array(*each)))


def _is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.simpleString() == "string"


def parent_keys(t: Tables, references: list[tuple[str, str]]) -> DataFrame:
    """(column, key) of every row that can be referred to; `references` are (column, table)."""
    return union_all([key_rows(t[table], [column]) for column, table in dict.fromkeys(references)])


def orphans(children: Tables, references: list[tuple[str, str, str]], parents: Tables) -> DataFrame:
    """(child, column, orphans) for references (child, column, parent): rows whose key no parent row has.

    Each child is scanned once: the keys of all its references are rows, counted per key, so that a hot key is one row, and
    met by one anti join with the keys of all parents.
    """
    out = []
    for kind in (False, True):
        wanted = [r for r in references if _is_text(children[r[0]], r[1]) == kind]
        if not wanted:
            continue
        names = list(dict.fromkeys(r[0] for r in wanted))
        used = union_all([key_rows(children[n], [c for child, c, _ in wanted if child == n]).groupBy("column", "key").agg(
            F.count("*").alias("n")).select(F.lit(n).alias("child"), "*") for n in names])
        lost = used.join(parent_keys(parents, [(c, p) for _, c, p in wanted]), ["column", "key"], "left_anti")
        out.append(lost.groupBy("child", "column").agg(F.sum("n").alias("orphans")))
    return union_all(out)


def foreign_keys(t: Tables) -> DataFrame:
    """Fact rows without a parent, from the fact itself; a run has the same numbers from the states of its months."""
    found = orphans(t, [("fact_sales", c, p) for _, c, p in FACT_REFERENCES], t)
    counts = found.agg(*[F.sum(F.when(F.col("column") == c, F.col("orphans"))).alias(name) for name, c, _ in FACT_REFERENCES])
    return _zero(counts, "fact_sales")


# Faulty fact rows, by the name of their check.
FACT_FAULTS = {
    "non_positive_measures": "quantity <= 0 OR unit_price < 0 OR line_total < 0",
    "line_total_equals_qty_x_price": "abs(line_total - quantity * unit_price) > 0.005BD",
}


def fact_measures(t: Tables) -> DataFrame:
    return _zero(t["fact_sales"].agg(*[F.count_if(F.expr(test)).alias(name) for name, test in FACT_FAULTS.items()]), "fact_sales")


def aggregates_reconcile(t: Tables, sold: Column) -> DataFrame:
    """`sold` is the fact's revenue: a scalar over the fact, or the sum of its months' states."""
    out = []
    for name, check in (("agg_daily_sales", "agg_daily_revenue_reconciles"),
                        ("agg_category_sales", "agg_category_revenue_reconciles")):
        gap = F.abs(F.coalesce(F.sum("revenue"), F.lit(0)) - sold)
        out.append(_zero(t[name].agg((gap >= F.lit("0.01").cast("decimal(3,2)")).cast("int").alias(check)), name))
    return union_all(out)


def fact_from_states(states: DataFrame) -> DataFrame:
    """The checks of single fact rows and of their references, added up over the months."""
    names = [*[name for name, _, _ in FACT_REFERENCES], *FACT_FAULTS]
    return _zero(states.agg(*[F.sum(n).alias(n) for n in names]), "fact_sales")


def after_load(spark: SparkSession, frames: Tables, t: Tables, states: DataFrame, near: DataFrame | None = None,
               repeated: dict[str, int] | None = None, met: dict[str, int] | None = None) -> DataFrame:
    """`states` has one row per month of the fact; `near` is the part of the fact in the cart ids' range of the batch; `repeated` are
    numbers of repeated business keys that the constraints have found, `met` numbers of staged rows found with them."""
    part = t if near is None else t | {"fact_sales": near}
    sold = states.agg(F.coalesce(F.sum("revenue"), F.lit(0))).scalar()
    return union_all([
        table_schemas(spark, t), loaded_rows(frames, part, met), business_keys(part, repeated), fact_from_states(states), aggregates_reconcile(t, sold),
    ])


def gate(found: DataFrame, message: str, results: list, fail_on_error: bool = True) -> None:
    """Runs the checks and keeps their results, a few dozen rows; a failed one stops the run."""
    rows = found.collect()
    results.extend(rows)
    if fail_on_error and any(r["status"] == FAIL for r in rows):
        raise QualityError(message)


def summary(results: DataFrame) -> DataFrame:
    """How many checks passed, warned and failed; one row per status, also for none."""
    tally = results.agg(*[F.count_if(F.col("status") == s).alias(s) for s in (PASS, WARN, FAIL)])
    return tally.select(F.expr("stack(3, 'PASS', PASS, 'WARN', WARN, 'FAIL', FAIL) AS (status, checks)"))
