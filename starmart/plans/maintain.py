"""The aggregates after a batch, from those before it and from the rows that the batch changed.

Sums are old plus new rows minus the rows they replace. Distinct carts per group change by the (group, cart) pairs that
appear or vanish, which only carts with changed rows can do, so the rows of those carts are all that is counted.
Two things cannot be told from the difference alone and are read from the fact, for the groups concerned only: a customer's first or last
day after the row that gave it has moved, and the carts of categories that a product has entered or left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions.values import key_to_date
from starmart.operators.upsert import UNCHANGED, UPDATE
from starmart.plans.aggregates import Tables, category_carts, category_measures
from starmart.session import materialize

# What a changed row is counted by.
COUNTED = ["customer_key", "date_key", "quantity", "line_total"]
MEASURES = ["units_sold", "revenue"]


def signed_rows(changes: DataFrame) -> DataFrame:
    """Classified batch rows as fact rows with a sign: new values count, values they replace count against."""
    new = changes.filter(F.col("action") != UNCHANGED).select("cart_id", "product_key", *COUNTED, F.lit(1).alias("sign"))
    old = changes.filter(F.col("action") == UPDATE).select(
        "cart_id", "product_key", *[F.col(f"old_{c}").alias(c) for c in COUNTED], F.lit(-1).alias("sign"))
    return new.unionByName(old)


def cart_rows(before: DataFrame, signed: DataFrame) -> DataFrame:
    """All rows of the carts that changed: as they stood (stood = 1), and the signed changes (stood = 0), of which only the first are written anew."""
    keys = ["cart_id", "product_key", "customer_key", "date_key"]
    stood = materialize(before.select(keys).join(signed.select("cart_id").distinct(), "cart_id", "left_semi"), "changed_carts")
    return stood.select(*keys, F.lit(1).alias("stood"), F.lit(0).alias("sign")).unionByName(
        signed.select(*keys, F.lit(0).alias("stood"), "sign"))


def order_changes(carts: DataFrame, key: str) -> DataFrame:
    """By how many carts each group has grown."""
    pairs = carts.groupBy(key, "cart_id").agg(F.sum("stood").alias("then"), F.sum(F.col("stood") + F.col("sign")).alias("now"))
    grown = (F.col("now") > 0).cast("bigint") - (F.col("then") > 0).cast("bigint")
    return pairs.groupBy(key).agg(F.sum(grown).alias("orders"))


def sum_changes(signed: DataFrame, key: str) -> DataFrame:
    return signed.groupBy(key).agg(
        F.sum("sign").alias("lines"), F.sum(F.col("sign") * F.col("quantity")).alias("units_sold"),
        F.sum(F.col("sign") * F.col("line_total")).alias("revenue"))


def changes_by(key: str, signed: DataFrame, carts: DataFrame) -> DataFrame:
    return order_changes(carts, key).join(sum_changes(signed, key), key, "left").na.fill(0, MEASURES)


def _added(old: DataFrame, change: DataFrame, key: str, columns: list[str]) -> DataFrame:
    both = old.select(key, *columns).unionByName(change.select(key, *columns))
    return both.groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])


def days(old: DataFrame, signed: DataFrame, carts: DataFrame) -> DataFrame:
    return _added(old, changes_by("date_key", signed, carts), "date_key", ["orders", *MEASURES]).filter("orders > 0")


def products(old: DataFrame, signed: DataFrame) -> DataFrame:
    return _added(old, sum_changes(signed, "product_key"), "product_key", ["lines", *MEASURES]).filter("lines > 0")


def categories(old: DataFrame, totals: DataFrame, carts: DataFrame | None, t: Tables, regrouped: DataFrame | None) -> DataFrame:
    """From new totals per product; `regrouped` holds the categories that a product has entered or left."""
    counted = old.select("category", "orders")
    if carts is not None:
        named = carts.join(t["dim_product"].select("product_key", "category"), "product_key")
        counted = _added(counted, order_changes(named, "category"), "category", ["orders"])
    if regrouped is not None:
        concerned = t["dim_product"].join(regrouped, "category", "left_semi")
        counted = counted.join(regrouped, "category", "left_anti").unionByName(
            category_carts(t["fact_sales"], t | {"dim_product": concerned}, "category"))
    return category_measures(totals, t, "category").join(counted, "category")


def customers(old: DataFrame, signed: DataFrame, carts: DataFrame, fact: DataFrame) -> DataFrame:
    """customer_key, orders, units_sold, revenue, first and last order day; `fact` is the one after the batch."""
    day = key_to_date(F.col("date_key"))
    new, gone = F.when(F.col("sign") > 0, day), F.when(F.col("sign") < 0, day)
    ends = signed.groupBy("customer_key").agg(
        F.min(new).alias("new_first"), F.max(new).alias("new_last"), F.min(gone).alias("gone_first"), F.max(gone).alias("gone_last"))
    change = materialize(changes_by("customer_key", signed, carts).join(ends, "customer_key", "left"), "customer_changes")
    then = old.select("customer_key", "orders", F.col("units_purchased").alias("units_sold"), "revenue", "first_order_date", "last_order_date")
    # a first or last day whose row has moved, and that no new row takes over, has to be looked up
    moved = (F.col("gone_first") <= F.col("first_order_date")) & ~F.coalesce(F.col("new_first") <= F.col("first_order_date"), F.lit(False)) | (
        F.col("gone_last") >= F.col("last_order_date")) & ~F.coalesce(F.col("new_last") >= F.col("last_order_date"), F.lit(False))
    unsure = materialize(change.join(then.drop("orders", *MEASURES), "customer_key").filter(moved).select("customer_key"), "moved_ends")
    c, o = change.alias("c"), then.alias("o")
    both = c.join(o, F.col("c.customer_key") == F.col("o.customer_key"), "full")
    plus = lambda x: (F.coalesce(f"o.{x}", F.lit(0)) + F.coalesce(f"c.{x}", F.lit(0))).alias(x)
    out = both.select(
        F.coalesce("o.customer_key", "c.customer_key").alias("customer_key"), plus("orders"), *[plus(x) for x in MEASURES],
        F.least("first_order_date", "new_first").alias("first_order_date"), F.greatest("last_order_date", "new_last").alias("last_order_date"),
    ).filter("orders > 0")
    if unsure.isEmpty():
        return out
    looked_up = fact.join(unsure, "customer_key", "left_semi").groupBy("customer_key").agg(
        key_to_date(F.min("date_key")).alias("first"), key_to_date(F.max("date_key")).alias("last"))
    return out.join(looked_up, "customer_key", "left").withColumns({
        "first_order_date": F.coalesce("first", "first_order_date"), "last_order_date": F.coalesce("last", "last_order_date")}).drop("first", "last")
