"""The three tables kept in step with the fact, and the groupings that queries share.

The fact is always reduced by its own key before a dimension is joined, so the join sees one
row per product, customer or day, and a hot key is folded on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.functions.values import key_to_date
from starmart.operators.position import tile, with_position
from starmart.schemas import TABLES, conform

Tables = dict[str, DataFrame]

# Names of the spend quartiles, highest first.
SEGMENTS = ["platinum", "gold", "silver", "bronze"]


def orders() -> Column:
    return F.count_distinct(F.col("cart_id")).alias("orders")


def units() -> Column:
    return F.sum("quantity").alias("units_sold")


def revenue() -> Column:
    return F.sum("line_total").alias("revenue")


def grand_total(column: str) -> Column:
    """Sum over all rows of a grouped result that has a few fixed groups."""
    return F.sum(column).over(Window.partitionBy())


def ratio(part: Column, whole: Column) -> Column:
    """part / whole to two places, half up; null for a zero whole. Decimal, never floating."""
    return F.round(part.cast("decimal(26,2)") / F.nullif(whole, F.lit(0)).cast("decimal(22,2)"), 2)


def percent(part: Column, whole: Column) -> Column:
    return ratio(100 * part, whole)


def all_revenue(t: Tables) -> Column:
    """The fact's total as a scalar subquery: one column, no exchange of keys."""
    return t["fact_sales"].agg(F.sum("line_total")).scalar()


def per_product(t: Tables) -> DataFrame:
    """One row per sold product with its attributes: lines, units_sold, revenue."""
    return product_totals(t).join(t["dim_product"], "product_key")


def per_customer(t: Tables) -> DataFrame:
    return t["fact_sales"].groupBy("customer_key").agg(revenue())


def per_day(t: Tables) -> DataFrame:
    return t["fact_sales"].groupBy("date_key").agg(orders(), units(), revenue())


def product_totals(t: Tables) -> DataFrame:
    """One row per sold product: lines, units_sold, revenue."""
    return t["fact_sales"].groupBy("product_key").agg(F.count("*").alias("lines"), units(), revenue())


def customer_orders(t: Tables) -> DataFrame:
    """One row per customer: orders, units_sold, revenue, first and last order day."""
    return (
        t["fact_sales"].groupBy("customer_key")
        .agg(orders(), units(), revenue(), F.min("date_key").alias("a"), F.max("date_key").alias("b"))
        .withColumns({"first_order_date": key_to_date(F.col("a")), "last_order_date": key_to_date(F.col("b"))})
        .drop("a", "b")
    )


def category_measures(products: DataFrame, t: Tables, column: str) -> DataFrame:
    """products_sold, units_sold, revenue by a product column, from totals per product."""
    return products.join(t["dim_product"].select("product_key", column), "product_key").groupBy(column).agg(
        F.count("*").alias("products_sold"), F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue")
    )


def category_carts(sales: DataFrame, t: Tables, column: str) -> DataFrame:
    """Distinct carts by a product column; only (group, cart) pairs are exchanged."""
    return (
        sales.select("product_key", "cart_id").join(t["dim_product"].select("product_key", column), "product_key")
        .groupBy(column).agg(orders())
    )


def per_category(t: Tables, column: str) -> DataFrame:
    """products_sold, orders, units_sold, revenue by a product column.

    Two column-pruned passes: the measures fold to one row per product first; only the
    distinct carts need (group, cart) pairs. One pass with two distinct counts would expand
    every fact row threefold.
    """
    return category_measures(product_totals(t), t, column).join(category_carts(t["fact_sales"], t, column), column)


def finished_days(days: DataFrame, t: Tables) -> DataFrame:
    out = days.join(t["dim_date"].select("date_key", "full_date"), "date_key").withColumn(
        "avg_order_value", ratio(F.col("revenue"), F.col("orders"))
    )
    return conform(out, TABLES["agg_daily_sales"])


def finished_categories(categories: DataFrame, total: Column) -> DataFrame:
    return conform(categories.withColumn("revenue_share", percent(F.col("revenue"), total)), TABLES["agg_category_sales"])


def finished_customers(customers: DataFrame) -> DataFrame:
    ranked = with_position(customers, [F.col("revenue").desc(), F.col("customer_key")], "at", "customers")
    names = F.array(*[F.lit(s) for s in SEGMENTS])
    out = ranked.withColumns({
        "units_purchased": F.col("units_sold"),
        "avg_order_value": ratio(F.col("revenue"), F.col("orders")),
        "customer_segment": F.element_at(names, tile(F.col("at"), F.col("customers"), 4).cast("int")),
    })
    return conform(out, TABLES["agg_customer_summary"])


def daily_sales(t: Tables) -> DataFrame:
    return finished_days(per_day(t), t)


def category_sales(t: Tables) -> DataFrame:
    return finished_categories(per_category(t, "category"), all_revenue(t))


def customer_summary(t: Tables) -> DataFrame:
    return finished_customers(customer_orders(t))


AGGREGATES = {
    "agg_daily_sales": daily_sales,
    "agg_category_sales": category_sales,
    "agg_customer_summary": customer_summary,
}
