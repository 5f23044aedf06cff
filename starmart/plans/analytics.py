"""The fifteen business queries over the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starmart.functions.values import key_to_date
from starmart.operators.pairs import top_pairs
from starmart.operators.position import tile, with_position
from starmart.plans.aggregates import (
    Tables, all_revenue, grand_total, orders, per_category, per_customer, per_product, percent, ratio, revenue, units,
)

# Recency limits in days.
RECENCY = [(30, "active"), (90, "at risk")]


def _month_names(t: Tables) -> DataFrame:
    """month (yyyymm, as stored on the fact) -> year_month; one row per calendar month."""
    return t["dim_date"].select(F.floor(F.col("date_key") / 100).cast("int").alias("month"), "year_month").distinct()


def monthly_growth(t: Tables) -> DataFrame:
    months = t["fact_sales"].groupBy("month").agg(revenue(), orders()).join(_month_names(t), "month")
    before = F.lag("revenue").over(Window.orderBy("year_month"))   # one row per month
    return months.withColumn("prev_month_revenue", before).select(
        "year_month", "revenue", "orders", "prev_month_revenue",
        percent(F.col("revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue")).alias("mom_growth_pct"),
    ).orderBy("year_month")


def top_customers(t: Tables, n: int = 10) -> DataFrame:
    """Ranks only the n rows kept: no row outside them can come before one of them.

    Only customers that spend as much as the n-th one, ties included, meet the dimension.
    """
    least = per_customer(t).orderBy(F.desc("revenue")).limit(n).agg(F.min("revenue")).scalar()
    spend = per_customer(t).filter(F.col("revenue") >= least)
    names = t["dim_customer"].select("customer_key", "customer_id", "full_name", "city")
    top = spend.join(names, "customer_key").orderBy(F.desc("revenue"), "customer_id").limit(n)
    # the share comes after the rank: a projection right above the limit would be pushed below it
    # and turn the top-n into a full sort
    ranked = top.withColumn("revenue_rank", F.dense_rank().over(Window.orderBy(F.desc("revenue"))))
    return ranked.select(
        "revenue_rank", "customer_id", "full_name", "city", F.col("revenue").alias("lifetime_value"),
        percent(F.col("revenue"), all_revenue(t)).alias("pct_of_total_revenue"),
    ).orderBy("revenue_rank", "customer_id")


def category_mix(t: Tables) -> DataFrame:
    return per_category(t, "category_display").select(
        F.col("category_display").alias("category"), "orders", "units_sold", "revenue",
        percent(F.col("revenue"), all_revenue(t)).alias("revenue_share_pct"),
    ).orderBy(F.desc("revenue"), "category")


def top_products_per_category(t: Tables, n: int = 3) -> DataFrame:
    # products share titles: joined first, all lines of a title are folded before one exchange
    products = t["dim_product"].select("product_key", F.col("category_display").alias("category"), "title")
    titles = t["fact_sales"].select("product_key", "line_total", "quantity").join(products, "product_key").groupBy(
        "category", "title").agg(revenue(), units())
    # the rank filter becomes a per-partition limit before the exchange
    best = Window.partitionBy("category").orderBy(F.desc("revenue"), "title")
    return (
        titles.withColumn("rank_in_category", F.row_number().over(best)).filter(F.col("rank_in_category") <= n)
        .select("category", "rank_in_category", "title", "revenue", "units_sold")
        .orderBy("category", "rank_in_category")
    )


def running_revenue(t: Tables) -> DataFrame:
    # kept in step with the fact by the same publication, at one row per day
    days = t["agg_daily_sales"].select("date_key", F.col("revenue").alias("daily_revenue"))
    days = days.join(t["dim_date"].select("date_key", "full_date"), "date_key")
    so_far = Window.orderBy("full_date")   # one row per calendar day
    week = so_far.rowsBetween(-6, 0)
    return days.select(
        "full_date", "daily_revenue",
        F.sum("daily_revenue").over(so_far).alias("cumulative_revenue"),
        ratio(F.sum("daily_revenue").over(week), F.count("*").over(week)).alias("moving_avg_7_rows"),
    ).orderBy("full_date")


def order_value_by_month(t: Tables) -> DataFrame:
    carts = t["fact_sales"].groupBy("month", "cart_id").agg(
        F.sum("line_total").alias("order_value"), F.sum("quantity").alias("items")
    )
    months = carts.groupBy("month").agg(
        F.count("*").alias("orders"), F.sum("order_value").alias("value"), F.sum("items").alias("items"),
        F.max("order_value").alias("largest_order"),
    )
    return months.join(_month_names(t), "month").select(
        "year_month", "orders",
        ratio(F.col("value"), F.col("orders")).alias("avg_order_value"),
        ratio(F.col("items"), F.col("orders")).alias("avg_items_per_order"),
        "largest_order",
    ).orderBy("year_month")


def spend_quartiles(t: Tables) -> DataFrame:
    ranked = with_position(per_customer(t), [F.col("revenue").desc(), F.col("customer_key")], "at", "n")
    quartiles = ranked.groupBy(tile(F.col("at"), F.col("n"), 4).alias("quartile")).agg(
        F.count("*").alias("customers"), F.min("revenue").alias("min_spend"), F.max("revenue").alias("max_spend"),
        F.sum("revenue").alias("total_revenue"),
    )
    share = percent(F.col("total_revenue"), grand_total("total_revenue"))
    return quartiles.withColumn("pct_of_revenue", share).orderBy("quartile")


def repeat_customers(t: Tables) -> DataFrame:
    customers = t["fact_sales"].groupBy("customer_key").agg(orders(), revenue())
    kinds = customers.groupBy(
        F.when(F.col("orders") == 1, "one-time").otherwise("repeat").alias("customer_type")
    ).agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    return kinds.select(
        "customer_type", "customers",
        ratio(F.col("orders"), F.col("customers")).alias("avg_orders"),
        "revenue",
        ratio(F.col("revenue"), F.col("customers")).alias("avg_revenue_per_customer"),
    ).orderBy(F.desc("customers"), "customer_type")


def sales_by_weekday(t: Tables) -> DataFrame:
    days = t["dim_date"].select("date_key", "day_of_week", "day_name", "is_weekend")
    weekdays = t["fact_sales"].join(days, "date_key").groupBy("day_of_week", "day_name", "is_weekend").agg(orders(), revenue())
    share = percent(F.col("revenue"), grand_total("revenue"))
    return weekdays.withColumn("pct_of_revenue", share).orderBy("day_of_week")


def price_tiers(t: Tables) -> DataFrame:
    """The rating averages over sale lines, so each product counts by its lines."""
    rated = F.when(F.col("rating_rate").isNotNull(), F.col("lines"))
    tiers = per_product(t).groupBy("price_tier").agg(
        F.count("*").alias("products"), F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"),
        F.sum(F.col("rating_rate") * F.col("lines")).alias("stars"), F.sum(rated).alias("rated"),
    )
    return tiers.select(
        "price_tier", "products", "units_sold", "revenue",
        ratio(F.col("revenue"), F.col("units_sold")).alias("avg_selling_price"),
        ratio(F.col("stars"), F.col("rated")).alias("avg_rating"),
    ).orderBy(F.desc("revenue"), "price_tier")


def bought_together(t: Tables, n: int = 10) -> DataFrame:
    products = t["dim_product"].select("product_key", "product_id", "title")
    return top_pairs(t["fact_sales"].select("cart_id", "product_key"), products, n, "product_key")


def customer_recency(t: Tables) -> DataFrame:
    activity = t["fact_sales"].groupBy("customer_key").agg(
        F.min("date_key").alias("a"), F.max("date_key").alias("b"), orders()
    )
    latest = t["fact_sales"].agg(key_to_date(F.max("date_key"))).scalar()
    days = F.date_diff(latest, F.col("last_order"))
    status = None
    for limit, name in RECENCY:
        test = F.col("days_since_last_order") <= limit
        status = F.when(test, name) if status is None else status.when(test, name)
    return (
        activity.join(t["dim_customer"].select("customer_key", "full_name"), "customer_key")
        .withColumns({"first_order": key_to_date(F.col("a")), "last_order": key_to_date(F.col("b"))})
        .withColumn("days_since_last_order", days)
        .select("full_name", "first_order", "last_order", "orders", "days_since_last_order",
                status.otherwise("lapsed").alias("recency_status"))
        .orderBy(F.desc("days_since_last_order"), "full_name")
    )


def rating_bands(t: Tables) -> DataFrame:
    bands = per_product(t).groupBy("rating_band").agg(
        F.count("*").alias("products"), F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue")
    )
    return bands.withColumns({
        "units_per_product": ratio(F.col("units_sold"), F.col("products")),
        "pct_of_revenue": percent(F.col("revenue"), grand_total("revenue")),
    }).orderBy(F.desc("revenue"), "rating_band")


def city_pareto(t: Tables) -> DataFrame:
    homes = t["dim_customer"].select("customer_key", "city")
    cities = per_customer(t).join(homes, "customer_key").groupBy("city").agg(
        F.count("*").alias("customers"), F.sum("revenue").alias("revenue")
    )
    # cities are free text, so their number has no bound and no single task orders them
    placed = with_position(cities, [F.desc("revenue"), F.col("city")], "at", running=("revenue", "so_far"))
    placed = placed.join(placed.groupBy("revenue").agg(F.min("at").alias("city_rank")), "revenue")
    return placed.select(
        "city_rank", "city", "customers", "revenue",
        percent(F.col("so_far"), all_revenue(t)).alias("cumulative_pct_of_revenue"),
    ).orderBy("city_rank", "city")


def run_health(t: Tables, n: int = 10) -> DataFrame:
    """The last n runs with their counts and how their checks came out."""
    runs = t["etl_run_audit"].orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)
    # tallies first, so the join sees one row per run
    tallies = t["data_quality_results"].groupBy("run_id").agg(
        *[F.count_if(F.col("status") == s).alias(f"dq_{s.lower()}") for s in ("PASS", "WARN", "FAIL")]
    )
    none = {f"dq_{s}": 0 for s in ("pass", "warn", "fail")}
    return runs.join(tallies, "run_id", "left").na.fill(none).select(
        "run_id", "status", "started_at", "duration_seconds",
        F.get_json_object("extracted_counts", "$.carts").cast("int").alias("carts_extracted"),
        F.get_json_object("rejected_counts", "$.cart_items").cast("int").alias("cart_items_rejected"),
        *none,
    ).orderBy(F.desc("started_at"), F.desc("run_id"))


QUERIES = {
    "q01_monthly_mom": monthly_growth,
    "q02_top_customers": top_customers,
    "q03_category_mix": category_mix,
    "q04_top3_per_category": top_products_per_category,
    "q05_running_total": running_revenue,
    "q06_aov_by_month": order_value_by_month,
    "q07_spend_quartiles": spend_quartiles,
    "q08_repeat_customers": repeat_customers,
    "q09_day_of_week": sales_by_weekday,
    "q10_price_tier": price_tiers,
    "q11_bought_together": bought_together,
    "q12_recency": customer_recency,
    "q13_rating_vs_sales": rating_bands,
    "q14_city_pareto": city_pareto,
    "q15_run_health": run_health,
}
