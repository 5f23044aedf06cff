"""Star-schema frames from validated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions.text import (
    email_domain, squash_spaces, strip, strip_lower, text_or_empty, title_case,
)
from starmart.functions.values import date_key, price_tier, rating_band, utc_day
from starmart.schemas import FRAMES, conform


class MissingPrices(RuntimeError):
    pass


def build_products(valid: DataFrame) -> DataFrame:
    """One row per valid product; ids are unique after validation."""
    price = F.col("price").cast("decimal(10,2)")
    rate = F.col("rating_rate").cast("double")
    category = F.lower(squash_spaces(F.col("category")))
    out = valid.select(
        F.col("id").alias("product_id"),
        squash_spaces(F.col("title")).alias("title"),
        category.alias("category"),
        title_case(category).alias("category_display"),
        text_or_empty(F.col("description")).alias("description"),
        text_or_empty(F.col("image")).alias("image_url"),
        price.alias("price"),
        price_tier(price).alias("price_tier"),
        rate.cast("decimal(3,2)").alias("rating_rate"),
        F.col("rating_count").cast("bigint").alias("rating_count"),
        rating_band(rate).alias("rating_band"),
    )
    return conform(out, FRAMES["dim_product"])


def build_customers(valid: DataFrame) -> DataFrame:
    first, last = title_case(F.col("name_firstname")), title_case(F.col("name_lastname"))
    email = strip_lower(F.col("email"))
    number = F.coalesce(F.col("address_number").cast("string"), F.lit(""))
    street = F.coalesce(title_case(F.col("address_street")), F.lit(""))
    out = valid.select(
        F.col("id").alias("customer_id"),
        email.alias("email"),
        strip_lower(F.col("username")).alias("username"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat_ws(" ", first, last).alias("full_name"),
        text_or_empty(F.col("phone")).alias("phone"),
        title_case(F.col("address_city")).alias("city"),
        F.trim(F.concat_ws(" ", number, street)).alias("street_address"),
        text_or_empty(F.col("address_zipcode")).alias("zipcode"),
        F.col("address_geolocation_lat").alias("latitude"),
        F.col("address_geolocation_long").alias("longitude"),
        email_domain(email).alias("email_domain"),
    )
    return conform(out, FRAMES["dim_customer"])


def build_sales(lines: DataFrame, products: DataFrame) -> DataFrame:
    """One row per (cart, product) with the price of this batch; no price leaves a null to be caught."""
    day = utc_day(F.col("order_date"))
    prices = products.select("product_id", F.col("price").alias("unit_price"))
    out = (
        lines.select("cart_id", F.col("user_id").alias("customer_id"), "product_id", day.alias("order_date"), "quantity")
        .join(prices, "product_id", "left")
        .withColumns({
            "date_key": date_key(F.col("order_date")),
            "line_total": (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)"),
        })
    )
    return conform(out, FRAMES["fact_sales"])


def require_prices(sales: DataFrame) -> None:
    lost = sales.filter(F.col("unit_price").isNull()).count()
    if lost:
        raise MissingPrices(f"{lost} sales lines refer to products without a price")


def build_calendar(sales: DataFrame) -> DataFrame:
    """Every day from the first to the last sale; nothing for an empty fact."""
    span = sales.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b"))
    d = F.col("full_date")
    weekday = F.weekday(d) + 1
    out = span.select(F.explode(F.sequence("a", "b")).alias("full_date")).select(
        date_key(d).alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )
    return conform(out, FRAMES["dim_date"])


def build_all(valid: dict[str, DataFrame]) -> dict[str, DataFrame]:
    products = build_products(valid["products"])
    sales = build_sales(valid["cart_items"], products)
    return {
        "dim_date": build_calendar(sales),
        "dim_customer": build_customers(valid["users"]),
        "dim_product": products,
        "fact_sales": sales,
    }
