"""Column contracts of the processed frames and of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampType,
)

_TYPES = {
    "INT": IntegerType(), "BIGINT": LongType(), "STRING": StringType(), "DOUBLE": DoubleType(), "DATE": DateType(),
    "BOOLEAN": BooleanType(), "TIMESTAMP": TimestampType(),
}


def _type(name: str) -> DataType:
    if name.startswith("DECIMAL"):
        precision, scale = name[len("DECIMAL("):-1].split(",")
        return DecimalType(int(precision), int(scale))
    return _TYPES[name]


def _struct(columns: str) -> StructType:
    """"name TYPE, .." -> schema; unlike StructType.fromDDL it needs no running session."""
    pairs = (c.split(" ") for c in columns.split(", "))
    return StructType([StructField(name, _type(kind)) for name, kind in pairs])


# Processed frames, column order and types.
FRAMES = {
    "dim_date": _struct(
        "date_key INT, full_date DATE, year INT, quarter INT, month INT, month_name STRING, "
        "year_month STRING, week_of_year INT, day INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN"
    ),
    "dim_customer": _struct(
        "customer_id BIGINT, email STRING, username STRING, first_name STRING, last_name STRING, "
        "full_name STRING, phone STRING, city STRING, street_address STRING, zipcode STRING, "
        "latitude DOUBLE, longitude DOUBLE, email_domain STRING"
    ),
    "dim_product": _struct(
        "product_id BIGINT, title STRING, category STRING, category_display STRING, description STRING, "
        "image_url STRING, price DECIMAL(10,2), price_tier STRING, rating_rate DECIMAL(3,2), "
        "rating_count BIGINT, rating_band STRING"
    ),
    "fact_sales": _struct(
        "cart_id BIGINT, customer_id BIGINT, product_id BIGINT, date_key INT, order_date DATE, "
        "quantity INT, unit_price DECIMAL(10,2), line_total DECIMAL(12,2)"
    ),
}

# The key that is unique in each processed frame.
FRAME_KEYS = {
    "dim_date": ["date_key"],
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id"],
    "fact_sales": ["cart_id", "product_id"],
}

FRAME_COLUMNS = {name: schema.names for name, schema in FRAMES.items()}

_STAMPS = _struct("created_at TIMESTAMP, updated_at TIMESTAMP")

# Warehouse tables. Sums are wider than in a row store, so they do not overflow.
TABLES = {
    "dim_date": FRAMES["dim_date"],
    "dim_customer": StructType(
        _struct("customer_key BIGINT").fields + FRAMES["dim_customer"].fields + _STAMPS.fields
    ),
    "dim_product": StructType(
        _struct("product_key BIGINT").fields + FRAMES["dim_product"].fields + _STAMPS.fields
    ),
    "fact_sales": _struct(
        "sales_key BIGINT, cart_id BIGINT, customer_key BIGINT, product_key BIGINT, date_key INT, "
        "quantity INT, unit_price DECIMAL(10,2), line_total DECIMAL(12,2), etl_run_id STRING, "
        "loaded_at TIMESTAMP, updated_at TIMESTAMP, month INT"
    ),
    "agg_daily_sales": _struct(
        "date_key INT, full_date DATE, orders BIGINT, units_sold BIGINT, revenue DECIMAL(22,2), "
        "avg_order_value DECIMAL(22,2)"
    ),
    "agg_category_sales": _struct(
        "category STRING, products_sold BIGINT, orders BIGINT, units_sold BIGINT, "
        "revenue DECIMAL(22,2), revenue_share DECIMAL(6,2)"
    ),
    "agg_customer_summary": _struct(
        "customer_key BIGINT, orders BIGINT, units_purchased BIGINT, revenue DECIMAL(22,2), "
        "avg_order_value DECIMAL(22,2), first_order_date DATE, last_order_date DATE, customer_segment STRING"
    ),
    "etl_run_audit": _struct(
        "run_id STRING, status STRING, started_at TIMESTAMP, finished_at TIMESTAMP, "
        "duration_seconds DECIMAL(10,2), full_refresh BOOLEAN, extracted_counts STRING, "
        "valid_counts STRING, rejected_counts STRING, loaded_counts STRING, error_message STRING"
    ),
    "data_quality_results": _struct(
        "run_id STRING, check_name STRING, entity STRING, status STRING, expected STRING, "
        "actual STRING, details STRING, checked_at TIMESTAMP"
    ),
}

# What a run keeps beside the published tables, so that the next one need not read the whole fact.
STATES = {"state_product_sales": _struct("product_key BIGINT, lines BIGINT, units_sold BIGINT, revenue DECIMAL(22,2)")}

# Columns a reader of the published tables may rely on.
PUBLISHED_COLUMNS = {
    "dim_date": FRAME_COLUMNS["dim_date"],
    "dim_customer": ["customer_key", *FRAME_COLUMNS["dim_customer"]],
    "dim_product": ["product_key", *FRAME_COLUMNS["dim_product"]],
    "fact_sales": ["sales_key", "cart_id", "customer_key", "product_key", "date_key",
                   "quantity", "unit_price", "line_total", "etl_run_id"],
    "agg_daily_sales": ["date_key", "orders", "units_sold", "revenue"],
    "agg_category_sales": ["category", "units_sold", "revenue", "revenue_share"],
    "agg_customer_summary": ["customer_key", "orders", "revenue", "customer_segment"],
}

CUSTOMER_ATTRIBUTES = [c for c in FRAME_COLUMNS["dim_customer"] if c != "customer_id"]
PRODUCT_ATTRIBUTES = [c for c in FRAME_COLUMNS["dim_product"] if c != "product_id"]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of the contract, in order, with their types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
