"""The driver's tables as engine input: deliveries of JSON records, and clean star frames."""

from __future__ import annotations

import functools
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checkbook.fixture import COPIES, LINE_ORDER, record
from starmart.operators import star, validate
from starmart.plans import checks, job
from starmart.plans.load import Load
from starmart.plans.warehouse import LOGS, Warehouse
from starmart.schemas import FRAMES, conform
from starmart.session import configure, materialize, scratch_path, together

LAST_DAY = date(2030, 1, 1)      # "today" of the test runs: after every order
FIRST_HALF = date(1998, 6, 30)   # what the first of two deliveries covers

_kept: dict[tuple, object] = {}


def once(build):
    """Build per session and table folder, then reuse: tables in scratch, or frames over them."""
    @functools.wraps(build)
    def get(spark: SparkSession, sf_dir: str):
        key = (build.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in _kept:
            configure(spark)
            _kept[key] = build(spark, sf_dir)
        return _kept[key]
    return get


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_copies(df: DataFrame, entity: str) -> DataFrame:
    copies = F.expr(f"CASE WHEN {COPIES[entity]} THEN array(0, 1) ELSE array(0) END")
    return df.withColumn("c", F.explode(copies))


# ---- deliveries

def cart_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines numbered within their order. One exchange by order serves the numbers and the record that is made of the lines."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ORDER).withColumnRenamed("l_orderkey", "k")
    place = Window.partitionBy("k").orderBy(*[c for c in LINE_ORDER if c != "l_orderkey"])
    return lines.select("k", "l_partkey", "l_quantity", (F.row_number().over(place) - 1).cast("bigint").alias("n"))


def delivered(df: DataFrame, entity: str) -> DataFrame:
    rows = with_copies(df, entity).withColumn("pos", F.col("k") * 2 + F.col("c"))
    return materialize(rows.select("pos", F.expr(record(entity)).alias("rec")), f"{entity}_delivery")


def spread(rows: DataFrame) -> DataFrame:
    """A table in few files or row groups over all cores: what is read from its delivery has as many tasks."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


@once
def delivered_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered(spread(table(spark, sf_dir, "part")).withColumn("k", F.col("p_partkey")), "products")


@once
def delivered_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = spread(table(spark, sf_dir, "customer")).withColumn("k", F.col("c_custkey"))
    return delivered(customers.join(nations, "c_nationkey"), "users")


@once
def delivered_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = cart_lines(spark, sf_dir).select("k", "n", F.expr(record("cart_items")).alias("line"))
    # a cart is one record with all its lines, as the source delivers it, so one order's lines come together
    texts = lines.groupBy("k").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), ",")
        .alias("line_texts")
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey", "o_orderdate")
    return delivered(orders.join(texts, "k", "left"), "carts")


@once
def deliveries(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """(pos, rec) per entity."""
    builds = {"products": delivered_products, "users": delivered_users, "carts": delivered_carts}
    return dict(zip(builds, together(*[lambda b=b: b(spark, sf_dir) for b in builds.values()])))


@once
def checked(spark: SparkSession, sf_dir: str) -> dict[str, validate.Checked]:
    return validate.validate_all(deliveries(spark, sf_dir))


@once
def dirty_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Processed frames of the whole delivery, written once."""
    valid = {name: one.valid for name, one in checked(spark, sf_dir).items()}
    frames = star.build_all(valid)
    frames["fact_sales"] = materialize(frames["fact_sales"], "fact_sales")
    frames["dim_date"] = star.build_calendar(frames["fact_sales"])
    return {n: f if n == "fact_sales" else materialize(f, n) for n, f in frames.items()}


def settings(spark: SparkSession, name: str) -> job.Settings:
    root = scratch_path(spark, name)
    # the deliveries are dirtier than the usual limit allows
    return job.Settings(zones_root=f"{root}/zones", warehouse_root=f"{root}/warehouse", max_reject_ratio=0.5)


@once
def full_run(spark: SparkSession, sf_dir: str) -> job.Settings:
    s = settings(spark, "full")
    job.run(spark, s, deliveries(spark, sf_dir), full_refresh=True, run_id="full", today=LAST_DAY)
    return s


@once
def two_runs(spark: SparkSession, sf_dir: str) -> job.Settings:
    """The first half of the orders as a full load, then everything, of which only the new days are read."""
    s = settings(spark, "halves")
    sources = deliveries(spark, sf_dir)
    # as an array's element the date is looked for once, not by each of its uses
    early = lambda t: t.rlike(r"^\d{4}-") & (F.to_date(F.substring(t, 1, 10), "yyyy-MM-dd") <= F.lit(FIRST_HALF))
    first = sources | {"carts": sources["carts"].filter(F.exists(F.array(F.get_json_object("rec", "$.date")), early))}
    job.run(spark, s, first, full_refresh=True, run_id="first", today=LAST_DAY)
    job.run(spark, s, sources, full_refresh=False, run_id="second", today=LAST_DAY)
    return s


# ---- clean star

def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line per (order, part); a minimum, so a hot order is folded before the exchange. Of lines alike up to the quantity any will do."""
    order = LINE_ORDER[1:LINE_ORDER.index("l_quantity") + 1]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", *order)
    return lines.groupBy("l_orderkey", "l_partkey").agg(F.min(F.struct(*order)).alias("first")).select(
        "l_orderkey", "l_partkey", F.col("first.l_quantity").cast("int").alias("quantity")
    )


def clean_valid(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Rows as validation would hand them on."""
    null = F.lit(None)
    products = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("id"), F.col("p_name").alias("title"),
        F.expr("cast((p_retailprice - 899) * 1.5 as decimal(10,2))").alias("price"), F.col("p_type").alias("category"),
        F.concat(F.lit(" made by "), "p_brand").alias("description"), null.cast("string").alias("image"),
        F.expr("CASE WHEN p_size % 13 <> 0 THEN p_size / 10.0D END").alias("rating_rate"),
        F.col("p_size").alias("rating_count"),
    )
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    users = table(spark, sf_dir, "customer").join(nations, "c_nationkey").select(
        (F.col("c_custkey") + 1).alias("id"),
        F.expr("replace(c_name, '#', '') || '@' || c_mktsegment || '.com'").alias("email"),
        F.col("c_name").alias("username"), F.split_part("c_name", F.lit("#"), F.lit(1)).alias("name_firstname"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("name_lastname"), null.cast("string").alias("phone"),
        F.col("n_name").alias("address_city"), F.lit("  mill  lane ").alias("address_street"),
        (F.col("c_custkey") % 100).alias("address_number"), null.cast("string").alias("address_zipcode"),
        F.col("c_acctbal").alias("address_geolocation_lat"), null.cast("double").alias("address_geolocation_long"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") + 1).alias("user_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
    )
    lines = first_lines(spark, sf_dir).join(orders, "l_orderkey").select(
        (F.col("l_orderkey") + 1).alias("cart_id"), "user_id", "order_date",
        (F.col("l_partkey") + 1).alias("product_id"), "quantity",
    )
    return {"products": products, "users": users, "cart_items": lines}


@once
def clean_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = star.build_all(clean_valid(spark, sf_dir))
    frames["fact_sales"] = materialize(conform(frames["fact_sales"], FRAMES["fact_sales"]), "clean_sales")
    frames["dim_date"] = star.build_calendar(frames["fact_sales"])
    return frames


@once
def loaded(spark: SparkSession, sf_dir: str) -> Load:
    """The clean star, loaded and published by the engine."""
    warehouse = Warehouse(spark, f"{scratch_path(spark, 'clean')}/warehouse")
    load = Load(warehouse, "clean")
    load.all(clean_frames(spark, sf_dir))
    load.publish()
    return load


@once
def published(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return loaded(spark, sf_dir).warehouse.tables()


def clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What validation would count: every row of the clean star came in and is valid."""
    frames = clean_frames(spark, sf_dir)
    came = {"products": frames["dim_product"], "users": frames["dim_customer"], "carts": table(spark, sf_dir, "orders"), "cart_items": frames["fact_sales"]}
    return checks.union_all([rows.agg(
        F.lit(e).alias("entity"), F.count("*").alias("input_count"), F.count("*").alias("valid_count"), F.lit(0).cast("bigint").alias("rejected_count"),
        F.lit(0.0).alias("reject_ratio")) for e, rows in came.items()])


@once
def logs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The logs of the load that the clean star comes from: its audit row, and the results of all checks of a run over its frames and tables."""
    frames, load, results = clean_frames(spark, sf_dir), loaded(spark, sf_dir), []
    audit = job.new_audit(load.run_id, load.moment, True)
    job.log_audit(load.warehouse, audit)
    t = load.warehouse.tables()
    checks.gate(checks.before_load(clean_counts(spark, sf_dir), frames, 0.3).unionByName(
        checks.after_load(spark, frames, t, load.states(), load.near(load.after))), "the clean star fails a check", results, fail_on_error=False)
    audit |= {"status": "SUCCESS", "loaded_counts": load.counts}
    job.finish(audit)
    job.log_results(load.warehouse, audit, results)
    job.log_audit(load.warehouse, audit)
    t = load.warehouse.tables()
    return {name: t[name] for name in LOGS}
