"""One runnable query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, DecimalType, FloatType, IntegerType, ShortType

from checkbook import mapping as m
from starmart.functions import text, values
from starmart.operators import star, upsert, validate
from starmart.plans import analytics, checks, constraints, load, months
from starmart.plans.aggregates import AGGREGATES
from starmart.plans.warehouse import Warehouse
from starmart.session import materialize, scratch_path
from starmart.sources import records, zones

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and whole numbers as bigint, so that both engines hash alike."""
    def widen(field):
        if isinstance(field.dataType, (DecimalType, FloatType)):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (ByteType, ShortType, IntegerType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)
    return df.select([widen(f) for f in df.schema.fields])


def _each(spark: SparkSession, d: str, build, entities=("products", "users", "carts")) -> DataFrame:
    return checks.union_all([build(e).select(F.lit(e).alias("entity"), "*") for e in entities])


# ---- sources and sinks

def ingest_records(spark, d):
    """The deliveries as JSON Lines files, read back with their positions."""
    def one(entity):
        path = scratch_path(spark, f"{entity}_lines")
        m.deliveries(spark, d)[entity].select("rec").write.text(path)
        rows = records.redact(records.read_json_lines(spark, path))
        return rows.agg(F.count("*").alias("records"), F.sum("pos").alias("pos_sum"), F.max("pos").alias("pos_max"))
    return _each(spark, d, one)


ARRAY_FILES = 5               # array files side by side
ARRAY_SPAN = 1_000_000        # positions a file covers at most


def write_arrays(rows: DataFrame, path: str) -> None:
    """pos, rec as files that each hold one JSON array. A file's records are sorted lines of one task, the first behind an opening
    and the last before a closing bracket; the number of files grows with the positions, and none is empty."""
    file = F.floor(F.col("pos") / (ARRAY_FILES * ARRAY_SPAN)) * ARRAY_FILES + F.col("pos") % ARRAY_FILES
    placed = rows.withColumn("file", file.cast("bigint"))
    ends = materialize(placed.groupBy("file").agg(F.min("pos").alias("first"), F.max("pos").alias("last")), "array_ends")
    text = F.concat(F.when(F.col("pos") == F.col("first"), "[ ").otherwise(""), "rec", F.when(F.col("pos") == F.col("last"), "]").otherwise(" ,"))
    lines = placed.join(ends, "file").select("file", "pos", text.alias("value")).repartition("file").sortWithinPartitions("file", "pos")
    lines.select("file", "value").write.partitionBy("file").text(path)


def ingest_arrays(spark, d):
    """The deliveries as files that each hold one JSON array, read back by splits: every record with its own text."""
    def one(entity):
        path = scratch_path(spark, f"{entity}_arrays")
        write_arrays(m.deliveries(spark, d)[entity], path)
        return records.read_json_arrays(spark, path).select("rec")
    return _each(spark, d, one)


def redact_fields(spark, d):
    out = records.redact(m.deliveries(spark, d)["users"])
    return out.select(
        "pos", F.array_join(F.sort_array(F.json_object_keys("rec")), ",").alias("field_names"),
        F.get_json_object("rec", "$.username").alias("username"))


def raw_zone_roundtrip(spark, d):
    root = scratch_path(spark, "raw")
    def one(entity):
        zones.write_raw(m.deliveries(spark, d)[entity], root, entity, "r", m.LAST_DAY, entity)
        return zones.read_raw(spark, root, entity, "r", m.LAST_DAY)
    return _each(spark, d, one)


def incremental_scan(spark, d):
    since = records.since_day(m.FIRST_HALF, 1, False)
    return records.carts_since(m.deliveries(spark, d)["carts"], since, m.LAST_DAY).select("pos")


def landed_scan(spark, d):
    """The same carts, sorted into day folders when they land."""
    root = scratch_path(spark, "landed")
    records.land(m.deliveries(spark, d)["carts"], root, "carts")
    since = records.since_day(m.FIRST_HALF, 1, False)
    return records.carts_since(records.landed(spark, root, "carts"), since, m.LAST_DAY).select("pos")


def processed_roundtrip(spark, d):
    """All four frames as CSV and back: key and some values of every row."""
    root, frames = scratch_path(spark, "processed"), m.dirty_frames(spark, d)
    zones.write_processed(frames, root, "r", m.LAST_DAY, "csv")
    cents = lambda c: (F.col(c) * 100).cast("bigint")
    wanted = {
        "dim_date": ("date_key", F.concat_ws("|", "full_date", "month_name", "week_of_year", "is_weekend")),
        "dim_customer": ("customer_id", F.concat_ws("|", "email", "full_name", "street_address", F.col("latitude").cast("bigint"))),
        "dim_product": ("product_id", F.concat_ws("|", "title", "category", cents("price"), "price_tier", F.coalesce(F.col("rating_count").cast("string"), F.lit("-")))),
        "fact_sales": (F.col("cart_id") * 1_000_000 + F.col("product_id"), F.concat_ws("|", "quantity", cents("unit_price"), cents("line_total"), "order_date"))}
    return checks.union_all([
        zones.read_processed(spark, root, name, "r", m.LAST_DAY, "csv").select(
            F.lit(name).alias("entity"), (F.col(key) if isinstance(key, str) else key).cast("bigint").alias("frame_key"), label.alias("frame_values"))
        for name, (key, label) in wanted.items()])


@m.once
def rejected_zone(spark, d) -> str:
    root = scratch_path(spark, "rejected")
    zones.write_rejected(validate.union_rejected(m.checked(spark, d)), root, "r", m.LAST_DAY)
    return root


def rejected_rows(spark, d):
    return zones.read_rejected(spark, rejected_zone(spark, d), "r").select("entity", "reject_reason", "raw_record")


def zone_partitions(spark, d):
    path = zones.zone_path(rejected_zone(spark, d), "rejected")
    return spark.read.parquet(path).groupBy("entity", "dt").agg(F.count("*").alias("records"))


# ---- validation

def _rules_alone(rows: DataFrame, pos) -> DataFrame:
    """Reasons of the record rules alone: only rows clean by them are given a reason for their key or references, so those count as clean."""
    later = F.col("reasons").startswith("duplicate_key:") | F.col("reasons").startswith("orphan_reference:")
    return rows.select(pos.alias("pos"), F.when(later, "").otherwise(F.col("reasons")).alias("reasons"))


def rule_rows(spark, d) -> dict[str, DataFrame]:
    return {e: _rules_alone(m.checked(spark, d)[e].rows, F.col("pos")) for e in ("products", "users", "carts")}


def line_rows(spark, d) -> DataFrame:
    """Cart lines after their own rules."""
    return _rules_alone(m.checked(spark, d)["cart_items"].rows, F.col("cart_id") * 1_000_000 + F.col("line"))


def flatten_records(spark, d):
    """All declared fields of every entity, one row per field."""
    out = []
    for entity in ("products", "users", "carts"):
        parsed = m.deliveries(spark, d)[entity].select("pos", F.try_parse_json("rec").alias("v"))
        flat = validate.flatten(parsed, entity, F.col("v"), ["pos"])
        names = [c.removesuffix("__text") for c in flat.columns if c.endswith("__text") and c != "products__text"]
        fields = F.inline(F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"{n}__text").alias("value")) for n in names]))
        out.append(flat.select(F.lit(entity).alias("entity"), "pos", fields))
    return checks.union_all(out)


def reject_non_object(spark, d):
    rows = rule_rows(spark, d)
    return _each(spark, d, lambda e: rows[e].filter(F.col("reasons") == validate.NOT_AN_OBJECT).select("pos"))


def _rule(prefix: str) -> Query:
    def query(spark, d):
        rows = rule_rows(spark, d) | {"cart_items": line_rows(spark, d)}
        return _each(spark, d, lambda e: rows[e].select("pos", F.explode(F.split("reasons", validate.SEPARATOR)).alias("reason"))
                     .filter(F.col("reason").startswith(prefix)), rows)
    return query


def reject_reasons(spark, d):
    rows = rule_rows(spark, d) | {"cart_items": line_rows(spark, d)}
    return _each(spark, d, lambda e: rows[e].filter(F.col("reasons") != "")
                 .select("pos", F.col("reasons").alias("reject_reason")), rows)


def dedup_first_wins(spark, d):
    rows = m.checked(spark, d)
    lines = rows["cart_items"].rows.filter(F.col("reasons") == "duplicate_key:cart_id+product_id")
    return _each(spark, d, lambda e: rows[e].rows.filter(F.col("reasons") == "duplicate_key:id").select("pos")).unionByName(
        lines.select(F.lit("cart_items").alias("entity"), (F.col("cart_id") * 1_000_000 + F.col("line")).alias("pos")))


def explode_cart_lines(spark, d):
    lines = validate.explode_lines(m.checked(spark, d)["carts"].valid)
    return lines.select("cart_id", "user_id", "order_date", "line", F.to_json("line_value").alias("line_text"))


def orphan_lines(spark, d):
    rows = m.checked(spark, d)["cart_items"].rows
    return rows.select("cart_id", "line", F.col("reasons").alias("reason")).filter(
        F.col("reason").startswith("orphan"))


def validation_counts(spark, d):
    return validate.union_counts(m.checked(spark, d))


def validate_all(spark, d):
    valid = validate.validate_all(m.deliveries(spark, d))["cart_items"].valid
    return valid.select("cart_id", "user_id", "order_date", "product_id", "quantity")


# ---- cleaning functions

def squash_spaces(spark, d):
    return m.table(spark, d, "documents").select("doc_id", text.squash_spaces(F.col("text")).alias("cleaned"))


def title_case(spark, d):
    nations = m.table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    padded = F.concat(F.lit("  "), "c_mktsegment", F.lit("\t o'NEIL-"), F.lower("n_name"), F.lit("  "))
    return m.table(spark, d, "customer").join(nations, "c_nationkey").select(
        "c_custkey", text.title_case(padded).alias("titled"))


def _product(column: str) -> Query:
    return lambda spark, d: m.clean_frames(spark, d)["dim_product"].select("product_id", column)


def email_domain(spark, d):
    return m.clean_frames(spark, d)["dim_customer"].select("customer_id", "email_domain")


def utc_order_date(spark, d):
    """Event times written with three offsets, read back as UTC days."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zone = F.element_at(F.array(F.lit("Z"), F.lit("-05:00"), F.lit("+0530")), (F.col("event_id") % 3 + 1).cast("int"))
    events = m.table(spark, d, "events").select("event_id", F.concat(stamp, zone).alias("t"))
    return events.select("event_id", values.utc_day(F.col("t")).alias("order_date"))


def date_key(spark, d):
    return m.table(spark, d, "orders").select("o_orderkey", values.date_key(F.to_date("o_orderdate")).alias("date_key"))


# ---- frames

def dim_product(spark, d):
    """From the products alone."""
    return star.build_products(validate.validate_entity(m.delivered_products(spark, d), "products").valid)


def dim_customer(spark, d):
    """From the users alone."""
    return star.build_customers(validate.validate_entity(m.delivered_users(spark, d), "users").valid)


def _frame(name: str) -> Query:
    return lambda spark, d: m.dirty_frames(spark, d)[name]


def processed_schema(spark, d):
    frames = m.dirty_frames(spark, d)
    sizes = checks.union_all([f.agg(F.lit(n).alias("entity"), F.count("*").alias("frame_rows")) for n, f in frames.items()])
    return checks.frame_schemas(frames).join(sizes, "entity").select("entity", "status", "frame_rows")


# ---- upserts

def insert_if_absent(spark, d):
    days = m.clean_frames(spark, d)["dim_date"]
    return upsert.insert_absent(days.filter(F.col("full_date") <= F.lit(m.FIRST_HALF)), days, ["date_key"]).select("date_key")


def upsert_dim(spark, d):
    """Both dimensions against a table that lacks some rows, has some changed and some that the batch does not mention."""
    out, now = [], F.lit("2031-01-01").cast("timestamp")
    for name, key, changed in (("dim_customer", "customer_id", "city"), ("dim_product", "product_id", "title")):
        batch, old, i = m.clean_frames(spark, d)[name], m.published(spark, d)[name], F.col(key)
        existing = old.filter(i % 10 != 3).withColumn(changed, F.when(i % 7 == 1, "Elsewhere").otherwise(F.col(changed))).unionByName(
            old.filter(i % 50 == 0).withColumn(key, i + 10_000_000))
        attributes = [c for c in batch.columns if c != key]
        kept = upsert.apply_changes(existing, batch, key, attributes, now)
        fresh = upsert.insert_absent(existing, batch, [key])
        shown = [F.lit(name).alias("table_name"), i.alias("natural_key"), F.col(changed).alias("value")]
        out += [kept.select(*shown, (F.col("updated_at") == now).alias("changed"), F.lit(False).alias("inserted")),
                fresh.select(*shown, F.lit(False).alias("changed"), F.lit(True).alias("inserted"))]
    return checks.union_all(out)


def unmapped_fact_rows(spark, d):
    t = dict(m.published(spark, d))
    t["dim_customer"] = t["dim_customer"].filter("customer_id % 19 <> 0")
    t["dim_product"] = t["dim_product"].filter("product_id % 23 <> 0")
    t["dim_date"] = t["dim_date"].filter("year_month <> '1997-05'")
    return load.unmapped_rows(load.resolve_keys(m.clean_frames(spark, d)["fact_sales"], t))


def surrogate_lookup(spark, d):
    found = load.resolve_keys(m.clean_frames(spark, d)["fact_sales"], m.published(spark, d))
    return found.select("cart_id", "product_id", "customer_key", "product_key", "date_key")


def surrogate_keys(spark, d):
    t = m.published(spark, d)
    return checks.union_all([
        t[n].select(F.lit(n).alias("table_name"), F.col(i).alias("natural_key"), F.col(k).alias("surrogate_key"))
        for n, i, k in (("dim_customer", "customer_id", "customer_key"), ("dim_product", "product_id", "product_key"))])


def _changes(spark, d):
    """A batch with moved days, changed quantities and new carts against the published fact."""
    fact = m.published(spark, d)["fact_sales"]
    c = F.col("cart_id")
    known = fact.filter(c % 2 == 0).withColumns({
        "date_key": F.when(c % 13 == 0, values.date_key(values.key_to_date(F.col("date_key")) + 40)).otherwise(F.col("date_key")),
        "quantity": F.when(c % 11 == 0, F.col("quantity") + 1).otherwise(F.col("quantity")),
    })
    new = fact.filter(c % 17 == 0).withColumn("cart_id", c + 100_000_000)
    columns = ["cart_id", "customer_key", "product_key", "date_key", "quantity", "unit_price"]
    batch = known.select(columns).unionByName(new.select(columns))
    return upsert.classify(fact, batch, ["cart_id", "product_key"], load.FACT_COMPARED, ["sales_key", "month"])


def upsert_fact(spark, d):
    return _changes(spark, d).select("cart_id", "product_key", "date_key", "quantity", "action", "old_month")


def load_counts(spark, d):
    return load.action_counts(_changes(spark, d))


# ---- whole runs

def _final_fact(runs) -> Query:
    def query(spark, d):
        t = Warehouse(spark, runs(spark, d).warehouse_root).tables()
        fact = t["fact_sales"].join(t["dim_product"].select("product_key", "product_id"), "product_key")
        fact = fact.join(t["dim_customer"].select("customer_key", "customer_id"), "customer_key")
        return fact.select("cart_id", "customer_id", "product_id", "date_key", "quantity", "unit_price", "line_total")
    return query


def _full_warehouse(spark, d) -> Warehouse:
    return Warehouse(spark, m.full_run(spark, d).warehouse_root)


def publish_snapshot(spark, d):
    t = _full_warehouse(spark, d).tables()
    names = ("dim_date", "dim_customer", "dim_product", "fact_sales", *AGGREGATES)
    return checks.union_all([t[n].agg(F.lit(n).alias("table_name"), F.count("*").alias("table_rows")) for n in names])


def watermark_advance(spark, d):
    return Warehouse(spark, m.two_runs(spark, d).warehouse_root).watermarks().select("entity", "watermark_value")


def run_audit(spark, d):
    number = lambda column, path: F.get_json_object(column, path).cast("bigint")
    return _full_warehouse(spark, d).runs().select(
        "run_id", "status", "full_refresh",
        number("extracted_counts", "$.carts").alias("carts_extracted"),
        number("valid_counts", "$.products").alias("products_valid"),
        number("rejected_counts", "$.cart_items").alias("cart_items_rejected"),
        number("loaded_counts", "$.fact_sales.inserted").alias("sales_inserted"))


def dq_results(spark, d):
    return _full_warehouse(spark, d).tables()["data_quality_results"].select(
        "run_id", "check_name", "entity", "status", "expected", "actual", "details")


def q15_run_health(spark, d):
    t = Warehouse(spark, m.two_runs(spark, d).warehouse_root).tables()
    return analytics.run_health(t).drop("started_at", "duration_seconds")


def _published(build) -> Query:
    return lambda spark, d: build(m.published(spark, d))


# ---- checks on a damaged star

def _twice(df: DataFrame, condition: str) -> DataFrame:
    return df.unionByName(df.filter(condition))


def damaged_tables(spark, d) -> dict[str, DataFrame]:
    t = dict(m.published(spark, d))
    when = lambda test, new, column: F.when(F.expr(test), F.expr(new)).otherwise(F.col(column))
    t["fact_sales"] = _twice(t["fact_sales"].withColumns({
        "quantity": when("cart_id % 31 = 0", "0", "quantity"),
        "line_total": when("cart_id % 37 = 0", "cast(line_total + 0.01 as decimal(12,2))", "line_total"),
        "unit_price": when("cart_id % 41 = 0", "cast(-1 as decimal(10,2))", "unit_price"),
        "product_key": F.when(F.expr("cart_id % 97 <> 0"), F.col("product_key")),
    }), "cart_id % 89 = 0")
    t["dim_customer"] = _twice(t["dim_customer"].filter("customer_id % 19 <> 0").withColumn(
        "email", F.when(F.expr("customer_id % 29 <> 0"), F.col("email"))), "customer_id % 43 = 0")
    t["dim_product"] = t["dim_product"].filter("product_id % 23 <> 0").withColumns({
        "price": when("product_id % 31 = 0", "cast(0 as decimal(10,2))", "price"),
        "price_tier": when("product_id % 53 = 0", "'cheap'", "price_tier"),
        "rating_rate": when("product_id % 59 = 0", "cast(6 as decimal(3,2))", "rating_rate"),
    })
    t["dim_date"] = t["dim_date"].filter("year_month <> '1997-05'").withColumn("quarter", when("day = 31", "5", "quarter"))
    t["agg_daily_sales"] = t["agg_daily_sales"].withColumn("avg_order_value", F.when(F.expr("date_key % 10 <> 1"), F.col("avg_order_value")))
    t["agg_customer_summary"] = _twice(t["agg_customer_summary"].withColumn(
        "customer_segment", when("customer_key % 37 = 0", "repeat('x', 21)", "customer_segment")), "customer_key % 41 = 0")
    return t


def damaged_logs(spark, d) -> dict[str, DataFrame]:
    """The logs of the load of these tables, which only constraints look at: other checks need none."""
    when = lambda test, new, column: F.when(F.expr(test), F.expr(new)).otherwise(F.col(column))
    logs = m.logs(spark, d)
    return {
        "etl_run_audit": logs["etl_run_audit"].unionByName(logs["etl_run_audit"].withColumn("status", F.lit("DONE"))),
        "data_quality_results": logs["data_quality_results"].withColumns({
            "run_id": when("check_name = 'null_keys'", "'lost'", "run_id"), "status": when("check_name = 'duplicate_keys'", "'OK'", "status"),
            "entity": F.when(F.expr("check_name <> 'warehouse_schema'"), F.col("entity"))})}


def damaged_frames(spark, d) -> dict[str, DataFrame]:
    f = dict(m.clean_frames(spark, d))
    f["fact_sales"] = _twice(f["fact_sales"].withColumn(
        "product_id", F.when(F.expr("cart_id % 97 <> 0"), F.col("product_id"))), "cart_id % 89 = 0")
    f["dim_customer"] = _twice(f["dim_customer"], "customer_id % 43 = 0")
    return f


def _found(build, names: list[str] | None = None) -> Query:
    def query(spark, d):
        rows = build(spark, d)
        rows = rows.filter(F.col("check_name").isin(names)) if names else rows
        return rows.select("check_name", "entity", "actual", "status")
    return query


def dq_record_counts(spark, d):
    rows = checks.record_counts(validation_counts(spark, d))
    return rows.select("entity", "expected", "actual", "status")


def dq_reject_ratio(spark, d):
    return checks.reject_ratio(validation_counts(spark, d), 0.30).select("entity", "actual", "status")


def _without_band(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return t | {"dim_product": t["dim_product"].drop("rating_band")}


def dq_warehouse_schema(spark, d):
    t = _without_band(m.published(spark, d))
    return checks.table_schemas(spark, t).join(
        checks.union_all([t[n].agg(F.lit(n).alias("entity"), F.count("*").alias("table_rows"))
                          for n in ("dim_date", "dim_customer", "dim_product", "fact_sales", *AGGREGATES)]), "entity"
    ).select("entity", "status", "actual", "table_rows")


def dq_loaded_rows(spark, d):
    t = dict(m.published(spark, d))
    t["fact_sales"] = t["fact_sales"].filter("cart_id % 31 <> 0")
    t["dim_customer"] = t["dim_customer"].filter("customer_id % 19 <> 0")
    return checks.loaded_rows(m.clean_frames(spark, d), t).select("entity", "expected", "actual", "status")


def dq_agg_reconcile(spark, d):
    t = damaged_tables(spark, d)
    rows = checks.aggregates_reconcile(t, months.month_states(t["fact_sales"], t).agg(F.sum("revenue")).scalar())
    return rows.select("check_name", "entity", "actual", "status")


def dq_gate(spark, d):
    """All checks of a run over damaged frames and tables: 20 before the load, 22 after it."""
    t = damaged_tables(spark, d)
    found = checks.before_load(validation_counts(spark, d), damaged_frames(spark, d), 0.3).unionByName(
        checks.after_load(spark, m.clean_frames(spark, d), _without_band(t), months.month_states(t["fact_sales"], t)))
    return found.select("check_name", "entity", "status")


def dq_summary(spark, d):
    return checks.summary(checks.business_keys(damaged_tables(spark, d)))


def _broken(build) -> Query:
    return lambda spark, d: build(damaged_tables(spark, d) | damaged_logs(spark, d)).filter(F.col("violations") > 0)


QUERIES: dict[str, Query] = {
    "ingest_records": ingest_records,
    "ingest_arrays": ingest_arrays,
    "redact_fields": redact_fields,
    "raw_zone_roundtrip": raw_zone_roundtrip,
    "incremental_scan": incremental_scan,
    "landed_scan": landed_scan,
    "processed_roundtrip": processed_roundtrip,
    "rejected_rows": rejected_rows,
    "zone_partitions": zone_partitions,
    "flatten_records": flatten_records,
    "reject_non_object": reject_non_object,
    "check_required": _rule("missing_required"),
    "check_types": _rule("invalid_type"),
    "check_ranges": _rule("out_of_range"),
    "check_pattern": _rule("invalid_format"),
    "reject_reasons": reject_reasons,
    "dedup_first_wins": dedup_first_wins,
    "explode_cart_lines": explode_cart_lines,
    "orphan_lines": orphan_lines,
    "validation_counts": validation_counts,
    "validate_all": validate_all,
    "squash_spaces": squash_spaces,
    "title_case": title_case,
    "price_tier": _product("price_tier"),
    "rating_band": _product("rating_band"),
    "email_domain": email_domain,
    "utc_order_date": utc_order_date,
    "date_key": date_key,
    "dim_product": dim_product,
    "dim_customer": dim_customer,
    "fact_sales": _frame("fact_sales"),
    "dim_date": _frame("dim_date"),
    "processed_schema": processed_schema,
    "insert_if_absent": insert_if_absent,
    "upsert_dim": upsert_dim,
    "unmapped_fact_rows": unmapped_fact_rows,
    "surrogate_lookup": surrogate_lookup,
    "upsert_fact": upsert_fact,
    "load_counts": load_counts,
    "surrogate_keys": surrogate_keys,
    "publish_snapshot": publish_snapshot,
    "watermark_advance": watermark_advance,
    "run_audit": run_audit,
    "dq_results": dq_results,
    **{name: _published(build) for name, build in AGGREGATES.items()},
    **{name: _published(build) for name, build in analytics.QUERIES.items()},
    "q15_run_health": q15_run_health,
    "dq_record_counts": dq_record_counts,
    "dq_reject_ratio": dq_reject_ratio,
    "dq_null_keys": _found(lambda s, d: checks.frame_keys(damaged_frames(s, d)), ["null_keys"]),
    "dq_duplicate_keys": _found(lambda s, d: checks.frame_keys(damaged_frames(s, d)), ["duplicate_keys"]),
    "dq_warehouse_schema": dq_warehouse_schema,
    "dq_loaded_rows": dq_loaded_rows,
    "dq_business_keys": _found(lambda s, d: checks.business_keys(damaged_tables(s, d))),
    "dq_orphan_fks": _found(lambda s, d: checks.foreign_keys(damaged_tables(s, d))),
    "dq_measures": _found(lambda s, d: checks.fact_measures(damaged_tables(s, d)), ["non_positive_measures"]),
    "dq_line_total": _found(lambda s, d: checks.fact_measures(damaged_tables(s, d)), ["line_total_equals_qty_x_price"]),
    "dq_agg_reconcile": dq_agg_reconcile,
    "dq_gate": dq_gate,
    "dq_summary": dq_summary,
    "constraint_not_null": _broken(lambda t: constraints.row_rules(t, ("not null",))),
    "constraint_check": _broken(lambda t: constraints.row_rules(t, ("check", "length"))),
    "constraint_unique": _broken(constraints.unique),
    "constraint_fk": _broken(constraints.references),
    "end_to_end_load": _final_fact(m.full_run),
    "incremental_load": _final_fact(m.two_runs),
}


def queries() -> dict[str, Query]:
    def wrap(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(m.configure(spark), sf_dir))
    return {name: wrap(query) for name, query in QUERIES.items()}
