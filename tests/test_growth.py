"""What breaks, or grows faster than its input, only on larger tables."""

from __future__ import annotations

import re
from collections import Counter
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checkbook import mapping, registry
from starmart.operators import position, validate
from starmart.plans import checks, constraints, job, load, months
from starmart.schemas import FRAMES
from starmart.sources import records, zones

SF_DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture
def conf(spark):
    """Session settings for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)
    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@tables
@pytest.mark.parametrize("partitions", [4, 7, 16])
def test_array_files_are_never_empty(spark, conf, partitions):
    """Rows of one file each, dealt over five tasks by chance, left tasks without a row, whose files were no arrays."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", str(partitions))
    got = Counter((r["entity"], r["rec"]) for r in registry.ingest_arrays(spark, SF_DIR).collect())
    sent = mapping.deliveries(spark, SF_DIR)
    assert got == Counter((e, r["rec"]) for e, rows in sent.items() for r in rows.collect())


def refuse(*_args, **_kwargs):
    raise AssertionError("work that this query does not need")


@tables
def test_damaged_tables_need_no_whole_run(spark, monkeypatch):
    monkeypatch.setattr(mapping, "full_run", refuse)
    assert {"fact_sales", "dim_customer", "agg_daily_sales"} <= set(registry.damaged_tables(spark, SF_DIR))


@tables
def test_lines_are_numbered_without_a_written_copy(spark, monkeypatch):
    monkeypatch.setattr(position, "materialize", refuse)
    rows = mapping.cart_lines(spark, SF_DIR).groupBy("k").agg(F.count("*").alias("n"), F.min("n").alias("a"), F.max("n").alias("b"))
    assert rows.count() and not rows.filter("a <> 0 OR b <> n - 1").count()


@tables
def test_customers_need_no_carts(spark, monkeypatch):
    monkeypatch.setattr(mapping, "_kept", {})
    monkeypatch.setattr(mapping, "cart_lines", refuse)
    assert registry.QUERIES["dim_customer"](spark, SF_DIR).count() and registry.QUERIES["dim_product"](spark, SF_DIR).count()


@tables
def test_reasons_come_from_the_rows_as_checked(spark, monkeypatch):
    mapping.checked(spark, SF_DIR)
    for step in ("check_records", "check_lines", "reject_orphans"):
        monkeypatch.setattr(validate, step, refuse)
    for name in ("reject_reasons", "check_pattern", "orphan_lines"):
        assert registry.QUERIES[name](spark, SF_DIR).count()


def test_the_raw_zone_is_compressed(spark, tmp_path):
    rows = spark.createDataFrame([(i, '{"id": %d}' % i) for i in range(50)], "pos BIGINT, rec STRING")
    assert zones.write_raw(rows, str(tmp_path), "carts", "r", mapping.LAST_DAY, "carts") == 50
    assert {f.suffix for f in tmp_path.rglob("part-*")} == {".gz"}
    assert zones.read_raw(spark, str(tmp_path), "carts", "r", mapping.LAST_DAY).orderBy("pos").collect() == rows.collect()


def test_states_write_lost_keys_only(spark, monkeypatch):
    fact = spark.range(600).selectExpr(
        "id AS sales_key", "id AS cart_id", "IF(id % 50 = 0, NULL, id % 20) AS customer_key", "id % 30 AS product_key", "20200101 AS date_key",
        "1 AS quantity", "cast(1 AS decimal(10,2)) AS unit_price", "cast(1 AS decimal(12,2)) AS line_total", "'r' AS etl_run_id",
        "timestamp'2020-01-01' AS loaded_at", "timestamp'2020-01-01' AS updated_at", "cast(202001 + id % 2 AS int) AS month")
    t = {"dim_customer": spark.range(1, 20).toDF("customer_key"), "dim_product": spark.range(30).toDF("product_key"),
         "dim_date": spark.sql("SELECT 20200101 AS date_key")}
    sizes, write = [], months.materialize
    monkeypatch.setattr(months, "materialize", lambda df, name: (sizes.append(df.count()), write(df, name))[1])
    got = {r["month"]: r for r in months.month_states(fact, t).collect()}
    lost = {i % 2: sum(1 for k in range(600) if k % 2 == i and (k % 50 == 0 or k % 20 == 0)) for i in range(2)}
    assert {m - 202001: r["orphan_customer_fk"] for m, r in got.items()} == lost
    assert all((r["rows"], r["revenue"], r["orphan_product_fk"], r["orphan_date_fk"]) == (300, 300, 0, 0) for r in got.values())
    assert sizes == [1]                      # customer 0; a null key is counted where its row is


def test_a_load_folds_repeated_lines_only(spark, monkeypatch):
    sales = spark.createDataFrame(
        [(c, p, q) for c in range(40) for p in range(3) for q in ((2, 1) if c % 10 == 0 else (5,))] + [(None, 1, 4), (None, 1, 3), (7, None, 9)],
        "cart_id INT, product_id INT, quantity INT")
    folded, write = [], load.materialize
    monkeypatch.setattr(load, "materialize", lambda df, name: (folded.append(df.count()), write(df, name))[1])
    got = load.one_per_key(sales, ["cart_id", "product_id"]).collect()
    want = [(c, p, 1 if c % 10 == 0 else 5) for c in range(40) for p in range(3)] + [(None, 1, 3), (7, None, 9)]
    assert Counter(tuple(r) for r in got) == Counter(want)
    assert folded == [4 * 3 + 1]


def test_a_cart_is_parsed_once_for_its_day(spark):
    carts = spark.createDataFrame([(i, t) for i, t in enumerate([
        '{"date": "2020-03-01"}', '{"date": "2020-03-09"}', '{"date": "2020-3-9T1"}', '{"date": "2020-03-30"}', '{"date": "soon"}', '"junk"', "{", None])],
        "pos BIGINT, rec STRING")
    found = records.carts_since(carts, date(2020, 3, 5), date(2020, 3, 11))
    assert [r["pos"] for r in found.orderBy("pos").collect()] == [1, 2, 4, 5, 6, 7]
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson") + plan.count("parse_json") == 1


def test_only_text_that_can_name_a_secret_is_looked_through(spark):
    texts = ['{"password": 1, "a": 2}', '{"pass\\u0077ord": 1, "a": 2}', '{"a": "password"}', '{"a": 2}', '["password"]', "{"]
    got = [r["rec"] for r in records.redact(spark.createDataFrame(list(enumerate(texts)), "pos BIGINT, rec STRING")).orderBy("pos").collect()]
    assert got[:5] == ['{"a":2}', '{"a":2}', *texts[2:5]] and got[5].startswith('"unreadable: 1 ')


@tables
def test_small_tables_are_delivered_over_all_cores(spark, monkeypatch):
    monkeypatch.setattr(mapping, "_kept", {})
    for build in (mapping.delivered_products, mapping.delivered_users):
        assert len(build(spark, SF_DIR).inputFiles()) == spark.sparkContext.defaultParallelism > 1


@tables
def test_constraints_need_no_whole_run(spark, monkeypatch):
    """The logs they look at are those of the load of the tables they look at."""
    monkeypatch.setattr(mapping, "full_run", refuse)
    monkeypatch.setattr(mapping, "deliveries", refuse)
    logs = mapping.logs(spark, SF_DIR)
    assert [(r["run_id"], r["status"]) for r in logs["etl_run_audit"].collect()] == [("clean", "SUCCESS")]
    assert Counter(r["status"] for r in logs["data_quality_results"].collect()) == {"PASS": 42}
    assert "etl_run_audit" in {r["table_name"] for r in registry.QUERIES["constraint_unique"](spark, SF_DIR).collect()}


def test_a_load_exchanges_no_constants(spark, shop, deliver, tmp_path, monkeypatch):
    from starmart.operators import star
    from starmart.plans.warehouse import Warehouse
    frames = star.build_all({k: v.valid for k, v in validate.validate_all(deliver(shop)).items()})
    seen, number = [], load.assign_keys
    monkeypatch.setattr(load, "assign_keys", lambda df, natural, key, last: (seen.extend(df.columns if key == "sales_key" else []), number(df, natural, key, last))[1])
    first = load.Load(Warehouse(spark, str(tmp_path)), "r1")
    first.all(frames)
    assert seen and not {"etl_run_id", "loaded_at", "updated_at"} & set(seen)
    assert {(r["etl_run_id"], r["loaded_at"] is None) for r in first.tables()["fact_sales"].collect()} == {("r1", False)}


def test_a_run_writes_its_sales_frame_once(spark, shop, deliver, tmp_path, monkeypatch):
    names, write = [], job.materialize
    monkeypatch.setattr(job, "materialize", lambda df, name: (names.append(name), write(df, name))[1])
    for form in ("parquet", "csv"):
        settings = job.Settings(f"{tmp_path}/{form}/zones", f"{tmp_path}/{form}/warehouse", processed_form=form)
        assert job.run(spark, settings, deliver(shop), run_id="r1")["loaded_counts"]["dim_date"]["inserted"] == 9
    assert set(names) == {"counts"}


def test_a_run_groups_the_keys_of_its_sales_once_after_the_load(spark, shop, deliver, tmp_path, monkeypatch):
    known, count = [], checks.business_keys
    monkeypatch.setattr(checks, "business_keys", lambda t, found=None: (known.append(found), count(t, found))[1])
    out = job.run(spark, job.Settings(f"{tmp_path}/zones", f"{tmp_path}/warehouse"), deliver(shop), run_id="r1")
    assert known == [{"fact_sales": 0}] and out["quality"] == {"PASS": 42, "WARN": 0, "FAIL": 0}
    t = {n: spark.range(3).toDF(k[0]) for n, k in checks.BUSINESS_KEYS.items()}      # of the fact no product, so no key to group by
    found = {r["entity"]: (r["actual"], r["status"]) for r in count(t, {"fact_sales": 2}).collect()}
    assert found["fact_sales"] == ("2", "FAIL") and found["dim_customer"] == ("0", "PASS")


def test_checking_carts_is_compiled_by_the_jvm(spark, tmp_path):
    """One generated method of 13,815 bytes held all forms of a date; the JVM leaves methods of more than 8,000 bytes to its interpreter."""
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    spark.createDataFrame([(1, '{"id": 1, "userId": 2, "date": "2020-3-9T1", "products": [{"productId": 1, "quantity": 1}]}')], "pos BIGINT, rec STRING").write.parquet(f"{tmp_path}/c")
    checked = validate.check_records(spark.read.parquet(f"{tmp_path}/c"), "carts")
    plan = checked._jdf.queryExecution().executedPlan()
    code = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenString(plan)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) <= 8000
    assert [(r["id"], r["date"], r["reasons"]) for r in checked.collect()] == [(1, "2020-3-9T1", "")]


def test_a_cart_is_parsed_once_on_its_way_to_the_raw_zone(spark):
    """The look-back's filter and the redaction parsed it each."""
    texts = ['{"date": "2020-03-09", "password": 1}', '{"date": "2020-03-01"}', "{", '{"date": "2020-03-10"}']
    carts = spark.createDataFrame(list(enumerate(texts)), "pos BIGINT, rec STRING")
    found = records.redact(records.carts_since(records.parsed(carts), date(2020, 3, 5), date(2020, 3, 11)))
    assert found.columns == ["pos", "rec"]
    got = {r["pos"]: r["rec"] for r in found.collect()}
    assert set(got) == {0, 2, 3} and got[0] == '{"date":"2020-03-09"}' and got[3] == texts[3] and got[2].startswith('"unreadable: 1 ')
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson") + plan.count("parse_json") == 1


def test_a_whole_number_is_read_without_a_cast(spark):
    """Its JSON is its text; other tokens are cast as before, to the same text."""
    texts = ["5", "-0", "9223372036854775807", "-9223372036854775808", "9223372036854775808", "1e2", "2.50", '"7"', '" 8 "', "true", "null", "[]", "{}", '{"a":1}', "[1]"]
    rows = spark.createDataFrame([(f'{{"productId": {t}, "quantity": 1}}',) for t in texts], "rec STRING").select("rec", F.try_parse_json("rec").alias("v"))
    flat = validate.flatten(rows.withColumn("cast", F.try_variant_get("v", "$.productId", "string")), "cart_items", F.col("v"), ["cast"])
    assert all(r["product_id__text"] == r["cast"] for r in flat.collect()) and flat.filter("product_id__text IS NULL").count() == 1
    assert "to_json" in flat._jdf.queryExecution().analyzed().toString()


def test_only_rejected_lines_are_kept_as_they_came(spark, shop, deliver):
    shop["carts"][0]["products"] += [{"productId": 99, "quantity": 1}, {"productId": 1, "quantity": 9}, {"productId": 1, "quantity": "x"}]
    items = validate.validate_all(deliver(shop))["cart_items"]
    assert {(r["reasons"] == "", r["line_value"] is None) for r in items.rows.collect()} == {(True, True), (False, False)}
    assert sorted(r["reject_reason"] for r in items.rejected.filter("raw_record LIKE '%\"line\":{%'").collect()) == [
        "duplicate_key:cart_id+product_id", "invalid_type:quantity(expected int)", "orphan_reference:product_id"]


def sales_of(spark, rows):
    return spark.createDataFrame([(c, 1, p, 20200101, date(2020, 1, 1), q, Decimal(1), Decimal(q)) for c, p, q in rows], FRAMES["fact_sales"])


def test_a_batch_meets_the_rows_of_its_carts_only(spark, shop, deliver, tmp_path, monkeypatch):
    """The whole fact was exchanged with the batch, and again for the carts that changed."""
    sizes, write = {}, load.materialize

    def put(df, name):
        sizes[name] = df.count()
        return write(df, name)
    settings = job.Settings(f"{tmp_path}/zones", f"{tmp_path}/warehouse", lookback_days=0)
    job.run(spark, settings, deliver(shop), run_id="r1")
    shop["carts"][2]["products"][0]["quantity"] = 7
    shop["carts"].append({"id": 4, "userId": 1, "date": "2020-03-11", "products": [{"productId": 1, "quantity": 1}]})
    monkeypatch.setattr(load, "materialize", put)
    out = job.run(spark, settings, deliver(shop), run_id="r2")
    assert out["loaded_counts"]["fact_sales"] == {"staged": 3, "inserted": 1, "updated": 1, "unchanged": 1}
    assert sizes["met_carts"] == 1 and sizes["met_sales"] == 2 and "changed_carts" not in sizes


def test_keys_of_sales_and_fact_are_grouped_once(spark):
    fact = spark.createDataFrame([(1, 11), (1, 11), (1, 12), (2, 11), (None, 11), (None, 11), (9, 12)], "cart_id BIGINT, product_key BIGINT")
    products = spark.createDataFrame([(1, 11), (2, 12)], "product_id BIGINT, product_key BIGINT")
    sales = sales_of(spark, [(1, 1, 1), (1, 2, 1), (2, 2, 1), (2, 1, 1), (None, 1, 1), (9, 3, 1)])
    t = {"fact_sales": fact, "dim_product": products}
    found = checks.sales_met(sales, fact, products)
    alone = checks.loaded_rows({"fact_sales": sales}, t).first()
    surplus = {r["subject"]: r["violations"] for r in constraints.unique({"fact_sales": fact.withColumn("sales_key", F.monotonically_increasing_id())}).collect()}
    assert found.first().asDict() == {"surplus": surplus["cart_id+product_key"], "hits": int(alone["actual"])} == {"surplus": 2, "hits": 3}
    assert sum("Exchange hashpartitioning(cart_id" in line for line in found._jdf.queryExecution().executedPlan().toString().splitlines()) == 1
    known = checks.loaded_rows({"fact_sales": sales}, t, {"fact_sales": 3}).first()
    assert known == alone


def test_sales_whose_keys_the_gate_found_unique_are_not_grouped_again(spark, shop, deliver, tmp_path, monkeypatch):
    monkeypatch.setattr(load, "one_per_key", refuse)
    settings = job.Settings(f"{tmp_path}/zones", f"{tmp_path}/warehouse")
    assert job.run(spark, settings, deliver(shop), run_id="r1")["quality"] == {"PASS": 42, "WARN": 0, "FAIL": 0}
    row = lambda name, status: {"check_name": name, "entity": "fact_sales", "status": status}
    assert not checks.unique_frame([row("null_keys", "PASS"), row("duplicate_keys", "FAIL")], "fact_sales")
    assert not checks.unique_frame([row("duplicate_keys", "PASS")], "fact_sales")


@tables
def test_the_first_half_looks_for_a_date_once(spark, monkeypatch):
    """Its filter took the date out of every cart by each use of it."""
    taken = []
    monkeypatch.setattr(mapping, "_kept", {k: v for k, v in mapping._kept.items() if k[0] != "two_runs"})
    monkeypatch.setattr(job, "run", lambda spark, s, sources, **_: taken.append(sources["carts"]))
    mapping.two_runs(spark, SF_DIR)
    assert taken[0]._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1
    days = [r[0][:10] for r in taken[0].select(F.get_json_object("rec", "$.date")).collect()]
    assert days and max(days) <= mapping.FIRST_HALF.isoformat() and 0 < len(days) < taken[1].count()


def test_steps_that_need_not_wait_run_together(spark, shop, deliver, tmp_path, monkeypatch):
    """The quarantine beside the processed zone; states, keys and constraints of what is loaded beside each other."""
    side_by_side, run = [], job.together
    monkeypatch.setattr(job, "together", lambda *work: (side_by_side.append(len(work)), run(*work))[1])
    out = job.run(spark, job.Settings(f"{tmp_path}/zones", f"{tmp_path}/warehouse"), deliver(shop), run_id="r1")
    assert side_by_side == [3, 2, 3] and out["quality"]["PASS"] == 42
