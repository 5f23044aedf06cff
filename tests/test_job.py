"""Whole runs on the small delivery: results, idempotence, changes, failures."""

from __future__ import annotations

import copy
import os
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from starmart.plans import analytics, job
from starmart.plans.analytics import QUERIES
from starmart.plans.checks import QualityError
from starmart.plans.warehouse import ManifestLost, PublishConflict, Warehouse
from starmart.sources import zones


@pytest.fixture
def settings(tmp_path):
    return job.Settings(zones_root=f"{tmp_path}/zones", warehouse_root=f"{tmp_path}/warehouse")


def counts(t):
    return {name: t[name].count() for name in
            ("dim_product", "dim_customer", "fact_sales", "dim_date", "agg_daily_sales", "agg_category_sales")}


def test_first_run(spark, shop, deliver, settings):
    out = job.run(spark, settings, deliver(shop), run_id="r1", today=date.today())
    w = Warehouse(spark, settings.warehouse_root)
    t = w.tables()
    assert out["status"] == "SUCCESS" and out["quality"] == {"PASS": 42, "WARN": 0, "FAIL": 0}
    assert counts(t) == {"dim_product": 3, "dim_customer": 2, "fact_sales": 5, "dim_date": 9,
                         "agg_daily_sales": 3, "agg_category_sales": 2}
    assert w.watermark() == "2020-03-10"
    line = t["fact_sales"].join(t["dim_product"], "product_key").filter("cart_id = 1 AND product_id = 1").first()
    assert (float(line["unit_price"]), line["quantity"], float(line["line_total"]), line["date_key"]) == (109.95, 4, 439.80, 20200302)
    assert out["extracted_counts"] == {"products": 3, "users": 2, "carts": 3}
    assert out["loaded_counts"]["fact_sales"] == {"staged": 5, "inserted": 5, "updated": 0, "unchanged": 0}
    for name, query in QUERIES.items():
        assert query(t).count() > 0, name
    health = QUERIES["q15_run_health"](t).first()
    assert (health["run_id"], health["carts_extracted"], health["cart_items_rejected"], health["dq_pass"]) == ("r1", 3, 0, 42)
    envelope = zones.raw_envelopes(spark, settings.zones_root, "users", date.today()).first()
    assert (envelope["run_id"], envelope["source"], envelope["record_count"]) == ("r1", "users", 2)
    raw = spark.read.json(f"{settings.zones_root}/raw/users")
    assert raw.count() == 2 and raw.filter(F.col("rec").contains("password")).count() == 0


def test_same_delivery_twice(spark, shop, deliver, settings):
    job.run(spark, settings, deliver(shop), run_id="r1")
    w = Warehouse(spark, settings.warehouse_root)
    before = {k: [tuple(r) for r in w.tables()[k].orderBy(k2).collect()] for k, k2 in
              (("dim_product", "product_key"), ("dim_customer", "customer_key"), ("fact_sales", "sales_key"))}
    out = job.run(spark, settings, deliver(shop), run_id="r2", full_refresh=True)
    for name in ("dim_date", "dim_customer", "dim_product", "fact_sales"):
        assert (out["loaded_counts"][name]["inserted"], out["loaded_counts"][name]["updated"]) == (0, 0)
    after = {k: [tuple(r) for r in w.tables()[k].orderBy(k2).collect()] for k, k2 in
             (("dim_product", "product_key"), ("dim_customer", "customer_key"), ("fact_sales", "sales_key"))}
    assert before == after
    assert w.runs().count() == 2


def test_changes_and_moved_day(spark, shop, deliver, settings):
    job.run(spark, settings, deliver(shop), run_id="r1")
    w = Warehouse(spark, settings.warehouse_root)
    keys = {(r["cart_id"], r["product_key"]): r["sales_key"] for r in w.tables()["fact_sales"].collect()}
    changed = copy.deepcopy(shop)
    changed["products"][0]["price"] = 120
    changed["carts"][0]["products"][0]["quantity"] = 10
    changed["carts"][1]["date"] = "2020-04-20T00:00:00Z"      # leaves March
    changed["carts"].append({"id": 4, "userId": 2, "date": "2020-04-01", "products": [{"productId": 2, "quantity": 3}]})
    out = job.run(spark, settings, deliver(changed), run_id="r2", full_refresh=True)
    assert out["loaded_counts"]["dim_product"] == {"staged": 3, "inserted": 0, "updated": 1, "unchanged": 2}
    assert out["loaded_counts"]["fact_sales"] == {"staged": 6, "inserted": 1, "updated": 3, "unchanged": 2}
    t = w.tables()
    fact = {(r["cart_id"], r["product_key"]): r for r in t["fact_sales"].collect()}
    assert len(fact) == t["fact_sales"].count() == 6
    assert all(fact[k]["sales_key"] == v for k, v in keys.items())
    assert fact[(1, 1)]["quantity"] == 10 and float(fact[(1, 1)]["line_total"]) == 1200.0
    assert fact[(2, 3)]["month"] == 202004
    assert w.watermark() == "2020-04-20"


def test_incremental_looks_back(spark, shop, deliver, settings):
    job.run(spark, settings, deliver(shop), run_id="r1")
    late = copy.deepcopy(shop)
    late["carts"][0]["products"][0]["quantity"] = 9          # 2020-03-02: before the look-back
    late["carts"][2]["products"][0]["quantity"] = 2          # 2020-03-10: within it
    out = job.run(spark, settings, deliver(late), run_id="r2", today=date(2020, 3, 11))
    assert out["extracted_counts"]["carts"] == 1
    assert out["loaded_counts"]["fact_sales"] == {"staged": 2, "inserted": 0, "updated": 1, "unchanged": 1}
    assert Warehouse(spark, settings.warehouse_root).tables()["fact_sales"].count() == 5


def test_failed_gate_publishes_nothing(spark, shop, deliver, settings):
    bad = copy.deepcopy(shop)
    for p in bad["products"]:
        p["price"] = -1
    with pytest.raises(QualityError):
        job.run(spark, settings, deliver(bad), run_id="r1")
    w = Warehouse(spark, settings.warehouse_root)
    assert w.manifest()["run_id"] is None and w.tables()["fact_sales"].count() == 0
    assert w.runs().first()["status"] == "FAILED"
    assert w.tables()["data_quality_results"].filter("status = 'FAIL'").count() > 0
    job.run(spark, settings, deliver(shop), run_id="r2")
    with pytest.raises(QualityError):
        job.run(spark, settings, deliver(bad), run_id="r3")
    assert w.manifest()["run_id"] == "r2" and w.tables()["fact_sales"].count() == 5


def test_failed_checks_may_be_let_through(spark, shop, deliver, settings):
    for p in shop["products"]:
        p["price"] = -1
    out = job.run(spark, replace(settings, fail_on_quality_error=False), deliver(shop), run_id="r1")
    assert out["status"] == "SUCCESS" and out["quality"]["FAIL"] == 2
    t = Warehouse(spark, settings.warehouse_root).tables()
    assert t["fact_sales"].count() == t["dim_product"].count() == 0 and t["dim_customer"].count() == 2


def test_price_that_rounds_to_nothing_breaks_the_load(spark, shop, deliver, settings):
    shop["products"][0]["price"] = 0.004
    with pytest.raises(Exception, match="price > 0"):
        job.run(spark, settings, deliver(shop), run_id="r1")
    assert Warehouse(spark, settings.warehouse_root).manifest()["run_id"] is None


def test_cities_in_order_of_revenue(spark):
    customers = spark.range(400).select(F.col("id").alias("customer_key"), F.concat(F.lit("c"), F.col("id") % 90).alias("city"))
    fact = spark.range(3000).select((F.col("id") * 7 % 400).alias("customer_key"),
                                    (F.col("id") % 13 + 1).cast("decimal(12,2)").alias("line_total"))
    t = {"dim_customer": customers, "fact_sales": fact}
    cities = {}
    for i in range(3000):
        c = f"c{i * 7 % 400 % 90}"
        cities[c] = cities.get(c, 0) + i % 13 + 1
    order = sorted(cities, key=lambda c: (-cities[c], c))
    so_far = [sum(cities[c] for c in order[:i + 1]) for i in range(90)]
    got = analytics.city_pareto(t).collect()
    assert [(r["city"], float(r["revenue"])) for r in got] == [(c, cities[c]) for c in order]
    assert [r["city_rank"] for r in got] == [1 + sum(v > cities[c] for v in cities.values()) for c in order]
    assert all(abs(float(r["cumulative_pct_of_revenue"]) - 100 * s / so_far[-1]) < 0.006 for r, s in zip(got, so_far))


def test_undated_and_unreadable_carts_reach_quarantine_in_an_incremental_run(spark, shop, deliver, settings):
    job.run(spark, settings, deliver(shop), run_id="r1")
    shop["carts"] += ['"junk"', '{"id": 8, "userId": 1, "password": "hunter2"', {"id": 9, "userId": 1, "date": "yesterday", "products": [{"productId": 1, "quantity": 1}]},
                      {"id": 10, "userId": 1, "products": [{"productId": 1, "quantity": 1}]}]
    kept = replace(settings, max_reject_ratio=1.0)
    out = job.run(spark, kept, deliver(shop), run_id="r2", today=date(2020, 3, 11))
    assert out["extracted_counts"]["carts"] == 5 and out["rejected_counts"]["carts"] == 4
    texts = [r["raw_record"] for r in zones.read_rejected(spark, settings.zones_root, "r2").collect()]
    assert len(texts) == 4 and not any("hunter2" in t for t in texts)


def test_constraints_stop_a_run(spark, shop, deliver, settings, monkeypatch):
    from starmart.plans import load as loading
    keep = loading.assign_keys
    monkeypatch.setattr(loading, "assign_keys", lambda df, natural, key, last: keep(df, natural, key, last).withColumn(
        key, F.lit(1).cast("long") if key == "product_key" and natural == ["product_id"] else F.col(key)))
    with pytest.raises(Exception, match="unique product_key"):
        job.run(spark, replace(settings, fail_on_quality_error=False), deliver(shop), run_id="r1")
    assert Warehouse(spark, settings.warehouse_root).manifest()["run_id"] is None


def test_repeated_sale_lines_are_loaded_once(spark, shop, deliver, settings):
    from starmart.operators import star, validate
    from starmart.plans.load import Load
    frames = star.build_all({k: v.valid for k, v in validate.validate_all(deliver(shop)).items()})
    frames["fact_sales"] = frames["fact_sales"].unionByName(frames["fact_sales"])
    load = Load(Warehouse(spark, settings.warehouse_root), "r1")
    load.all(frames)
    assert load.counts["fact_sales"] == {"staged": 5, "inserted": 5, "updated": 0, "unchanged": 0}
    assert load.tables()["fact_sales"].count() == 5


def test_lost_manifests_are_noticed(spark, shop, deliver, settings):
    job.run(spark, settings, deliver(shop), run_id="r1")
    w = Warehouse(spark, settings.warehouse_root)
    here = w.root
    for f in os.listdir(f"{here}/manifests"):
        os.rename(f"{here}/manifests/{f}", f"{here}/{f}.away")
    with pytest.raises(ManifestLost):
        w.manifest()


def test_failing_records_do_not_hide_the_error(spark, shop, deliver, settings, monkeypatch):
    append, seen = Warehouse.append, []

    def failing(self, name, rows):
        seen.append(name)
        if len(seen) > 1:
            raise OSError("log folder is gone")
        append(self, name, rows)

    monkeypatch.setattr(Warehouse, "append", failing)
    shop["products"][0]["price"] = 0.004
    with pytest.warns(RuntimeWarning), pytest.raises(Exception, match="price > 0"):
        job.run(spark, settings, deliver(shop), run_id="r1")


def test_publish_refuses_to_overtake(spark, settings):
    w = Warehouse(spark, settings.warehouse_root)
    m = w.manifest()
    w.publish(m | {"run_id": "a"})
    with pytest.raises(PublishConflict):
        w.publish(m | {"run_id": "b"})
    assert w.manifest()["run_id"] == "a"
