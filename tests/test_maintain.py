"""Batch after batch: aggregates and month states kept from changes equal those made from the whole fact."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators import star
from starmart.plans import checks, constraints, months
from starmart.plans.aggregates import AGGREGATES, product_totals
from starmart.plans.load import Load
from starmart.plans.warehouse import Warehouse
from starmart.schemas import FRAMES, conform
from starmart.session import materialize


def frames(spark, categories, sales):
    """categories: product id -> category; sales: (cart, customer, product) -> (day, quantity, price)."""
    products = [(p, f"t{p}", c, c.title(), "", "", Decimal("5.00"), "budget", None, None, "unrated") for p, c in categories.items()]
    people = [(c, f"{c}@x.org", f"u{c}", "A", "B", "A B", "", "Town", "", "", None, None, "x.org") for c in range(1, 9)]
    lines = [(cart, customer, product, int(day.strftime("%Y%m%d")), day, n, Decimal(price), n * Decimal(price))
             for (cart, customer, product), (day, n, price) in sales.items()]
    fact = spark.createDataFrame(lines, FRAMES["fact_sales"])
    return {
        "dim_product": spark.createDataFrame(products, FRAMES["dim_product"]), "dim_customer": spark.createDataFrame(people, FRAMES["dim_customer"]),
        "dim_date": conform(star.build_calendar(fact), FRAMES["dim_date"]), "fact_sales": fact}


def load(spark, root, run_id, got):
    load = Load(Warehouse(spark, root), run_id)
    load.all(got)
    states = load.states()
    t, near = load.tables(), load.repeats_in()
    assert constraints.broken(load.written(), t, near, months.broken_rules(load.rewritten)) == []
    near = t["fact_sales"].limit(0) if near is None else near
    found = checks.after_load(spark, got, t, states, near).collect()
    assert len(found) == 22 and {r["status"] for r in found} == {"PASS"}
    load.publish()
    return load


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def same_as_rebuilt(spark, root):
    w = Warehouse(spark, root)
    t = {n: df for n, df in w.tables().items()}
    for name, build in AGGREGATES.items():
        assert rows(t[name]) == rows(build(t)), name
    m = w.manifest()
    assert rows(w.state(m, "state_product_sales")) == rows(conform(product_totals(t), w.state(m, "state_product_sales").schema))
    fresh = {str(r["month"]): r.asDict() | {"revenue": str(r["revenue"])} for r in months.month_states(t["fact_sales"], t).collect()}
    assert m["states"] == fresh


def random_sales(pick, carts, products):
    out = {}
    for cart in carts:
        customer, day = pick.randint(1, 8), date(2020, 1, 20) + timedelta(pick.randint(0, 60))
        for product in pick.sample(products, pick.randint(1, 4)):
            out[cart, customer, product] = (day, pick.randint(1, 5), f"{pick.randint(1, 900) / 100:.2f}")
    return out


@pytest.mark.parametrize("seed", [1])
def test_batches_of_changes(spark, tmp_path, seed):
    pick, root = random.Random(seed), str(tmp_path / "w")
    categories = {p: pick.choice(["a", "b", "c"]) for p in range(1, 13)}
    sales = random_sales(pick, range(100, 140), list(categories))
    load(spark, root, "r0", frames(spark, categories, sales))
    same_as_rebuilt(spark, root)
    for step in range(1, 3):
        batch = {}
        carts = sorted({k[0] for k in sales})
        for cart in pick.sample(carts, 8):
            old = [(k, v) for k, v in sales.items() if k[0] == cart]
            customer = pick.choice([old[0][0][1], pick.randint(1, 8)])          # carts change hands, days, lines and prices
            day = old[0][1][0] + timedelta(pick.choice([0, 0, 35, -40]))
            for (_, _, product), (_, n, price) in old[:pick.randint(1, 4)]:
                batch[cart, customer, product] = (day, pick.choice([n, n + 1]), price)
        batch |= random_sales(pick, range(200 * step, 200 * step + 5), list(categories))
        if step != 2:
            categories[pick.randint(1, 12)] = pick.choice(["a", "d"])
            categories[20 + step] = "e"
        load(spark, root, f"r{step}", frames(spark, categories, batch))
        same_as_rebuilt(spark, root)
        # the table after the batch, line by line
        by_line = {(k[0], k[2]): (k[1], v) for k, v in sales.items()} | {(k[0], k[2]): (k[1], v) for k, v in batch.items()}
        sales = {(cart, customer, product): v for (cart, product), (customer, v) in by_line.items()}
        t = Warehouse(spark, root).tables()
        have = t["fact_sales"].join(t["dim_product"], "product_key").join(t["dim_customer"], "customer_key").select(
            "cart_id", "customer_id", "product_id", "date_key", "quantity").collect()
        assert sorted(map(tuple, have)) == sorted((*k, int(v[0].strftime("%Y%m%d")), v[1]) for k, v in sales.items())


def test_a_run_touches_what_its_batch_touches(spark, tmp_path):
    """One warehouse, run after run: nothing changed, one product changed, one day added, faults let through before."""
    root = str(tmp_path / "w")
    categories = {p: "a" for p in range(1, 10)}
    sales = {(c, 1 + c % 8, 1 + c % 9): (date(2020, 1, 1) + timedelta(c), 1, "2.00") for c in range(150)}
    first = frames(spark, categories, sales)
    load(spark, root, "r1", first)
    w = Warehouse(spark, root)
    before = w.manifest()
    load(spark, root, "r2", first)
    kept = {k: v for k, v in w.manifest().items() if k not in ("version", "run_id")}
    assert kept == {k: v for k, v in before.items() if k not in ("version", "run_id")}
    assert not list((tmp_path / "w").glob("data/*/run=r2"))

    load(spark, root, "r3", frames(spark, categories | {4: "b"}, sales))
    folders = w.manifest()["buckets"]["dim_product"]
    assert sum("run=r3" in f for f in folders.values()) == 1
    same_as_rebuilt(spark, root)

    # carts of later days have higher ids, so no other month's folder is in the plans of the upsert and of the checks
    batch = {(c, 1, 1): (date(2020, 5, 29), 2, "2.00") for c in (149, 150, 151)}
    later = Load(w, "r4")
    later.all(frames(spark, categories | {4: "b"}, batch))
    for part in (later.near(later.before), later.repeats_in()):
        assert {f.split("month=")[1].split("/")[0] for f in part.inputFiles()} == {"202005"}
    later.states()
    assert [s["month"] for s in later.rewritten] == [202005]

    # a month that showed faults is looked at again, also if nothing in it changes
    m = w.manifest()
    m["states"]["202001"]["orphan_date_fk"] = 9
    w.publish(m)
    again = Load(w, "r5")
    again.all(frames(spark, categories | {4: "b"}, {k: v for k, v in sales.items() if k[0] == 140}))
    assert again.states().agg(F.sum("orphan_date_fk")).first()[0] == 0 and [s["month"] for s in again.rewritten] == [202001]


def test_references_are_met_in_one_scan(spark):
    fact = materialize(spark.range(50).selectExpr("id % 7 AS customer_key", "id % 5 AS product_key", "cast(20200101 + id % 3 AS int) AS date_key", "id AS cart_id"), "keys")
    t = {"fact_sales": fact, "dim_customer": spark.range(6).toDF("customer_key"), "dim_product": spark.range(5).toDF("product_key"),
         "dim_date": spark.range(20200101, 20200103).selectExpr("cast(id AS int) AS date_key")}
    found = checks.foreign_keys(t)
    assert {r["check_name"]: r["actual"] for r in found.collect()} == {"orphan_customer_fk": "7", "orphan_product_fk": "0", "orphan_date_fk": "16"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in line for line in plan.splitlines()) == 1 and plan.count("Join LeftAnti") == 1
