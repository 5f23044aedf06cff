"""Runs started by arriving files."""

from __future__ import annotations

import json

from starmart.plans import job
from starmart.plans.warehouse import Warehouse
from starmart.streaming.landing import load_arrivals


def test_each_file_is_loaded_once(spark, shop, tmp_path):
    for entity in ("products", "users"):
        (tmp_path / f"{entity}.json").write_text("\n".join(json.dumps(r) for r in shop[entity]))
    carts = tmp_path / "carts"
    carts.mkdir()
    settings = job.Settings(zones_root=f"{tmp_path}/zones", warehouse_root=f"{tmp_path}/warehouse")
    snapshots = {e: f"{tmp_path}/{e}.json" for e in ("products", "users")}

    def arrive(name, rows):
        (carts / name).write_text("\n".join(json.dumps(r) for r in rows))
        load_arrivals(spark, settings, snapshots, str(carts), f"{tmp_path}/seen").awaitTermination()

    arrive("a.json", shop["carts"][2:])
    arrive("b.json", shop["carts"][:2])      # older days than the watermark, but a new file
    w = Warehouse(spark, settings.warehouse_root)
    assert w.tables()["fact_sales"].count() == 5 and w.runs().count() == 2
    load_arrivals(spark, settings, snapshots, str(carts), f"{tmp_path}/seen").awaitTermination()
    assert w.runs().count() == 2 and w.watermark() == "2020-03-10"
