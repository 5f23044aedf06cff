"""Validation rules on small deliveries."""

from __future__ import annotations

import copy
import json

import pytest
from deliveries import records
from pyspark.sql import functions as F

from starmart.operators import validate
from starmart.rules import ENTITY_KEYS
from starmart.functions.values import iso_timestamp


def rejects(checked):
    return {(r["raw_record"], r["reject_reason"]) for r in checked.rejected.collect()}


def reasons(checked):
    return sorted(r["reject_reason"] for r in checked.rejected.collect())


def check(spark, entity, rows):
    return validate.validate_entity(records(spark, rows), entity)


def test_clean_delivery_passes(spark, shop, deliver):
    out = validate.validate_all(deliver(shop))
    got = {r["entity"]: tuple(r)[1:] for r in validate.union_counts(out).collect()}
    assert got == {"products": (3, 3, 0, 0.0), "users": (2, 2, 0, 0.0), "carts": (3, 3, 0, 0.0), "cart_items": (5, 5, 0, 0.0)}


@pytest.mark.parametrize("change, wanted", [
    ({"title": None}, "missing_required:title"),
    ({"title": {"a": 1}}, "missing_required:title"),
    ({"title": "\u2003\t "}, "missing_required:title"),
    ({"title": 5}, "invalid_type:title(expected str)"),
    ({"price": None, "category": "  "}, "missing_required:price; missing_required:category"),
    ({"price": "n/a", "id": "abc"}, "invalid_type:id(expected int); invalid_type:price(expected float)"),
    ({"price": True}, "invalid_type:price(expected float)"),
    ({"price": "1d"}, "invalid_type:price(expected float)"),
    ({"price": "inf"}, "invalid_type:price(expected float)"),
    ({"price": []}, "missing_required:price"),
    ({"price": [1]}, "invalid_type:price(expected float)"),
    ({"price": -5}, "out_of_range:price(must be > 0)"),
    ({"rating": {"rate": 7, "count": 2.5}}, "out_of_range:rating_rate(must be <= 5); invalid_type:rating_count(expected int)"),
    ({"rating": {"rate": -0.1, "count": -1}}, "out_of_range:rating_rate(must be >= 0); out_of_range:rating_count(must be >= 0)"),
    ({"id": 2.5}, "invalid_type:id(expected int)"),
    ({"id": 0}, "out_of_range:id(must be > 0)"),
    ({"id": "99999999999999999999"}, "invalid_type:id(expected int)"),
])
def test_product_rules(spark, shop, change, wanted):
    out = check(spark, "products", [shop["products"][0] | change, shop["products"][1]])
    assert reasons(out) == [wanted] and out.valid.count() == 1


@pytest.mark.parametrize("change", [
    {"price": "19.99"}, {"price": " 7 "}, {"price": "1e3"}, {"id": 5.0}, {"id": "7"}, {"id": "1e3"},
    {"rating": {}}, {"rating": None}, {"description": None}, {"image": ""},
])
def test_accepted_products(spark, shop, change):
    out = check(spark, "products", [shop["products"][0] | change])
    assert reasons(out) == [] and out.valid.count() == 1


def test_first_record_wins_and_failed_ones_hold_no_key(spark, shop):
    p = shop["products"][0]
    out = check(spark, "products", [p | {"price": -1}, p | {"title": "second"}, p | {"id": "1", "title": "third"}])
    assert reasons(out) == ["duplicate_key:id", "out_of_range:price(must be > 0)"]
    assert [r["title"] for r in out.valid.collect()] == ["second"]


def test_records_that_are_no_objects(spark, shop):
    out = check(spark, "products", [shop["products"][0], '"junk"', "42", "null", "[1]", "{broken"])
    assert reasons(out) == ["record_not_an_object"] * 5
    assert {r for r, _ in rejects(out)} == {'"junk"', "42", "null", "[1]", "{broken"}


def test_user_rules(spark, shop):
    u = shop["users"][0]
    far = copy.deepcopy(u)
    far["address"]["geolocation"] = {"lat": "90.5", "long": "-181"}
    far["address"]["number"] = "12a"
    out = check(spark, "users", [u | {"id": 11, "email": "nope"}, u | {"id": 12, "email": " a@b.co "},
                                 u | {"id": 13, "email": "a b@c.d"}, far | {"id": 14}, u | {"id": 15, "name": {}}])
    assert reasons(out) == sorted([
        "invalid_format:email", "invalid_format:email",
        "invalid_type:address_number(expected int); out_of_range:address_geolocation_lat(must be <= 90); "
        "out_of_range:address_geolocation_long(must be >= -180)",
        "missing_required:name_firstname; missing_required:name_lastname",
    ])


def test_cart_rules(spark, shop):
    c = shop["carts"][0]
    out = check(spark, "carts", [c | {"id": 11, "products": []}, c | {"id": 12, "date": "yesterday"},
                                 c | {"id": 13, "products": "x"}, c | {"id": 14, "date": 20200302}, c | {"id": 15, "products": [None]}])
    assert reasons(out) == ["invalid_type:date(expected datetime)", "invalid_type:products(expected list)", "missing_required:products"]


def test_lines(spark, shop, deliver):
    shop["carts"][0]["products"] += [
        {"productId": 1, "quantity": 9}, "oops", {"productId": 3, "quantity": 0}, {"productId": 999, "quantity": 1},
        {"productId": 3, "quantity": "two"}, {"quantity": 1}, {"productId": 3, "quantity": 2},
    ]
    shop["carts"][1]["userId"] = 77
    shop["carts"].append({"id": 8, "userId": 78, "date": "2020-03-05", "products": [{"productId": 998, "quantity": 1}]})
    out = validate.validate_all(deliver(shop))["cart_items"]
    assert reasons(out) == sorted([
        "duplicate_key:cart_id+product_id", "missing_required:product_id; missing_required:quantity",
        "out_of_range:quantity(must be > 0)", "orphan_reference:product_id", "invalid_type:quantity(expected int)",
        "missing_required:product_id", "orphan_reference:user_id", "orphan_reference:user_id; orphan_reference:product_id",
    ])
    assert out.input_count == 13 and out.valid.count() == 5
    raw = [json.loads(r) for r, why in rejects(out) if why.startswith("missing_required:product_id; ")]
    assert raw == [{"cart_id": 1, "line": "oops", "order_date": "2020-03-02T00:00:00.000Z", "user_id": 1}]


def test_rejected_cart_hides_its_lines(spark, shop, deliver):
    shop["carts"][0]["date"] = "yesterday"
    out = validate.validate_all(deliver(shop))
    assert out["carts"].rejected.count() == 1 and out["cart_items"].input_count == 3


def test_rejected_product_orphans_its_lines(spark, shop, deliver):
    shop["products"][0]["price"] = -1
    out = validate.validate_all(deliver(shop))["cart_items"]
    assert reasons(out) == ["orphan_reference:product_id"] * 2


def test_empty_delivery(spark, shop, deliver):
    shop["carts"] = []
    out = validate.validate_all(deliver(shop))
    got = {r["entity"]: tuple(r)[1:] for r in validate.union_counts(out).collect()}
    assert got["carts"] == (0, 0, 0, 0.0) and got["cart_items"] == (0, 0, 0, 0.0)


def test_hot_key_keeps_the_first_only(spark):
    """Half of all rows repeat one key."""
    rows = spark.range(20_000).select(
        F.col("id").alias("pos"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("id"),
        F.lit("").alias("reasons"))
    out = validate.reject_repeats(rows, "products", "pos").filter("reasons <> ''")
    # pos 7 carries key 7 as well, but pos 0 came first
    assert out.count() == 10_000 and out.filter("pos = 0").count() == 0 and ENTITY_KEYS["products"] == ["id"]


@pytest.mark.parametrize("text, wanted", [
    ("20200302", "2020-03-02 00:00:00"), ("2020-03", "2020-03-01 00:00:00"), ("2020-3-2", "2020-03-02 00:00:00"),
    ("2020-03-02 10:00+05:30", "2020-03-02 04:30:00"), ("2020-03-02T23:30:00-05:00", "2020-03-03 04:30:00"),
    ("2020-03-02T10:00:00.5Z", "2020-03-02 10:00:00.5"), ("2020", "2020-01-01 00:00:00"),
    ("03/02/2020", None), ("1583107200", None), ("2020-W10-1", None), (" 2020-03-02", None), ("2020-13-02", None),
    ("now", None), ("today", None), ("2020-03-02 10:00:00 Europe/Paris", None), ("1500-01-01", None), ("", None),
])
def test_time_stamps(spark, text, wanted):
    got = spark.createDataFrame([(text,)], "t STRING").select(iso_timestamp(F.col("t")).cast("string")).first()[0]
    assert got == wanted
