"""Star frames, cleaning, sources, zones, checks."""

from __future__ import annotations

import json
import random
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse
from datetime import date
from decimal import Decimal

import pytest
from deliveries import records
from pyspark.sql import Row, functions as F

from starmart.functions import text, values
from starmart.operators import star, validate
from starmart.operators.pairs import pair_counts, top_pairs
from starmart.operators.position import tile, with_position
from starmart.plans import checks
from starmart.plans.aggregates import ratio
from starmart.session import materialize, scratch_scope
from starmart.schemas import FRAME_COLUMNS, FRAMES, empty
from starmart.sources import records as src
from starmart.sources import zones


@pytest.fixture
def frames(shop, deliver):
    return star.build_all({n: c.valid for n, c in validate.validate_all(deliver(shop)).items()})


def test_frames_of_a_clean_delivery(frames):
    assert {n: f.columns for n, f in frames.items()} == FRAME_COLUMNS
    product = frames["dim_product"].orderBy("product_id").first()
    assert (product["title"], product["category"], product["category_display"], product["price"], product["price_tier"],
            product["rating_band"]) == ("Walking Bag", "men's clothing", "Men's Clothing", Decimal("109.95"), "premium", "average")
    assert [r["price_tier"] for r in frames["dim_product"].orderBy("product_id").collect()] == ["premium", "budget", "standard"]
    user = frames["dim_customer"].orderBy("customer_id").first()
    assert (user["email"], user["username"], user["full_name"], user["city"], user["street_address"], user["email_domain"],
            user["latitude"]) == ("john.doe@gmail.com", "user1", "John Doe", "Green Hill", "7682 New Road", "gmail.com", -37.3159)
    days = frames["dim_date"].orderBy("date_key").collect()
    assert len(days) == 9 and days[0]["date_key"] == 20200302 and days[0]["day_of_week"] == 1
    assert [d["is_weekend"] for d in days] == [False] * 5 + [True, True] + [False] * 2
    assert (days[0]["week_of_year"], days[0]["month_name"], days[0]["day_name"], days[0]["year_month"]) == (10, "March", "Monday", "2020-03")


def test_empty_in_typed_empty_out(spark, shop, deliver):
    nothing = {k: [] for k in shop}
    valid = {n: c.valid for n, c in validate.validate_all(deliver(nothing)).items()}
    for name, frame in star.build_all(valid).items():
        assert frame.count() == 0
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in FRAMES[name]]


def test_lines_without_a_price_stop_the_run(spark, frames, shop, deliver):
    lines = validate.validate_all(deliver(shop))["cart_items"].valid.withColumn("product_id", F.lit(12345).cast("bigint"))
    with pytest.raises(star.MissingPrices):
        star.require_prices(star.build_sales(lines, frames["dim_product"]))


@pytest.mark.parametrize("given, wanted", [
    ("men's  foo-bar", "Men's Foo-bar"), ("  A\u00a0b\tC ", "A B C"), ("ÉCOLE élan", "École Élan"), ("", ""),
])
def test_title_case(spark, given, wanted):
    assert spark.createDataFrame([(given,)], "t STRING").select(text.title_case(F.col("t"))).first()[0] == wanted


def test_bands(spark):
    rows = spark.createDataFrame([(24.99, 4.5), (25.0, 4.4999), (99.99, 3.0), (100.0, 2.99), (1.0, None)], "p DOUBLE, r DOUBLE")
    got = rows.select(values.price_tier(F.col("p").cast("decimal(10,2)")), values.rating_band(F.col("r"))).collect()
    assert [tuple(r) for r in got] == [("budget", "excellent"), ("standard", "good"), ("standard", "average"),
                                       ("premium", "poor"), ("budget", "unrated")]


def test_ratio_rounds_half_up_exactly(spark):
    row = spark.createDataFrame([(Decimal("50449.95"), 6)], "a DECIMAL(12,2), n BIGINT").select(ratio(F.col("a"), F.col("n")))
    assert row.first()[0] == Decimal("8408.33")


# ---- sources and zones

def test_redaction_is_top_level_and_exact(spark):
    rows = [{"id": 1, "password": "x", "Password": "kept", "deep": {"password": "kept"}}, '"password"', {"n": 1.50}, '{"n": 1.50}']
    got = [r["rec"] for r in src.redact(records(spark, rows)).orderBy("pos").collect()]
    assert json.loads(got[0]) == {"id": 1, "Password": "kept", "deep": {"password": "kept"}}
    assert got[1:] == ['"password"', '{"n": 1.5}', '{"n": 1.50}']


def test_unreadable_records_keep_no_text(spark):
    got = src.redact(records(spark, ['{"id":1,"password":"hunter2"', "hunter2"])).collect()
    assert all("hunter2" not in r["rec"] and json.loads(r["rec"]).startswith("unreadable: ") for r in got)
    assert got[0]["rec"] != got[1]["rec"]


def test_undated_carts_are_kept(spark):
    rows = records(spark, [{"date": "2020-03-09"}, {"date": "2020-03-01"}, {"date": "yesterday"}, {"id": 1}, '"junk"', {"date": "2031-01-01"}])
    assert sorted(r["pos"] for r in src.carts_since(rows, date(2020, 3, 9), date(2020, 3, 10)).collect()) == [0, 2, 3, 4]


def test_json_lines_keep_their_order(spark, tmp_path):
    for f in range(3):
        (tmp_path / f"part-{f}.json").write_text("\n".join(json.dumps({"id": f * 100 + i}) for i in range(50)) + "\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        rows = src.read_json_lines(spark, str(tmp_path)).orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [json.loads(r["rec"])["id"] for r in rows] == [f * 100 + i for f in range(3) for i in range(50)]
    assert len({r["pos"] for r in rows}) == 150


def test_json_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1.50}, "junk",\n null]')
    (tmp_path / "b.json").write_text(' [{"id":2}]\n')
    (tmp_path / "d.json").write_text("[]")
    (tmp_path / "e.json").write_text('[ [1, {"a": [2, "x]}"]}, 3], {} , "a}b,{", -1, [],\n{"q": "\\\\\\"}", "r": {"s": {}}},true ]')
    got = [r["rec"] for r in src.read_json_arrays(spark, str(tmp_path)).orderBy("pos").collect()]
    assert got == ['{"id": 1.50}', '"junk"', "null", '{"id":2}', '[1, {"a": [2, "x]}"]}, 3]', "{}", '"a}b,{"', "-1", "[]",
                   '{"q": "\\\\\\"}", "r": {"s": {}}}', "true"]


@pytest.mark.parametrize("text", ['{"error": 1}', "", "  ", "nope", '[{"a": 1}', '[{"a": 1}}', '[{"a": {"b": 1}]', '"[1]"'])
def test_what_is_no_array_is_refused(spark, tmp_path, text):
    (tmp_path / "a.json").write_text('[{"id": 1}]')
    (tmp_path / "c.json").write_text(text)
    with pytest.raises(src.SourceError, match="c.json"):
        src.read_json_arrays(spark, str(tmp_path))


@pytest.mark.parametrize("seed,bytes_per_split", [(1, 150), (2, 397)])
def test_json_arrays_over_many_tasks(spark, tmp_path, seed, bytes_per_split):
    """Splits anywhere, also within strings, numbers, and records longer than several splits."""
    pick = random.Random(seed)

    def value(depth):
        kind = pick.randrange(8 if depth < 3 else 4)
        if kind < 2:
            return pick.choice(["109.950", "1e3", "null", "true", "-0.0"])
        if kind < 4:
            return json.dumps("".join(pick.choice('a}{][",:\\ é\n') for _ in range(pick.randint(0, 12))), ensure_ascii=pick.random() < 0.5)
        if kind < 6:
            return "[" + pick.choice([",", " , "]).join(value(depth + 1) for _ in range(pick.randint(0, 4))) + "]"
        return "{" + ",".join(f'"k{i}"{pick.choice([":", " : "])}{value(depth + 1)}' for i in range(pick.randint(0, 4))) + "}"

    texts = []
    for name in ("a", "b"):
        here = [value(0) if pick.random() < 0.3 else '{"id": %d, "v": %s}' % (i, value(1)) for i in range(30)]
        (tmp_path / f"{name}.json").write_text("[" + pick.choice([",", ",\n ", " ,"]).join(here) + "]\n", encoding="utf-8")
        texts += here
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(bytes_per_split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = src.read_json_arrays(spark, str(tmp_path)).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["rec"] for r in got] == texts and len({r["pos"] for r in got}) == len(texts)


def test_empty_sources():
    src.require_records(0, "carts")
    with pytest.raises(src.SourceError):
        src.require_records(0, "products")


def test_since_day():
    assert src.since_day(date(2020, 3, 10), 1, False) == date(2020, 3, 9)
    assert src.since_day(date(2020, 3, 10), 1, True) is None and src.since_day(None, 1, False) is None


def test_landed_carts_are_read_by_day(spark, tmp_path):
    """Two deliveries; the second one's positions come later. Only wanted days and the undated folder are opened."""
    rows = [{"id": 1, "date": "2020-03-01T00:00:00Z"}, {"id": 2, "date": "2020-03-02T23:30:00-05:00"}, {"id": 3}, '"junk"']
    src.land(records(spark, rows), str(tmp_path), "carts")
    src.land(records(spark, [{"id": 4, "date": "2020-03-05"}, {"id": 5, "date": "2020-02-01"}]), str(tmp_path), "carts", start=100)
    carts = src.landed(spark, str(tmp_path), "carts")
    got = src.carts_since(carts, date(2020, 3, 2), date(2020, 3, 5))
    assert sorted(r["pos"] for r in got.collect()) == [1, 2, 3, 100]
    assert sorted(r["pos"] for r in src.carts_since(carts, None, date(2020, 3, 5)).collect()) == [0, 1, 2, 3, 100, 101]
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "day" in filters and "undated" in filters


def test_zone_layout(spark, tmp_path):
    assert zones.zone_path("s3a://bucket/pre/", "raw", "users", date(2024, 1, 2)) == "s3a://bucket/pre/raw/users/dt=2024-01-02"
    with pytest.raises(ValueError):
        zones.zone_path("x", "other")
    rejected = spark.createDataFrame([("users", "why", "{}")], "entity STRING, reject_reason STRING, raw_record STRING")
    zones.write_rejected(rejected, str(tmp_path), "r1", date(2024, 1, 2))
    assert sorted(p.name for p in (tmp_path / "rejected").iterdir() if p.is_dir()) == ["entity=users"]
    assert zones.read_rejected(spark, str(tmp_path), "r1").first() == Row(
        run_id="r1", entity="users", reject_reason="why", raw_record="{}", dt=date(2024, 1, 2))


@pytest.mark.parametrize("form", ["parquet", "csv"])
def test_processed_zone(spark, tmp_path, frames, form):
    zones.write_processed(frames, str(tmp_path), "r1", date(2024, 1, 2), form)
    for name, frame in frames.items():
        back = zones.read_processed(spark, str(tmp_path), name, "r1", date(2024, 1, 2), form)
        assert back.count() == frame.count() and back.columns == FRAME_COLUMNS[name]


# ---- order and pairs

@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 10, 1001])
def test_tiles_equal_the_window_function(spark, n):
    rows = spark.range(n).select("id", (F.col("id") * 37 % 11).alias("v"))
    placed = with_position(rows, [F.desc("v"), F.col("id")], "at", "n")
    got = {r["id"]: r["t"] for r in placed.select("id", tile(F.col("at"), F.col("n"), 4).alias("t")).collect()}
    rows.createOrReplaceTempView("tile_rows")
    want = {r["id"]: r["t"] for r in spark.sql("SELECT id, ntile(4) OVER (ORDER BY v DESC, id) AS t FROM tile_rows").collect()}
    assert got == want


def test_running_sums_equal_the_window_function(spark):
    rows = spark.range(500).select("id", (F.col("id") * 37 % 11).alias("v")).repartition(8)
    got = with_position(rows, [F.desc("v"), F.col("id")], "at", running=("v", "s"))
    rows.createOrReplaceTempView("sum_rows")
    want = spark.sql("SELECT id, v, row_number() OVER (ORDER BY v DESC, id) AS at, sum(v) OVER (ORDER BY v DESC, id) AS s FROM sum_rows")
    assert {tuple(r) for r in got.select("id", "v", "at", "s").collect()} == {tuple(r) for r in want.collect()}


def test_scratch_goes_away(spark):
    with scratch_scope(spark, "t"):
        path = Path(urlparse(materialize(spark.range(3), "x").inputFiles()[0]).path).parent
        assert path.exists()
    assert not path.exists()


def some_carts(spark):
    """A cart with a third of all lines among small ones; titles that several products share."""
    hot = spark.range(300).select(F.lit(1).alias("cart_id"), F.col("id").alias("product_id"))
    rest = spark.range(600).select((F.col("id") % 90 + 2).cast("int").alias("cart_id"), (F.col("id") * F.col("id") * 7 % 300).alias("product_id"))
    return hot.unionByName(rest).distinct().withColumn("title", F.concat(F.lit("t"), F.col("product_id") % 23))


def listed_pairs(lines):
    carts, pairs = {}, Counter()
    for r in lines.collect():
        carts.setdefault(r["cart_id"], []).append((r["product_id"], r["title"]))
    for cart in carts.values():
        pairs.update((a[1], b[1]) for a in cart for b in cart if a[0] < b[0])
    return pairs


def test_large_carts_count_like_small_ones(spark):
    """Dividing a cart equals listing its pairs, wherever the division ends."""
    lines = some_carts(spark)
    want = {(*pair, n) for pair, n in listed_pairs(lines).items()}
    for leaf_lines in (10_000, 64, 1):
        assert want == {tuple(r) for r in pair_counts(lines, leaf_lines).collect()}


@pytest.mark.parametrize("frequent,k", [(2, 10), (5, 10), (23, 10), (256, 3), (3, 1000)])
def test_top_pairs_equal_all_pairs_sorted(spark, frequent, k):
    lines = some_carts(spark)
    want = sorted(((*pair, n) for pair, n in listed_pairs(lines).items()), key=lambda p: (-p[2], p[0], p[1]))[:k]
    products = lines.select("product_id", "title").distinct()
    assert [tuple(r) for r in top_pairs(lines.drop("title"), products, k, frequent=frequent).collect()] == want


def test_top_pairs_make_few_of_many(spark):
    """One pair in every cart among titles that occur once: only the titles that can reach its count are kept, and no job runs before the result
    is asked for."""
    carts = spark.range(200)
    common = carts.select(F.col("id").alias("cart_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("product_id"))
    rare = carts.select(F.col("id").alias("cart_id"), F.explode(F.sequence(F.col("id") * 5 + 10, F.col("id") * 5 + 14)).alias("product_id"))
    lines = common.unionByName(rare)
    products = spark.range(2000).select(F.col("id").alias("product_id"), F.format_string("p%04d", "id").alias("title"))
    spark.sparkContext.setJobGroup("pairs", "building")
    got = top_pairs(lines, products, 1, frequent=4)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("pairs")) == []
    assert [tuple(r) for r in got.collect()] == [("p0001", "p0002", 200)]
    spark.sparkContext.setJobGroup("other", "")


# ---- checks

def counts(spark, *rows):
    return spark.createDataFrame(list(rows), "entity STRING, input_count BIGINT, valid_count BIGINT, rejected_count BIGINT, reject_ratio DOUBLE")


def test_lost_rows_fail(spark):
    got = checks.record_counts(counts(spark, ("users", 10, 7, 2, 0.2), ("carts", 10, 8, 2, 0.2))).collect()
    assert [(r["entity"], r["status"], r["expected"], r["actual"], r["details"]) for r in got] == [
        ("users", "FAIL", "10", "9", "valid=7 rejected=2"), ("carts", "PASS", "10", "10", "valid=8 rejected=2")]


def test_reject_ratio_limit(spark):
    got = checks.reject_ratio(counts(spark, ("users", 10, 7, 3, 0.3), ("carts", 100, 69, 31, 0.31)), 0.30).collect()
    assert [(r["status"], r["expected"], r["actual"]) for r in got] == [("PASS", "<= 30%", "30.0%"), ("FAIL", "<= 30%", "31.0%")]


def test_keys_and_schema(spark, frames):
    fact = frames["fact_sales"]
    broken = frames | {"fact_sales": fact.unionByName(fact.limit(1)).unionByName(fact.limit(1).withColumn("cart_id", F.lit(None).cast("bigint"))),
                       "dim_date": frames["dim_date"].drop("day_name")}
    found = {(r["check_name"], r["entity"]): (r["status"], r["actual"]) for r in checks.frame_keys(broken).collect()}
    assert found[("null_keys", "fact_sales")] == ("FAIL", "1") and found[("duplicate_keys", "fact_sales")] == ("FAIL", "1")
    assert found[("null_keys", "dim_product")] == ("PASS", "0") and len(found) == 8
    schemas = {r["entity"]: r["status"] for r in checks.frame_schemas(broken).collect()}
    assert schemas == {"dim_date": "FAIL", "dim_customer": "PASS", "dim_product": "PASS", "fact_sales": "PASS"}


def test_checks_of_empty_frames_pass(spark):
    nothing = {n: empty(spark, s) for n, s in FRAMES.items()}
    assert {r["status"] for r in checks.frame_keys(nothing).collect()} == {"PASS"}


def test_severity_and_summary(spark):
    row = spark.range(1).select(F.inline(F.array(checks._check("c", "e", F.lit(False), 0, 1, severity="warning"),
                                                 checks._check("c", "e", F.lit(True), 0, 0),
                                                 checks._check("c", "e", F.lit(False), 0, 1))))
    assert {r["status"]: r["checks"] for r in checks.summary(row).collect()} == {"PASS": 1, "WARN": 1, "FAIL": 1}
