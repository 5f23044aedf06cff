"""Mixing: targets against a stepwise rule, rounding against its invariants."""

import random

import pytest
from pyspark.sql import functions as F

from starmart.llm import mixing
from conftest_llm import prose


def stepwise(sizes):
    """Share by weight; what is above a limit goes to the others, until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, out = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in out]
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    pick = random.Random(seed)
    sizes = {s: pick.choice([0, 5, 100, 3000, 10**6]) for s in ["a", "b", "B", "é", "zz", None, ""][:pick.randint(2, 7)]}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(stepwise(sizes))


def test_mix(documents):
    pick = random.Random(1)
    rows = [(i, prose(i, pick.choice([0, 1, 3, 20, 200])), pick.choice("aaaaaabcd")) for i in range(500)]
    docs = documents(*rows)
    out = mixing.mix(docs, group=7).collect()
    size = {i: len((t or "").split()) for i, t, _ in rows}
    assert {r.doc_id: r.size for r in out} == size
    for source in "abcd":
        mine = [r for r in out if r.source == source]
        share = mine[0].target / mine[0].source_size
        assert mine[0].source_size == sum(r.size for r in mine)
        assert all(r.copies in (int(share), int(share) + 1) and r.copies <= 2 for r in mine if r.size)
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= max(r.size for r in mine)
    again = mixing.mix(docs.repartition(7), group=7).collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in out}


def test_rounding_is_fair(spark):
    """Over many independent sources every unit is rounded up as often as its part says."""
    units = spark.range(9000).select(F.concat(F.lit("s"), (F.col("id") / 3).cast("int")).alias("source"), F.lit(3).cast("long").alias("n"),
                                     F.concat(F.lit("k"), F.col("id")).alias("key"), (F.col("id") % 3 * 10 + 5).alias("size"), F.lit(0.3).alias("part"),
                                     (F.col("id") % 3).alias("which"))
    up = mixing.settle(units.drop("which")).where("up").join(units, ["source", "key"]).groupBy("which").count().collect()
    assert all(abs(r["count"] / 3000 - 0.3) < 0.035 for r in up) and len(up) == 3


def test_word_count(spark):
    texts = [None, "", " ", "a", " a", "a ", "\t a\x0b\x0cb \r\n", "x y z", "a" * 9999, "a " * 9999]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", mixing.word_count(F.col("t")).alias("n")).sort("i").collect()
    assert [r.n for r in got] == [0, 0, 0, 1, 1, 1, 2, 2, 1, 9999]


def test_odd_rows(odd, documents):
    rows = mixing.report(odd).collect()
    assert len(rows) == 12 and len({r.taken for r in rows if r.doc_id == 4}) == 1
    assert all(r.taken == 0 for r in rows if r.size == 0) and all(r.taken <= 2 * r.size for r in rows)
    out = mixing.mixed(odd)
    assert out.columns == odd.columns and out.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in rows)
    assert mixing.report(documents()).count() == mixing.mixed(documents()).count() == 0
    assert [r.taken for r in mixing.report(documents((1, None, "a"), (2, " ", None))).collect()] == [0, 0]
