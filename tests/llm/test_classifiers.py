"""Quality and toxicity: accuracy on labels that were not learned from, and odd rows."""

import random

from starmart.llm import quality, toxicity


def sentences(pick, n):
    return " ".join(pick.choice(["the", "river", "ran", "over", "stones", "and", "light", "fell", "on", "old", "houses", "by", "noon."]) for _ in range(n))


def shop(documents, spark, marked, clean, share=0.3, n=400):
    pick = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        is_marked = pick.random() < share
        text = sentences(pick, pick.randint(20, 80))
        rows.append((i, marked(text, pick) if is_marked else clean(text, pick), "s"))
        if i % 2 == 0:
            labels.append((i, int(is_marked)))
    return documents(*rows), labels, spark


def accuracy(rows, labels):
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 20
    return sum(a == b for a, b in held) / len(held)


def test_quality(documents, spark):
    docs, labels, _ = shop(documents, spark, lambda t, p: t.upper().replace(" ", "!! "), lambda t, p: t)
    known = spark.createDataFrame([(i, 1 - m, 0) for i, m in labels], "doc_id long, quality int, toxic int")
    rows = quality.report(docs, known).collect()
    assert accuracy(rows, {i: 1 - m for i, m in labels}) > 0.95 and all(0 <= r.score <= 1 for r in rows)
    assert [(r.doc_id, r.score) for r in quality.report(docs, known).sort("doc_id").collect()] == sorted((r.doc_id, r.score) for r in rows)
    good = quality.good(docs, known)
    assert good.columns == docs.columns and good.count() == sum(r.predicted for r in rows)


def test_prior():
    import numpy as np
    pick = np.random.default_rng(0)
    p = pick.normal(0, 1, size=(3000, 2))
    u = np.concatenate([pick.normal(0, 1, size=(2100, 2)), pick.normal(4, 1, size=(900, 2))])
    pick.shuffle(u)
    one = lambda x: np.concatenate([x, np.ones((len(x), 1))], axis=1)
    assert abs(quality.prior(one(p), one(u)) - 0.7) < 0.06


def test_toxicity(documents, spark):
    bad = ["nastyword", "uglyterm", "foulness"]
    docs, labels, _ = shop(documents, spark, lambda t, p: f"{t} {p.choice(bad)} {t[:30]} {p.choice(bad)}", lambda t, p: t)
    known = spark.createDataFrame([(i, 1, m) for i, m in labels], "doc_id long, quality int, toxic int")
    rows = toxicity.report(docs, known).collect()
    assert accuracy(rows, dict(labels)) > 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_the_same_model_however_rows_are_dealt(documents, spark):
    """Other partitions, another order, and ids with several texts: the scores stay."""
    docs, labels, _ = shop(documents, spark, lambda t, p: f"{t} {p.choice(['nastyword', 'foulness'])}", lambda t, p: t, n=150)
    twice = docs.unionByName(docs.where("doc_id % 5 = 0").selectExpr("doc_id", "concat(text, ' again') AS text", *docs.columns[2:]))
    known = spark.createDataFrame([(i, 1 - m, m) for i, m in labels], "doc_id long, quality int, toxic int")
    for report in (quality.report, toxicity.report):
        want = sorted(map(tuple, report(twice.coalesce(1), known).collect()))
        assert want == sorted(map(tuple, report(twice.orderBy("n_chars").repartition(7), known.repartition(3)).collect()))


def test_odd_rows(odd, spark):
    known = spark.createDataFrame([(4, 1, 0), (4, 1, 1), (5, 0, 1), (6, 1, 0), (7, 1, None), (8, 1, 0), (None, 1, 1), (99, 1, 1), (2, 1, 0)],
                                  "doc_id long, quality int, toxic int")
    for report in (quality.report, toxicity.report):
        rows = report(odd, known).collect()
        assert len(rows) == 12 and all(r.score is not None and 0 <= r.score <= 1 for r in rows)


def test_without_labels_or_rows(odd, documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in quality.report(odd, none).collect()} == {1}
    assert {r.predicted for r in toxicity.report(odd, none).collect()} == {0}
    assert quality.report(documents(), none).count() == toxicity.report(documents(), none).count() == 0
    only = spark.createDataFrame([(i, 1, 1) for i in range(9)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.report(odd, only).collect()} == {1}
