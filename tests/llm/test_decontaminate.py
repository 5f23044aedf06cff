"""Benchmark decontamination against a search of every window at every place."""

import hashlib
import random
import re

import pytest

from starmart.llm import decontaminate

LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(LETTERS, (text or "").translate({i: i + 32 for i in range(65, 91)}))


def plain(docs, items, window=10):
    patterns = set()
    for item, text in items:
        w = words(text)
        for at in range(max(len(w) - window, 0) + 1 if w else 0):
            patterns.add((str(item) if item is not None else "", tuple(w[at:at + window])))
    out = []
    for i, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, p in patterns:
            for at in range(len(w) - len(p) + 1):
                if tuple(w[at:at + len(p)]) == p:
                    hit |= set(range(at, at + len(p)))
                    ids.add(item)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def found(docs, items, **settings):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                   for r in decontaminate.report(docs, items, **settings).collect()), key=str)


def world(seed):
    pick = random.Random(seed)
    say = lambda n: " ".join(pick.choice("a b c d e f g".split()) for _ in range(n))
    items = [(i, say(pick.choice([1, 2, 5, 9, 10, 11, 30]) if i > 2 else 14).replace(" ", pick.choice([" ", ", ", "-", "\n"]))) for i in range(12)]
    docs = []
    for i in range(60):
        text = say(pick.choice([0, 3, 20, 60]))
        if i % 3 == 0:
            text += " x " + pick.choice(items)[1].upper() + " " + say(5)
        docs.append((i, text, "s"))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_against_every_place(documents, spark, seed):
    docs, items = world(seed)
    items = items[3:] if seed else [(i, t) for i, t in items if len(words(t)) > 4]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert found(documents(*docs), bench) == plain([d[:2] for d in docs], items)


def test_blocks_of_items(documents, spark):
    docs, items = world(9)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.find(documents(*docs), bench, block_bytes=60).select("doc_id", "n_hit", "items").collect()
    once = decontaminate.find(documents(*docs), bench).select("doc_id", "n_hit", "items").collect()
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, once), key=str)


def test_odd_rows(odd, documents, spark):
    items = [(7, None), (8, ""), (9, " .,! "), (None, "the same row twice"), (3, "two texts under"), (3, "two texts under"), (4, "É naïve")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain([(r.doc_id, r.text) for r in odd.collect()], items)
    assert found(odd, bench) == want
    left = decontaminate.clean(odd, bench)
    assert left.columns == odd.columns and left.count() == sum(not w[5] for w in want)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(odd, none).where("contaminated").count() == 0
    assert decontaminate.report(documents(), bench).count() == 0
