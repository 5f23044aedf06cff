"""The n-gram Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from starmart.llm import jaccard
from starmart.llm.components import components
from starmart.llm.jaccard import Rule
from conftest_llm import brute_components, shingle_set


def edited(text: str, edits: int, pick: random.Random) -> str:
    w = text.split()
    for _ in range(edits):
        w[pick.randrange(len(w))] = f"w{pick.randrange(10**9)}"
    return " ".join(w)


def corpus(seed: int):
    """Families of near copies with a shared passage in a third of all texts, short texts, exact copies."""
    pick = random.Random(seed)
    word = lambda: f"v{pick.randrange(400)}"
    passage = " ".join(word() for _ in range(40))
    rows = []
    for family in range(12):
        base = " ".join(word() for _ in range(pick.choice([4, 9, 30, 120])))
        if family % 3 == 0:
            base = f"{base} {passage}"
        rows += [edited(base, pick.choice([0, 0, 1, 1, 2, 3]), pick) for _ in range(pick.choice([1, 2, 6, 40]))]
    pick.shuffle(rows)
    return [(10 + 3 * i, t, "s") for i, t in enumerate(rows)]


@pytest.mark.parametrize("rule", [Rule(3, 90, 100), Rule(5, 80, 100), Rule(1, 50, 100)])
def test_against_all_pairs(documents, rule):
    rows = corpus(rule.k)
    sets = {i: shingle_set(t, rule.k) for i, t, _ in rows}
    want = brute_components(sets, lambda a, b: rule.den * len(a & b) >= rule.num * len(a | b) and a and b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.report(documents(*rows), rule).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_large_group_of_near_copies(documents):
    """Every copy differs from every other one; only neighbours in a chain are close enough."""
    w = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*[f"n{j}" for j in range(i)], *w[i:]]), "s") for i in range(120)]
    got = {r.component_id for r in jaccard.report(documents(*rows), Rule(3, 90, 100)).collect()}
    assert got == {0}


def test_parity_never_exceeds_the_difference():
    pick = np.random.default_rng(3)
    n = np.array([1, 200, 0, 300, 5000, 70000])
    codes = pick.integers(0, 2**63, int(n.sum())).astype(np.uint64)
    bits, held = jaccard._parity(codes, np.repeat(np.arange(len(n)), n), n)
    assert all((b - a) * 64 >= m for a, b, m in zip(held, held[1:], n)) and not bits[held[2]:held[3]].any()
    for size in (1, 300, 5000, 70000):
        a = pick.integers(0, 2**63, size).astype(np.uint64)
        b = a.copy()
        b[:size // 3 + 1] = pick.integers(0, 2**63, size // 3 + 1).astype(np.uint64)
        bits, held = jaccard._parity(np.concatenate((a, b)), np.repeat([0, 1], size), np.array([size, size]))
        differ = int(np.bitwise_count((bits[:held[1]] ^ bits[held[1]:]).view(np.uint64)).sum())
        assert differ <= 2 * (size // 3 + 1) and differ >= size // 6


def test_odd_rows(odd):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.report(odd, Rule(3, 90, 100)).collect() if r.doc_id)
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert [g for g in got if g[0] == 4] == [(4, 5, 4)] * 2 and [g[1] for g in got if g[0] == 7] == [1]
    assert jaccard.report(odd, Rule(3, 90, 100)).count() == 12


def test_one_of_each(odd, documents):
    out = jaccard.one_of_each(odd, Rule(3, 90, 100))
    assert out.columns == odd.columns and out.count() == 11     # of the repeated row one stays
    rows = documents((5, "a b c d", "s"), (3, "A b  c d", "s"), (None, "a b c d", "s"), (9, "e f g h", "s"))
    assert sorted(r.doc_id for r in jaccard.one_of_each(rows, Rule(3, 90, 100)).collect()) == [3, 9]


def test_empty_table(documents):
    assert jaccard.report(documents(), Rule(3, 90, 100)).count() == 0
    assert jaccard.one_of_each(documents(), Rule(3, 90, 100)).count() == 0


def test_components(spark):
    pick = random.Random(5)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)] + [(7, 1000 + i) for i in range(80)]
    nodes = {n: {n} for e in edges for n in e}
    want = brute_components(nodes, None, edges)
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: want[n] for n in want if any(n in e and e[0] != e[1] for e in edges)}
