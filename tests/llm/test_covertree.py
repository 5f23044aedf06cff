"""Embedding near-dedup against all pairs."""

import numpy as np
import pytest

from starmart.llm import covertree
from conftest_llm import brute_components


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, 3.0) for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rid int, root double")


def clouds(seed):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(12, 8))
    near = [c + pick.normal(scale=s, size=8) for c in centres for s in (0.02, 0.1, 0.2, 0.3) for _ in range(6)]
    return [x * pick.uniform(0.1, 50) for x in near] + list(pick.normal(size=(60, 8)))


@pytest.mark.parametrize("sample, block", [(64, 2048), (300, 17), (5, 40)])
def test_against_all_pairs(spark, sample, block):
    x = np.array(clouds(sample)).astype(np.float32)
    u = covertree.unit(x.astype(float))
    linked = u @ u.T >= 0.9
    want = brute_components({i: i for i in range(len(x))}, lambda a, b: linked[a, b])
    got = covertree.report(frame(spark, list(enumerate(x))), sample=sample, block=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (int(linked[i].sum()) - 1, want[i], want[i] == i) for i in range(len(x))}


def test_a_third_of_all_rows_are_copies(spark):
    """Copies become one weighted vector; blocks are smaller than the group would be."""
    x = np.array([*clouds(2)[:80], *[clouds(2)[3]] * 40]).astype(np.float32)
    u = covertree.unit(x.astype(float))
    linked = u @ u.T >= 0.9
    want = brute_components({i: i for i in range(len(x))}, lambda a, b: linked[a, b])
    got = covertree.report(frame(spark, list(enumerate(x))), sample=20, block=9).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (int(linked[i].sum()) - 1, want[i]) for i in range(len(x))}


def test_odd_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0, 0, 0]), (4, [1, None, 2]), (5, [1, float("nan"), 2]), (6, [float("inf"), 1, 1]),
            (7, one), (7, one), (8, [1e30, 2e30, 3e30]), (9, [1e-30, 2e-30, 3e-30]), (10, [1.0, 2.0]), (None, one), (11, [-1, -2, -3])]
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in covertree.report(frame(spark, rows)).collect())
    assert [g for g in got if g[1]] == [("7", 4, 7, True), ("7", 4, 7, True), ("8", 4, 7, False), ("9", 4, 7, False), ("None", 4, 7, False)]
    assert len(got) == 13 and ("10", 0, 10, True) in got and ("1", 0, 1, True) in got


def test_empty_table(spark):
    assert covertree.report(frame(spark, [])).count() == 0


def test_pruning_drops_only_far_pairs():
    pick = np.random.default_rng(1)
    points = covertree.unit(np.concatenate([pick.normal(size=(1, 16)) + pick.normal(scale=0.05, size=(40, 16)) for _ in range(8)]))
    levels = covertree.nets(points, 0.25)
    assert [r for r, _, _ in levels] == [2.0, 1.0, 0.5, 0.25]
    far = covertree._distances(points, points[levels[-1][1]])
    leaf = far.argmin(axis=1)
    radius = np.array([far[leaf == i, i].max(initial=-1) for i in range(len(levels[-1][1]))])
    pairs = set(map(tuple, covertree.traverse(points, levels, radius, 0.2).tolist()))
    every = len(radius) * (len(radius) + 1) // 2
    assert len(pairs) < every / 2
    for i, j in zip(*np.nonzero(covertree._distances(points, points) <= 0.2)):
        assert tuple(sorted((leaf[i], leaf[j]))) in pairs
