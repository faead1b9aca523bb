from __future__ import annotations

import math

import numpy as np
import pytest

from tilewright.llm.ann import Quantised, distances, nearest_neighbours
from tilewright.llm.exact_topk import KdTree, exact_top_k

SCHEMA = "vec_id long, embedding array<float>, ids string, data int"


def table(spark, seed=0, n=700, d=6):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d)).astype(np.float32)
    m[50:80] = m[10]  # ties
    m[90] = 0
    rows = [(k, v.tolist(), "x", k) for k, v in enumerate(m)]
    rows[20] = (20, None, "x", 1)
    rows[21] = (21, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x", 1)
    rows[22] = (22, [float("nan"), 1.0, 0.0, 0.0, 0.0, 0.0], "x", 1)
    rows[23] = (23, [float("inf"), 1.0, 0.0, 0.0, 0.0, 0.0], "x", 1)
    rows[24] = (24, [], "x", 1)
    rows[25] = (25, [1.0, 2.0], None, None)  # another length
    rows[26] = (26, [1.0, 3.0], None, None)
    rows[27] = (None, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], None, None)
    rows.append(rows[30])  # a repeated row
    return rows


def brute(rows, ask, k, score, better, zeros):
    fine = [(i, np.array(v, np.float64)) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zeros or any(v))]
    out = {}
    for q, v in {i: v for i, v in fine if ask(i)}.items():
        found = sorted(((better * score(v, w), i) for i, w in fine if i != q and len(w) == len(v)))[:k]
        out[q] = [(i, better * s) for s, i in found]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_top_k_against_all_pairs(spark, monkeypatch):
    import tilewright.llm.exact_topk as m

    monkeypatch.setattr(m, "SHARD_ROWS", 200)
    monkeypatch.setattr(m, "QUERY_ROWS", 9)
    rows = table(spark)
    v = spark.createDataFrame(rows, SCHEMA)

    def score(a, b):
        return int(np.floor(256 * a) @ np.floor(256 * b))

    assert result(exact_top_k(v, v.where("vec_id % 5 = 0"), k=5)) == brute(rows, lambda i: i % 5 == 0, 5, score, -1, True)


def test_neighbours_against_all_pairs(spark, monkeypatch):
    import tilewright.llm.ann as m

    monkeypatch.setattr(m, "BLOCK_ROWS", 150)
    monkeypatch.setattr(m, "QUERY_ROWS", 20)
    rows = table(spark, 1)
    v = spark.createDataFrame(rows, SCHEMA)

    def score(a, b):
        return float(distances(b[None, :], a)[0])

    assert result(nearest_neighbours(v, v.where("vec_id % 10 = 0"), k=10)) == brute(rows, lambda i: i % 10 == 0, 10, score, 1, False)


@pytest.mark.parametrize("search", [exact_top_k, nearest_neighbours])
def test_few_and_none(spark, search):
    empty = spark.createDataFrame([], SCHEMA)
    assert search(empty, empty).count() == 0
    two = spark.createDataFrame([(1, [1.0, 2.0], None, None), (2, [2.0, 1.0], None, None)], SCHEMA)
    assert [(r.query_id, r.vec_id) for r in search(two, two.where("vec_id = 1")).collect()] == [(1, 2)]


def test_boxes_are_tight_and_bound_the_products():
    rng = np.random.default_rng(3)
    points = np.floor(rng.normal(size=(500, 5)) * 256)
    tree = KdTree.load(KdTree(points, 16).dump())
    queries = np.floor(rng.normal(size=(20, 5)) * 256)
    bounds = tree.bounds(queries)
    for node in range(len(tree.first)):
        below = tree.points[tree.first[node] : tree.last[node]]
        assert (below.min(0) == tree.low[node]).all() and (below.max(0) == tree.high[node]).all()
        assert ((queries @ below.T).max(1) <= bounds[:, node]).all()


def test_tiles_hold_the_distances():
    rng = np.random.default_rng(4)
    a, b = Quantised(rng.normal(size=(40, 64)) * 10), Quantised.load(Quantised(rng.normal(size=(60, 64))).dump())
    least, greatest = a.tile(b)
    true = np.array([distances(b.m, q) for q in a.m])
    assert (least <= true).all() and (true <= greatest).all()


def test_scores_of_large_components(spark):
    """Beyond 2^53 products are still whole numbers; beyond 64 bits they are an error."""
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=3) * 10.0 ** rng.integers(0, 7)).tolist(), None, None) for k in range(150)] + [(500, [4.0e6, 1.0, 1 / 256], None, None), (501, [4.0e6, 1.0, 2 / 256], None, None)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, ids string, data int")

    def score(a, b):
        return sum(int(math.floor(256 * x)) * int(math.floor(256 * y)) for x, y in zip(a.tolist(), b.tolist(), strict=True))

    found = result(exact_top_k(v, v.where("vec_id % 5 = 0"), k=5))
    assert found == brute(rows, lambda i: i % 5 == 0, 5, score, -1, True)
    assert max(s for f in found.values() for _, s in f) > 2**53
    huge = spark.createDataFrame([(1, [1e30, 0.0]), (2, [2e30, 0.0]), (3, [3e30, 1.0]), (4, [1.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        exact_top_k(huge, huge.where("vec_id = 1")).collect()


def test_distances_that_overflow(spark):
    rows = [(k, [x * 1e200, 1.0]) for k, x in enumerate((1.0, 2.0, 4.0, 7.0, -3.0))] + [(9, [3.0, 4.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = result(nearest_neighbours(v, v.where("vec_id in (1, 9)"), k=3))
    assert [i for i, _ in found[1]] == [0, 2, 9]
    assert found[1][0][1] == pytest.approx(1e200) and [i for i, _ in found[9]][0] == 0
