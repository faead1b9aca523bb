"""Vector codes and clusters against plain Python."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tilewright.llm.clustering import PartialSearch, cluster_vectors
from tilewright.llm.lloyd import nearest
from tilewright.llm.vector_codes import compress_vectors

# names that the operators use inside stand beside the table's own
SCHEMA = "vec_id long, embedding array<float>, label int, row string, pos int, v int, n map<string,int>"


def rows_of(n=400, dim=64, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    m = (centres[rng.integers(0, 9, n)] + 0.3 * rng.normal(size=(n, dim))).astype(np.float32)
    m[100:150] = m[7]  # many copies under different ids
    m[150:170, : dim // 4] = m[8, : dim // 4]  # one part in common
    rows = [[3 * k + 1, x.tolist(), None if k % 11 == 0 else k % 5] for k, x in enumerate(m)]
    rows[20][1] = None
    rows[21][1][3] = None
    rows[22][1][0] = float("nan")
    rows[23][1][1] = float("-inf")
    rows[24][1] = []
    rows[25][1] = rows[25][1][: dim - 1]
    rows[26][0] = None
    rows.append(list(rows[30]))  # a repeated row
    return [(*r, "x", 1, 2, {"a": 1}) for r in rows]


def whole(v, dim, scale):
    if v is None or len(v) != dim or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(scale * x) for x in v]


def near(v, book):
    return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(book))


def means(book, members):
    return [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else b for b, m in zip(book, members, strict=True)]


def sha(*books):
    return hashlib.sha256(",".join(str(x) for b in books for v in b for x in v).encode()).hexdigest()


def last(x):
    return (x is None, x or 0)


def brute_codes(rows, dim, parts, entries, rounds):
    kept = [(r[0], r[2], w) for r in rows if (w := whole(r[1], dim, 1024))]
    kept.sort(key=lambda r: (last(r[0]), r[2]))
    width = dim // parts
    cut = [[r[2][p * width : (p + 1) * width] for r in kept] for p in range(parts)]
    books = [c[:entries] for c in cut]
    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for v in cut[p]:
                members[near(v, books[p])[1]].append(v)
            books[p] = means(books[p], members)
    final = [[near(v, books[p]) for v in cut[p]] for p in range(parts)]
    errors = [sum(f[k][0] for f in final) for k in range(len(kept))]
    by_label = {}
    for r, e in zip(kept, errors, strict=True):
        by_label[r[1]] = by_label.get(r[1], 0) + e
    return [(r[0], "".join(f"{f[k][1]:02x}" for f in final), errors[k], by_label[r[1]], sha(*books)) for k, r in enumerate(kept)]


def brute_clusters(rows, dim, k, rounds):
    kept = [(r[0], w) for r in rows if (w := whole(r[1], dim, 64))]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    book = [w for _, w in kept[:k]]
    for _ in range(rounds):
        members = [[] for _ in book]
        for _, v in kept:
            members[near(v, book)[1]].append(v)
        book = means(book, members)
    final = [near(v, book) for _, v in kept]
    of = [sum(d for d, c in final if c == j) for j in range(len(book))]
    return [(r[0], c, d, of[c], sum(of), sha([book[c]])) for r, (d, c) in zip(kept, final, strict=True)]


def same(df, expected):
    assert sorted(map(tuple, df.collect()), key=lambda r: (last(r[0]), *r[1:])) == sorted(expected, key=lambda r: (last(r[0]), *r[1:]))


@pytest.mark.parametrize(("dim", "entries", "rounds"), [(8, 256, 4), (64, 40, 4), (12, 7, 0)])
def test_codes_against_plain_python(spark, dim, entries, rounds):
    rows = rows_of(dim=dim)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    same(compress_vectors(df, entries=entries, rounds=rounds), brute_codes(rows, dim, 4, entries, rounds))


@pytest.mark.parametrize(("k", "rounds"), [(16, 3), (1, 2), (500, 1)])
def test_clusters_against_plain_python(spark, k, rounds):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    same(cluster_vectors(df, k=k, rounds=rounds), brute_clusters(rows, 64, k, rounds))


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    bad = spark.createDataFrame([(1, None, 1), (2, [], 1), (3, [1.0, 2.0, 3.0], 1)], "vec_id long, embedding array<float>, label int")
    for df in (empty, bad):
        assert compress_vectors(df).collect() == []
        assert cluster_vectors(df).collect() == []
    assert compress_vectors(empty).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_equal_vectors_and_zeros(spark):
    rows = [(k, [0.0] * 64, None) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = compress_vectors(df).collect()
    assert {(r.code, r.error, r.label_error) for r in found} == {("00000000", 0, 0)} and len(found) == 300
    assert {(r.cluster, r.distance, r.inertia) for r in cluster_vectors(df).collect()} == {(0, 0, 0)}


def test_too_large_is_an_error(spark):
    df = spark.createDataFrame([(1, [3e7] * 64, 0)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="too large"):
        compress_vectors(df).collect()


def test_large_numbers_are_exact():
    rng = np.random.default_rng(0)
    m, c = rng.integers(-(2**27), 2**27, (50, 16)), rng.integers(-(2**27), 2**27, (9, 16))
    index, square = nearest(m, c)
    for row, i, s in zip(m.tolist(), index.tolist(), square.tolist(), strict=True):
        assert (s, i) == near(row, c.tolist())


def test_partial_search_is_exact_and_saves_terms():
    rng = np.random.default_rng(1)
    centres = rng.integers(-60, 60, (16, 64))
    centres[9] = centres[2]  # a tie: the lesser number wins
    m = centres[rng.integers(0, 16, 3000)] + rng.integers(-6, 7, (3000, 64))
    search = PartialSearch(centres, np.argsort(-m.var(0)))
    cluster, distance = search(m)
    index, square = nearest(m, centres)
    assert (cluster == index).all() and (distance == square).all() and 9 not in cluster
    assert search.terms < 0.35 * search.pairs * 64
