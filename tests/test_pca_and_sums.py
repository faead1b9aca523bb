"""Main components from moments, and running sums over ranges."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest

from tilewright.functions.kernels import pca_fusion as in_one_array
from tilewright.functions.prefix import sums_before
from tilewright.operators.pca import jacobi, pca_blocks
from tilewright.operators.tiles import evict_oldest

BLOCKS = "image int, block int, red array<int>, green array<int>, blue array<int>, shade array<int>"


def test_jacobi_against_the_library():
    rng = np.random.default_rng(0)
    m = rng.normal(size=(200, 4, 4))
    m = m + m.transpose(0, 2, 1)
    m[0] = 0
    m[1] = np.diag([1.0, 1.0, 2.0, 2.0])
    values, vectors = jacobi(m)
    assert np.allclose(values, np.linalg.eigvalsh(m)[:, ::-1])
    assert np.allclose(vectors @ (values[:, :, None] * vectors.transpose(0, 2, 1)), m)
    assert np.allclose(vectors.transpose(0, 2, 1) @ vectors, np.eye(4))


def cut(k, bands, sizes):
    at, out = 0, []
    for b, n in enumerate(sizes):
        out.append((k, b, *[x[at : at + n].tolist() for x in bands]))
        at += n
    return out


def pixels(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.image, r.block)):
        out.setdefault(r.image, []).append(np.array(r.bands, dtype=int).reshape(3, -1))
    return {k: np.concatenate(v, axis=1) for k, v in out.items()}


def test_pixels_against_one_array(spark):
    rng = np.random.default_rng(5)
    images = {k: (rng.integers(0, 256, (4, 64)) if k % 2 else np.clip(rng.normal(120, 40, (1, 64)) + rng.normal(0, 9, (4, 64)), 0, 255).astype(int)) for k in range(30)}
    images[30] = np.full((4, 64), 9)
    whole = pixels(pca_blocks(spark.createDataFrame([r for k, b in images.items() for r in cut(k, b, [64])], BLOCKS)))
    parts = pixels(pca_blocks(spark.createDataFrame([r for k, b in images.items() for r in cut(k, b, [1, 0, 40, 23])], BLOCKS).repartition(7)))
    for k, bands in images.items():
        assert (whole[k] == parts[k]).all()
        hwc = bands.T.reshape(8, 8, 4)
        expected = in_one_array(hwc[..., :3], hwc[..., 3]).reshape(64, 3).T.astype(int)
        assert np.abs(whole[k] - expected).max() <= 1 and (whole[k] != expected).mean() < 0.02
    assert (whole[30] == 0).all() and whole[1].min() == 0 and whole[1].max() in (254, 255)


def plain(rows, budget):
    total = sum(r[2] or 0 for r in rows)
    out, freed = [], 0
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[0])):
        if total - freed <= budget:
            break
        out.append(r[0])
        freed += r[2] or 0
    return sorted(out)


@pytest.mark.parametrize("times", [1, 3, 1000])
def test_eviction_however_few_times_there_are(spark, times):
    rng = random.Random(times)
    rows = [(k, dt.datetime(2020, 1, 1) + dt.timedelta(seconds=rng.randrange(times)) if k % 50 else None, rng.choice([None, 0, 5, 1000])) for k in range(1500)]
    df = spark.createDataFrame(rows, "file_id long, mtime timestamp, size long").repartition(3)
    for budget in (0, 100_000, 10**9):
        got = sorted(r.file_id for r in evict_oldest(df, budget, per_range=100).collect())
        # a file of no bytes behind the last that has to go may go or stay
        assert got == plain(rows, budget)


def test_sums_before_with_repeated_rows_and_odd_names(spark):
    rows = [(1, 7, "x")] * 500 + [(2, 1, "y")]
    df = spark.createDataFrame(rows, "`a.b` int, size int, range string").withColumnRenamed("a.b", "key")
    got = sums_before(df, ["key"], "size", per_range=50).collect()
    assert sorted(r.before for r in got) == [7 * k for k in range(501)]
    assert {r.row.range for r in got} == {"x", "y"} and max(got, key=lambda r: r.before).row.key == 2
    assert sums_before(df.limit(0), ["key"], "size").collect() == []


def test_no_window_without_partitions(spark, capfd):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1), 5)], "file_id long, mtime timestamp, size long")
    evict_oldest(df, 0).explain()
    assert "Window" not in capfd.readouterr().out
