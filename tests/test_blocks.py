"""Rasters in blocks against whole mosaics in one array."""

from __future__ import annotations

import numpy as np
import pytest

from tilewright.functions.kernels import cubic_weights, mosaic, overhead_shade, patches, shrink
from tilewright.model import FUSION_CHANNEL
from tilewright.operators.blocks import BlockShape, assembled, fused_pieces, integer_cubic, patch_checksums, pieces, shaded, shrunken, with_borrowers
from tilewright.operators.detect import fused_patches

SIDE, STRIP, SIZE, STRIDE, SCALE = 20, 4, 8, 4, 3
TILES = [(10, 10), (11, 10), (10, 9), (11, 9), (12, 10), (40, 40)]


def image(x, y, layer):
    rng = np.random.default_rng(x * 1000 + y)
    dsm = (rng.random((SIDE, SIDE)) * 40).astype(np.float32)
    rgb = rng.integers(0, 256, (SIDE * SCALE, SIDE * SCALE, 3)).astype(np.uint8)
    return dsm if layer == "dsm" else rgb


def loader():
    """A loader that workers get by value, with all that it needs."""
    side, scale = SIDE, SCALE

    def load(row, layer, rows, columns):
        rng = np.random.default_rng(row.x_km * 1000 + row.y_km)
        dsm = (rng.random((side, side)) * 40).astype(np.float32)
        cells = dsm if layer == "dsm" else rng.integers(0, 256, (side * scale, side * scale, 3)).astype(np.uint8)
        return cells[slice(*rows), slice(*columns)]

    return load


def whole(x, y):
    """(shade, colours) of a mosaic in one array."""
    def near(dx, dy, layer):
        return image(x + dx, y + dy, layer) if (x + dx, y + dy) in TILES else None

    dsm, rgb = (mosaic(image(x, y, n), STRIP * k, near(1, 0, n), near(0, -1, n), near(1, -1, n)) for n, k in (("dsm", 1), ("rgb", SCALE)))
    wide = np.pad(rgb, [(2 * SCALE, 2 * SCALE)] * 2 + [(0, 0)], mode="edge")
    fused = np.stack([shrunken(wide[..., j], SCALE, 2) for j in range(3)], axis=-1)
    fused[..., FUSION_CHANNEL] = np.clip(np.rint(overhead_shade(dsm, 0.5)), 0, 255)
    return fused, dsm, rgb


@pytest.mark.parametrize("block", [3, 7, 10, 20, 64])
def test_patches_are_the_same_for_any_block(spark, block):
    tiles = spark.createDataFrame([(f"{x}-{y}", x, y) for x, y in TILES], "coord string, x_km int, y_km int")
    found = fused_pieces(tiles, loader(), BlockShape(SIDE, STRIP, SIZE, STRIDE, block, SCALE))
    got = {(r.coord, r.row, r.col): np.frombuffer(r.pixels, np.uint8).reshape(SIZE, SIZE, 3) for r in assembled(found, SIZE).collect()}
    assert len(got) == 25 * len(TILES)
    for x, y in TILES:
        fused, dsm, rgb = whole(x, y)
        old = {(r, c): p for r, c, p in fused_patches(rgb, dsm, SCALE, SIZE, STRIDE)}
        for r, c, p in patches(fused, SIZE, STRIDE):
            assert (got[f"{x}-{y}", r, c] == p).all()
            # the path that holds a mosaic repeats a patch's own edge; inside they agree
            inside = np.abs(got[f"{x}-{y}", r, c][2:-2, 2:-2].astype(int) - np.moveaxis(old[r, c], 0, -1)[2:-2, 2:-2])
            assert inside.max() <= 1 and (inside > 0).mean() < 0.02
    sums = {(r.coord, r.row, r.col): (r.n, r.red, r.shade, r.blue) for r in patch_checksums(found, SIZE).collect()}
    weight = 1 + np.arange(SIZE * SIZE).reshape(SIZE, SIZE) % 8191
    assert sums == {k: (SIZE * SIZE, *(int((weight * p[..., j].astype(int)).sum()) for j in range(3))) for k, p in got.items()}


@pytest.mark.parametrize("scale", [1, 2, 3, 5, 8])
def test_whole_weights_are_those_of_the_kernel(scale):
    first, w = integer_cubic(scale)
    f, floats = cubic_weights(scale)
    assert first == f and np.allclose(w / w.sum(), floats)


def test_shrinking_flat_bands_and_ramps():
    assert (shrunken(np.full((40, 40), 77, np.uint8), 5, 2) == 77).all()
    ramp = np.repeat(np.arange(60)[None, :] * 4, 60, axis=0).astype(np.uint8)
    got = shrunken(ramp, 5, 2)
    assert got.shape == (8, 8) and (got == shrink(ramp, 5)[2:-2, 2:-2]).all()


def test_windows_of_one_size_are_worked_on_together():
    rng = np.random.default_rng(2)
    dsm, rgb = rng.random((5, 12, 14)).astype(np.float32) * 40, rng.integers(0, 256, (5, 36, 42)).astype(np.uint8)
    assert (shrunken(rgb, 3, 2) == np.stack([shrunken(x, 3, 2) for x in rgb])).all()
    assert (shaded(dsm, 0.5, 2) == np.stack([shaded(x, 0.5, 2) for x in dsm])).all()


def test_tiles_of_one_file_are_read_by_all_tasks(spark):
    tiles = spark.createDataFrame([(f"{x}-{y}", x, y) for x, y in TILES], "coord string, x_km int, y_km int").coalesce(1)
    cut = pieces(with_borrowers(tiles), loader(), BlockShape(SIDE, STRIP, SIZE, STRIDE, 7, SCALE))
    assert cut.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
