"""Patch grids, shading, mosaics and band fusion.

Grids of a few cells (``array<...>``, row-major) are columns and expressions;
full-size rasters stay inside one Python stage, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.model import DSM_RES, NEIGHBOR_STRIP_DSM, STRIDE_PX, TILE_PX_DSM, TILE_SIZE_PX


def patch_grid(tiles: DataFrame, pixels: int = TILE_PX_DSM + NEIGHBOR_STRIP_DSM, crop: int = TILE_SIZE_PX, stride: int = STRIDE_PX, res: float = DSM_RES) -> DataFrame:
    """Every patch of every tile (coord, x_km, y_km): row, col, and the affine map
    (a, c, e, f) of its pixels. A tile hangs from its upper left corner."""
    last = (pixels - crop) // stride
    at = tiles.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(last)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(last))))
    x0, y0 = F.col("x_km") * 1000.0, (F.col("y_km") + 1) * 1000.0
    return at.select(*tiles.columns, "row", "col", F.lit(res).alias("a"), (x0 + F.col("col") * (stride * res)).alias("c"), F.lit(-res).alias("e"), (y0 - F.col("row") * (stride * res)).alias("f"))


def cell(grid: Column, row: Column, col: Column, width: int, height: int) -> Column:
    """A cell of a row-major grid; places outside are those at the edge."""
    r, c = F.greatest(F.lit(0), F.least(row, F.lit(height - 1))), F.greatest(F.lit(0), F.least(col, F.lit(width - 1)))
    return F.get(grid, (r * width + c).cast("int"))


def overhead_shade(grid: Column, width: int, height: int, res: float) -> Column:
    """255 / sqrt(1 + dx^2 + dy^2) in each cell of a small grid, by Horn's weights."""

    def at(i: Column) -> Column:
        r, c = F.floor(i / width), i % width

        def z(dr: int, dc: int) -> Column:
            return cell(grid, r + dr, c + dc, width, height).cast("double")

        x = (z(-1, 1) + 2 * z(0, 1) + z(1, 1)) - (z(-1, -1) + 2 * z(0, -1) + z(1, -1))
        y = (z(1, -1) + 2 * z(1, 0) + z(1, 1)) - (z(-1, -1) + 2 * z(-1, 0) + z(-1, 1))
        return F.lit(255.0) / F.sqrt(F.lit(1.0) + F.pow(x / (8 * res), F.lit(2)) + F.pow(y / (8 * res), F.lit(2)))

    return F.transform(F.sequence(F.lit(0), F.lit(width * height - 1)), at)


# --- fusion of colour bands with a shade. Each takes a band and the shade, as grids.


def fuse_replace(band: Column, shade: Column) -> Column:
    """The shade in place of the band."""
    return F.transform(shade, lambda s: s.cast("int"))


def fuse_blend(band: Column, shade: Column, alpha: float = 0.5) -> Column:
    """alpha * band + (1 - alpha) * shade, cut to whole numbers."""
    return F.zip_with(band, shade, lambda b, s: (b * alpha + s * (1 - alpha)).cast("int"))


def fuse_blackout(band: Column, shade: Column, threshold: float) -> Column:
    """0 where the shade is below the threshold."""
    return F.zip_with(band, shade, lambda b, s: F.when(s < threshold, 0).otherwise(b))


def fuse_multiply(band: Column, shade: Column) -> Column:
    """(band / 255) * (shade / 255) * 255 in single precision, clipped and cut."""
    one = F.lit(255.0).cast("float")

    def product(b: Column, s: Column) -> Column:
        x = (b.cast("float") / one).cast("float") * (s.cast("float") / one).cast("float")
        return F.least(F.greatest((x.cast("float") * one).cast("float"), F.lit(0.0)), F.lit(255.0)).cast("int")

    return F.zip_with(band, shade, product)


#: By name, for pipelines that choose the fusion by a setting.
FUSIONS: dict[str, Callable[..., Column]] = {"replace": fuse_replace, "blend": fuse_blend, "blackout": fuse_blackout, "multiply": fuse_multiply}


def replace_channel(red: Column, green: Column, blue: Column, shade: Column, channel: int = 1) -> Column:
    """The three bands with one of them replaced; -1 replaces none."""
    bands = [red, green, blue]
    if channel not in (-1, 0, 1, 2):
        raise ValueError("channel must be -1, 0, 1 or 2")
    if channel >= 0:
        bands[channel] = fuse_replace(bands[channel], shade)
    return F.array(*bands)


def mosaic_grid(grid: Column, right: Column, bottom: Column, corner: Column, side: int, strip: int) -> Column:
    """A grid of side + strip cells a side from that of a tile and its neighbours;
    0 where there is no neighbour."""
    zero = F.lit(0)

    def row(r: int) -> list[Column]:
        near, far, y = (grid, right, r) if r < side else (bottom, corner, r - side)
        return [F.coalesce(F.get(near, F.lit(y * side + c)), zero) for c in range(side)] + [F.coalesce(F.get(far, F.lit(y * side + c)), zero) for c in range(strip)]

    return F.array(*[v for r in range(side + strip) for v in row(r)])
