"""Registered queries over rasters in blocks: the pixels of the patches themselves."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators.blocks import BlockShape, fused_pieces, patch_checksums
from tilewright.operators.detect import BrightBlobStub, TileShape
from tilewright.operators.pca import BANDS, pca_blocks
from tilewright.operators.table_function import register_detection
from tilewright.plans.catalogue import query
from tilewright.plans.fixtures import duck, view

#: Tiles of 20 cells a side in a field ten wide, with 25 patches each; blocks that do not divide them.
SHAPE = BlockShape(tile=20, strip=4, size=8, stride=4, block=14, scale=3, res=1.0)


def grid_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return view(spark, sf_dir, "dsm_grid").select(
        F.concat_ws("-", (2500 + c("vec_id") % 10).cast("string"), (1100 + F.floor(c("vec_id") / 10)).cast("string")).alias("coord"),
        (2500 + c("vec_id") % 10).cast("int").alias("x_km"), (1100 + F.floor(c("vec_id") / 10)).cast("int").alias("y_km"), "z",
    )


def grid_loader():
    """Cells and pixels that follow from a tile's grid of 64 numbers."""

    def load(row, layer: str, rows: tuple[int, int], columns: tuple[int, int]) -> np.ndarray:
        z, r, c = np.asarray(row.z, np.int64), np.arange(*rows)[:, None], np.arange(*columns)[None, :]
        if layer == "dsm":
            return z[(r * 20 + c) % 64].astype(np.float32)
        return np.stack([z[(r * 7 + c * (b + 3)) % 64] * (b + 1) % 256 for b in range(3)], axis=-1).astype(np.uint8)

    return load


def _of_mosaic(r: str, c: str, side: int, cell: str) -> str:
    """A cell of a mosaic in DuckDB: that of the tile or of the neighbour it falls on, else 0."""

    def at(t: str, r: str, c: str) -> str:
        return cell.replace("{z}", f"{t}").replace("{r}", f"({r})").replace("{c}", f"({c})")

    near = f"case when {c} < {side} then {at('z', r, c)} else {at('zr', r, f'{c} - {side}')} end"
    far = f"case when {c} < {side} then {at('zb', f'{r} - {side}', c)} else {at('zc', f'{r} - {side}', f'{c} - {side}')} end"
    return f"coalesce(case when {r} < {side} then {near} else {far} end, 0)"


def _slope(ahead: tuple, behind: tuple) -> str:
    def side(three: tuple) -> str:
        cells = [f"m[greatest(0, least(23, i // 24 + ({dr}))) * 24 + greatest(0, least(23, i % 24 + ({dc}))) + 1]" for dr, dc in three]
        return f"({cells[0]} + 2 * {cells[1]} + {cells[2]})"

    return f"(({side(ahead)} - {side(behind)}) / 8::double)"


def _shrunk(band: int) -> str:
    """The colour band of a mosaic, shrunk by 3 along the rows and then along the columns."""
    pixels = _of_mosaic("(i // 72)", "(i % 72)", 60, f"({{z}}[({{r}} * 7 + {{c}} * {band + 3}) % 64 + 1] * {band + 1}) % 256")
    across = "list_sum(list_transform(range(14), lambda k: w[k + 1] * p[(i // 24) * 72 + greatest(0, least(71, (i % 24) * 3 - 5 + k)) + 1]))"
    down = "list_sum(list_transform(range(14), lambda k: w[k + 1] * h[greatest(0, least(71, (i // 24) * 3 - 5 + k)) * 24 + i % 24 + 1]))"
    return f"""p{band} as materialized (select vec_id, list_transform(range(5184), lambda i: {pixels}) as p from t),
 h{band} as materialized (select vec_id, list_transform(range(1728), lambda i: {across}) as h from p{band}, weights),
 b{band} as materialized (select vec_id, list_transform(range(576), lambda i: greatest(0, least(255, floor((2 * {down} + total * total) / (2 * total * total)::double)::bigint))) as b from h{band}, weights)"""


EAST, WEST = ((-1, 1), (0, 1), (1, 1)), ((-1, -1), (0, -1), (1, -1))
SOUTH, NORTH = ((1, -1), (1, 0), (1, 1)), ((-1, -1), (-1, 0), (-1, 1))
# the cubic kernel of parameter -1/2 in sixths of a cell, n of them away: twice 1.5t^3 - 2.5t^2 + 1 or -0.5t^3 + 2.5t^2 - 4t + 2
KERNEL = "case when n < 6 then 3 * n * n * n - 30 * n * n + 432 when n < 12 then -n * n * n + 30 * n * n - 288 * n + 864 else 0 end"
PIXELS = f"""with {duck("dsm_grid")}, n as (select list_transform(range(14), lambda k: abs(2 * (k - 5) - 2)) as ns),
 weights as materialized (select list_transform(ns, lambda n: ({KERNEL})::bigint) as w, list_sum(list_transform(ns, lambda n: ({KERNEL})::bigint))::bigint as total from n),
 t as materialized (select g.vec_id, g.z, r.z as zr, b.z as zb, c.z as zc from dsm_grid g left join dsm_grid r on r.vec_id = g.vec_id + 1 and g.vec_id % 10 < 9
  left join dsm_grid b on b.vec_id = g.vec_id - 10 left join dsm_grid c on c.vec_id = g.vec_id - 9 and g.vec_id % 10 < 9),
 m as materialized (select vec_id, list_transform(range(576), lambda i: {_of_mosaic("(i // 24)", "(i % 24)", 20, "{z}[({r} * 20 + {c}) % 64 + 1]")}) as m from t),
 s as materialized (select vec_id, list_transform(range(576), lambda i: round_even(255 / sqrt(1 + {_slope(EAST, WEST)} * {_slope(EAST, WEST)} + {_slope(SOUTH, NORTH)} * {_slope(SOUTH, NORTH)}), 0)::bigint) as b from m),
 {_shrunk(0)}, {_shrunk(2)}, places as (select unnest(range(25)) as k)"""


def _sum(t: str) -> str:
    return f"list_sum(list_transform(range(64), lambda i: {t}.b[(k // 5 * 4 + i // 8) * 24 + k % 5 * 4 + i % 8 + 1] * (1 + i % 8191)))::bigint"


@query(f"""{PIXELS} select (2500 + s.vec_id % 10) || '-' || (1100 + s.vec_id // 10) as coord, (k // 5)::int as row, (k % 5)::int as col, 64::bigint as n, {_sum("b0")} as red, {_sum("s")} as shade, {_sum("b2")} as blue
 from s join b0 on b0.vec_id = s.vec_id join b2 on b2.vec_id = s.vec_id, places""")
def patch_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checksum of each band of every fused patch of every tile, from mosaics of tiles
    and their neighbours that no task holds whole."""
    return patch_checksums(fused_pieces(grid_tiles(spark, sf_dir), grid_loader(), SHAPE), SHAPE.size)


# cells below 8, so that slopes are moderate; at half a metre a cell they are twice what one metre gives
BRIGHTEST = f"""with {duck("dsm_grid")}, g as (select vec_id, list_transform(z, lambda v: v % 8) as z from dsm_grid),
 t as materialized (select g.vec_id, g.z, r.z as zr, b.z as zb, c.z as zc from g left join g r on r.vec_id = g.vec_id + 1 and g.vec_id % 10 < 9
  left join g b on b.vec_id = g.vec_id - 10 left join g c on c.vec_id = g.vec_id - 9 and g.vec_id % 10 < 9),
 m as materialized (select vec_id, list_transform(range(576), lambda i: {_of_mosaic("(i // 24)", "(i % 24)", 20, "{z}[({r} * 20 + {c}) % 64 + 1]")}) as m from t),
 s as materialized (select vec_id, list_transform(range(576), lambda i: round_even(255 / sqrt(1 + 4 * {_slope(EAST, WEST)} * {_slope(EAST, WEST)} + 4 * {_slope(SOUTH, NORTH)} * {_slope(SOUTH, NORTH)}), 0)::bigint) as b from m),
 p as (select vec_id, k, list_transform(range(64), lambda i: b[(k // 5 * 4 + i // 8) * 24 + k % 5 * 4 + i % 8 + 1]) as v from s, (select unnest(range(25)) as k)),
 q as (select *, list_max(v) as best, list_position(v, list_max(v)) - 1 as i from p)"""


@query(f"""{BRIGHTEST} select (2500 + vec_id % 10) || '-' || (1100 + vec_id // 10) as coord, vec_id, (k // 5)::int as patch_row, (k % 5)::int as patch_col,
 (2500 + vec_id % 10) * 1000 + k % 5 * 2 + (i % 8 + 0.5::double) / 2 as easting, (1101 + vec_id // 10) * 1000 - k // 5 * 2 - (i // 8 + 0.5::double) / 2 as northing,
 (best / 255::double)::float as confidence, 8::float as bbox_w_m, 8::float as bbox_h_m, 0::smallint as class_id from q where best / 255::double >= 0.3""")
def detect_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles to patches to detections in SQL: the brightest cell of each fused patch of
    every tile, found by a table function over tiles and what their neighbours lend."""
    register_detection(spark, BrightBlobStub, TileShape(dsm_px=20, strip=4, size=8, stride=4, scale=1))
    tiles = view(spark, sf_dir, "dsm_grid").selectExpr("vec_id", "cast(2500 + vec_id % 10 as int) as x", "cast(1100 + vec_id div 10 as int) as y", "transform(z, v -> v % 8) as z")
    # a tile lends its first columns to the tile west of it, and its first rows to the one north of it
    lent = tiles.selectExpr("*", """inline(array(
      named_struct('side', 'own', 'dx', 0, 'dy', 0, 'width', 20, 'n', 400), named_struct('side', 'right', 'dx', 1, 'dy', 0, 'width', 4, 'n', 80),
      named_struct('side', 'bottom', 'dx', 0, 'dy', 1, 'width', 20, 'n', 80), named_struct('side', 'corner', 'dx', 1, 'dy', 1, 'width', 4, 'n', 16)))""")  # fmt: skip
    parts = lent.selectExpr(
        "concat_ws('-', cast(x - dx as string), cast(y + dy as string)) as coord", "vec_id", "x - dx as x_km", "y + dy as y_km", "side", "width",
        "transform(sequence(0, n - 1), k -> z[((k div width) * 20 + k % width) % 64]) as dsm", "cast(null as binary) as rgb",
    )
    return spark.sql("select * from detect_boxes(table({parts}), 0.3D)", parts=parts)


@query()
def pca_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every grid of four bands, cut into four blocks, on its main components."""
    grids = view(spark, sf_dir, "rgb_grid").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(3))))
    cut = [F.slice(b, F.col("block") * 16 + 1, F.lit(16)).alias(b) for b in BANDS]
    return pca_blocks(grids.select(F.col("vec_id").alias("image"), "block", *cut))
