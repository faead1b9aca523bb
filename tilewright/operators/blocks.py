"""Rasters in blocks: mosaics, shades and shrunken bands across the borders of tiles,
with no task that holds a mosaic.

A tile is read in blocks. Each block sends what others need of it, cut to their
windows (a block and a halo around it), to its own mosaic and to those of the tiles
that it lends a strip to. One shuffle brings the pieces of a window together; there
the stencils run, and what comes out is cut to the patches that it lies in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.geo import coord_from
from tilewright.functions.kernels import horn_gradient
from tilewright.model import DSM_RES, FUSION_CHANNEL, NEIGHBOR_STRIP_DSM, STRIDE_PX, TILE_PX_DSM, TILE_SIZE_PX
from tilewright.operators.tiles import NEIGHBOURS

#: Cells around a block that its stencils reach: Horn's weights one, the cubic kernel two.
HALO = 2
#: Bytes of cells after which a task hands on what it has cut.
BATCH_BYTES = 8 << 20
#: Bytes of cells of small windows, or of pieces of patches, that are worked on together.
AT_ONCE = 2 << 20


@dataclass
class BlockShape:
    """Cells of a tile, of the strip that its neighbours lend, of a patch, from patch to
    patch, and of a block; colour pixels in a cell's side; metres of a cell."""

    tile: int = TILE_PX_DSM
    strip: int = NEIGHBOR_STRIP_DSM
    size: int = TILE_SIZE_PX
    stride: int = STRIDE_PX
    block: int = 512
    scale: int = 5
    res: float = DSM_RES

    @property
    def mosaic(self) -> int:
        return self.tile + self.strip

    @property
    def patches(self) -> int:
        """Patches of a row."""
        return (self.mosaic - self.size) // self.stride + 1


#: load(tile row, layer, (first row, last), (first column, last)) -> array of a window:
#: "dsm" (h, w) in cells, "rgb" (h, w, 3) in colour pixels; ends are exclusive.
Load = Callable[[tuple, str, tuple[int, int], tuple[int, int]], np.ndarray]


def with_borrowers(tiles: DataFrame) -> DataFrame:
    """``tiles`` (coord, x_km, y_km, ...) with borrowers: the steps (dx, dy) to those of
    them that a strip of the tile is lent to. Rows of coordinates only are joined."""
    names = F.explode(F.array(*[F.struct(F.lit(-dx).alias("dx"), F.lit(-dy).alias("dy")) for _, dx, dy in NEIGHBOURS])).alias("s")
    asks = tiles.select("coord", "x_km", "y_km", names).select(F.col("coord").alias("lender"), "s", coord_from(F.col("x_km") + F.col("s.dx"), F.col("y_km") + F.col("s.dy")).alias("to"))
    met = asks.join(tiles.select(F.col("coord").alias("to")), "to").groupBy("lender").agg(F.collect_set("s").alias("borrowers"))
    return tiles.join(met, tiles["coord"] == met["lender"], "left").drop("lender")


def integer_cubic(scale: int) -> tuple[int, np.ndarray]:
    """(first pixel, weights) of cubic convolution with the parameter -1/2, stretched by a
    whole factor, as whole numbers: twice the kernel times (2 * scale) cubed."""
    first, u = -(3 * scale // 2) - 1, 2 * scale
    n = np.abs(2 * (first + np.arange(4 * scale + 2)) + 1 - scale)
    near, far = 3 * n**3 - 5 * n**2 * u + 2 * u**3, -(n**3) + 5 * n**2 * u - 8 * n * u**2 + 4 * u**3
    return first, np.where(n < u, near, np.where(n < 2 * u, far, 0))


def shrunken(window: np.ndarray, scale: int, halo: int) -> np.ndarray:
    """The cells inside the halo of a band of colour pixels (or of many of one size: the
    last two axes count), shrunk by a whole factor. Sums are whole numbers; halves are
    rounded up. The same for any cut of a raster."""
    first, w = integer_cubic(scale)
    out = window.astype(np.int64)
    for axis in (out.ndim - 2, out.ndim - 1):
        n = out.shape[axis] // scale - 2 * halo
        take = (np.arange(n)[:, None] + halo) * scale + first + np.arange(len(w))[None, :]
        out = np.tensordot(np.take(out, take, axis=axis), w, axes=([axis + 1], [0]))
    total = int(w.sum()) ** 2
    return np.clip((2 * out + total) // (2 * total), 0, 255).astype(np.uint8)


def shaded(window: np.ndarray, res: float, halo: int) -> np.ndarray:
    """The shade under a light from above of the cells inside the halo, as whole numbers."""
    x, y = horn_gradient(window, res)
    inside = slice(halo, -halo)
    return np.clip(np.rint(255 / np.sqrt(1 + x * x + y * y)), 0, 255).astype(np.uint8)[..., inside, inside]


_FUSED = pa.schema([("coord", pa.string()), *[(c, pa.int32()) for c in ("row", "col", "y", "x", "h", "w")], ("pixels", pa.binary())])
_PIECE = "x_km int, y_km int, tr int, tc int, layer string, r int, c int, h int, w int, kind string, cells binary"


def pieces(tiles: DataFrame, load: Load, shape: BlockShape) -> DataFrame:
    """The blocks of all tiles (with borrowers), cut to the windows that need them. Rows
    of tiles are few bytes and much work, so they are dealt to all tasks first (by other
    columns than those of a join, whose partitions may have been brought together)."""
    side = -(-shape.tile // shape.block)
    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = tiles.repartition(tasks, "x_km", "y_km").withColumn("__r", F.explode(F.sequence(F.lit(0), F.lit(side - 1)))).withColumn("__c", F.explode(F.sequence(F.lit(0), F.lit(side - 1))))
    names = [c.split()[0] for c in _PIECE.split(", ")]
    n = -(-shape.mosaic // shape.block)

    def targets(lo: int, hi: int) -> range:
        """Blocks whose windows touch the cells lo to hi of a mosaic."""
        return range(max(0, (lo - HALO) // shape.block), min(n, (hi - 1 + HALO) // shape.block + 1))

    def cut(row, dx: int, dy: int, layers: dict[str, np.ndarray], r0: int, c0: int) -> Iterator[tuple]:
        """What the mosaic of the tile that lies dx, dy away needs of a block."""
        h, w = layers["dsm"].shape
        # the lender's place in the mosaic of the borrower, which hangs from its upper left corner
        top, left = dy * shape.tile + r0, -dx * shape.tile + c0
        bottom, right = min(top + h, shape.mosaic), min(left + w, shape.mosaic)
        for tr in targets(top, bottom) if top < bottom else ():
            for tc in targets(left, right) if left < right else ():
                a, b = max(top, tr * shape.block - HALO), min(bottom, (tr + 1) * shape.block + HALO)
                c, d = max(left, tc * shape.block - HALO), min(right, (tc + 1) * shape.block + HALO)
                if a >= b or c >= d:
                    continue
                for layer, cells in layers.items():
                    k = 1 if layer == "dsm" else shape.scale
                    part = np.ascontiguousarray(cells[(a - top) * k : (b - top) * k, (c - left) * k : (d - left) * k])
                    yield row.x_km + dx, row.y_km + dy, tr, tc, layer, a, c, b - a, d - c, part.dtype.str, part.tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out, size = [], 0
            for row in pdf.itertuples(index=False):
                row_no, col_no = row[-2], row[-1]
                rows, columns = ((k * shape.block, min((k + 1) * shape.block, shape.tile)) for k in (row_no, col_no))
                wide = [tuple(x * shape.scale for x in span) for span in (rows, columns)]
                layers = {"dsm": load(row, "dsm", rows, columns), "rgb": load(row, "rgb", *wide)}
                if row_no == col_no == 0:
                    # a window that no cell reaches is there all the same, and is 0
                    out += [(row.x_km, row.y_km, tr, tc, None, 0, 0, 0, 0, None, None) for tr in range(n) for tc in range(n)]
                for dx, dy in [(0, 0), *((s["dx"], s["dy"]) for s in (row.borrowers if row.borrowers is not None else ()))]:
                    for piece in cut(row, dx, dy, layers, rows[0], columns[0]):
                        out.append(piece)
                        size += len(piece[-1])
                if size > BATCH_BYTES:
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0
            yield pd.DataFrame(out, columns=names)

    return at.mapInPandas(run, _PIECE)


def fused_pieces(tiles: DataFrame, load: Load, shape: BlockShape | None = None) -> DataFrame:
    """The fused patches of all tiles (coord, x_km, y_km, and what load needs), in
    pieces: coord, row, col of the patch, y, x, h, w of the piece in it, pixels (h, w, 3)
    of uint8. Colours are shrunk to cells, and the fusion channel is the shade.

    Cells that no tile covers are 0; beyond the mosaic the nearest cell counts. Pieces
    of a patch overlap nowhere and cover it; where they are cut depends on the blocks,
    their pixels do not. A coord that occurs twice is an error of the caller's.
    """
    shape = shape or BlockShape()

    def window(key: tuple, parts: list[tuple]) -> dict[str, np.ndarray]:
        """The cells of one window with what of its halo lies inside the mosaic."""
        *_, (a, b, c, d) = _spans(*key[2:], shape)
        k = shape.scale
        kind = next((p[5] for p in parts if p[0] == "dsm"), "f4")
        held = {"dsm": np.zeros((b - a, d - c), kind), "rgb": np.zeros(((b - a) * k, (d - c) * k, 3), np.uint8)}
        for layer, pr, pc, ph, pw, of, cells in parts:
            m, wide = (1, ()) if layer == "dsm" else (k, (3,))
            held[layer][(pr - a) * m : (pr - a + ph) * m, (pc - c) * m : (pc - c + pw) * m] = np.frombuffer(cells, of).reshape(ph * m, pw * m, *wide)
        return held

    def cut(tr: int, tc: int, keys: list[tuple], held: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """The pieces of patches in windows that have one place in their mosaics."""
        r0, c0, h, w, (a, b, c, d) = _spans(tr, tc, shape)
        k = shape.scale
        around = [(HALO - (r0 - a), HALO - (b - r0 - h)), (HALO - (c0 - c), HALO - (d - c0 - w))]
        dsm = np.pad(np.stack([x["dsm"] for x in held]), [(0, 0), *around], mode="edge")
        rgb = np.pad(np.stack([x["rgb"] for x in held]), [(0, 0), *[(x * k, y * k) for x, y in around], (0, 0)], mode="edge")
        bands = [shrunken(rgb[..., j], k, HALO) if j != FUSION_CHANNEL else shaded(dsm, shape.res, HALO) for j in range(3)]
        fused = np.stack(bands, axis=-1)
        coords = pa.array([f"{x_km}-{y_km}" for x_km, y_km in keys], pa.string())
        for row in _of_patches(r0, r0 + h, shape):
            for col in _of_patches(c0, c0 + w, shape):
                y0, y1 = max(r0, row * shape.stride), min(r0 + h, row * shape.stride + shape.size)
                x0, x1 = max(c0, col * shape.stride), min(c0 + w, col * shape.stride + shape.size)
                places = (row, col, y0 - row * shape.stride, x0 - col * shape.stride, y1 - y0, x1 - x0)
                pixels = pa.array([p.tobytes() for p in fused[:, y0 - r0 : y1 - r0, x0 - c0 : x1 - c0]], pa.binary())
                yield pa.RecordBatch.from_arrays([coords, *(pa.array(np.full(len(keys), p, np.int32)) for p in places), pixels], schema=_FUSED)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a partition comes sorted by window, so few windows' pieces are held at a time
        flat = (r for batch in batches for r in zip(*(batch.column(j).to_pylist() for j in range(batch.num_columns)), strict=True))
        held, size = {}, 0

        def done() -> Iterator[pa.RecordBatch]:
            some = pa.Table.from_batches([b for (tr, tc, _), (keys, cells) in held.items() for b in cut(tr, tc, keys, cells)], schema=_FUSED)
            held.clear()
            yield from some.combine_chunks().to_batches(max_chunksize=4096)

        for key, rows in groupby(flat, key=itemgetter(0, 1, 2, 3)):
            cells = window(key, [r[4:] for r in rows if r[4] is not None])
            # elevations of another type are not stacked with these, so that none is converted
            keys, of = held.setdefault((*key[2:], cells["dsm"].dtype.str), ([], []))
            keys.append(key[:2])
            of.append(cells)
            size += sum(x.nbytes for x in cells.values())
            if size > AT_ONCE:
                yield from done()
                size = 0
        yield from done()

    key = ["x_km", "y_km", "tr", "tc"]
    dealt = pieces(with_borrowers(tiles), load, shape).repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(windows, "coord string, row int, col int, y int, x int, h int, w int, pixels binary")


def _spans(tr: int, tc: int, shape: BlockShape) -> tuple:
    """First row and column, height and width of a window, and first row, last, first
    column, last of what of it and its halo lies inside the mosaic."""
    r0, c0 = tr * shape.block, tc * shape.block
    h, w = min(shape.block, shape.mosaic - r0), min(shape.block, shape.mosaic - c0)
    return r0, c0, h, w, (max(0, r0 - HALO), min(shape.mosaic, r0 + h + HALO), max(0, c0 - HALO), min(shape.mosaic, c0 + w + HALO))


def _of_patches(lo: int, hi: int, shape: BlockShape) -> range:
    """The patches of a row that hold any of the cells lo to hi."""
    return range(max(0, -(-(lo - shape.size + 1) // shape.stride)), min(shape.patches, (hi - 1) // shape.stride + 1))


def assembled(found: DataFrame, size: int) -> DataFrame:
    """coord, row, col, pixels (size, size, 3) of whole patches from their pieces. A
    patch is a bounded number of bytes."""

    def patch(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros((size, size, 3), np.uint8)
        for p in pdf.itertuples(index=False):
            out[p.y : p.y + p.h, p.x : p.x + p.w] = np.frombuffer(p.pixels, np.uint8).reshape(p.h, p.w, 3)
        return pd.DataFrame([(*pdf[["coord", "row", "col"]].iloc[0], out.tobytes())], columns=["coord", "row", "col", "pixels"])

    return found.groupBy("coord", "row", "col").applyInPandas(patch, "coord string, row int, col int, pixels binary")


#: A pixel counts its value times 1 + its place in the patch modulo this prime.
PRIME = 8191


def patch_checksums(found: DataFrame, size: int) -> DataFrame:
    """coord, row, col, n (pixels) and a checksum of each band of every patch, from
    its pieces. Each piece adds its part, so that pixels are not shuffled again."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            # pieces of one size and place in their patches are summed together
            for (y, x, h, w), alike in pdf.groupby(["y", "x", "h", "w"], sort=False):
                weights = 1 + ((y + np.arange(h))[:, None] * size + x + np.arange(w)[None, :]) % PRIME
                step = max(1, AT_ONCE // (h * w * 24))
                cells = alike["pixels"].to_numpy()
                added = [np.einsum("nijk,ij->nk", np.frombuffer(b"".join(cells[at : at + step]), np.uint8).reshape(-1, h, w, 3).astype(np.int64), weights) for at in range(0, len(cells), step)]
                out.append(alike[["coord", "row", "col"]].assign(n=h * w, **dict(zip(("red", "shade", "blue"), np.concatenate(added).T, strict=True))))
            yield pd.concat(out) if out else pd.DataFrame(columns=["coord", "row", "col", "n", "red", "shade", "blue"])

    parts = found.mapInPandas(sums, "coord string, row int, col int, n long, red long, shade long, blue long")
    return parts.groupBy("coord", "row", "col").agg(*[F.sum(c).alias(c) for c in ("n", "red", "shade", "blue")])
