"""Detection as a table function: from SQL, tiles and the strips that their neighbours
lend go in, detections come out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import DoubleType, FloatType, IntegerType, ShortType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, PartitioningColumn

from tilewright.functions.kernels import mosaic
from tilewright.model import TARGET_RES
from tilewright.operators.detect import Detector, TileShape, detect_in_halves, fused_patches

SIDES = ("own", "right", "bottom", "corner")
_NEEDED = ("coord", "x_km", "y_km", "side", "width", "dsm", "rgb")
_FOUND = [
    StructField("patch_row", IntegerType()), StructField("patch_col", IntegerType()), StructField("easting", DoubleType()), StructField("northing", DoubleType()),
    StructField("confidence", FloatType()), StructField("bbox_w_m", FloatType()), StructField("bbox_h_m", FloatType()), StructField("class_id", ShortType()),
]


@lru_cache(maxsize=1)
def _loaded(make_detector: Callable[[], Detector]) -> Detector:
    detector = make_detector()
    detector.warmup()
    return detector


def _cells(values, kind: str) -> np.ndarray:
    return np.frombuffer(values, kind) if isinstance(values, bytes | bytearray) else np.array(values, kind)


def detection_function(make_detector: Callable[[], Detector], shape: TileShape | None = None, batch_patches: int = 400):
    """A table function of one TABLE argument, a row for each part of a tile:
    coord, the tile; x_km, y_km; side, 'own' or that of the neighbour ('right',
    'bottom', 'corner') that lends the part; width in cells; dsm, its cells row by row
    (numbers, or binary of little-endian floats); rgb, its pixels row by row, three
    bytes each (numbers or binary; null: black).

    Rows are partitioned by coord, which the function asks for itself. For each
    detection it gives coord, all other columns of the tile's own row as they are
    (names and types follow the argument), and patch_row, patch_col, easting,
    northing, confidence, bbox_w_m, bbox_h_m, class_id. A second argument, ``conf``, is
    the least confidence. A tile without its own part or without cells gives nothing;
    of parts of one side the least (cells, then pixels) counts.
    """
    shape = shape or TileShape()

    class DetectBoxes:
        def __init__(self) -> None:
            self.parts: dict[str, Row] = {}
            self.conf = 0.0

        @staticmethod
        def analyze(tiles: AnalyzeArgument, conf: AnalyzeArgument | None = None) -> AnalyzeResult:
            if not tiles.isTable:
                raise ValueError("the first argument must be a table: detect_boxes(TABLE(tiles))")
            fields = {f.name: f for f in tiles.dataType.fields}
            if missing := [n for n in _NEEDED if n not in fields]:
                raise ValueError(f"columns are missing: {missing}")
            carried = [fields["coord"], *(f for n, f in fields.items() if n not in _NEEDED)]
            if clash := sorted({f.name.lower() for f in carried} & {f.name for f in _FOUND}):
                raise ValueError(f"columns that detection adds are there already: {clash}")
            return AnalyzeResult(schema=StructType([*carried, *_FOUND]), partitionBy=[PartitioningColumn("coord")])

        def eval(self, row: Row, conf: float = 0.0) -> None:
            self.conf = conf or 0.0
            if row.side not in SIDES or not row.dsm or not row.width:
                return
            held = self.parts.get(row.side)
            if held is None or (row.dsm, row.rgb or b"") < (held.dsm, held.rgb or b""):
                self.parts[row.side] = row

        def terminate(self) -> Iterator[tuple]:
            own = self.parts.get("own")
            if own is None:
                return
            held = [self.parts.get(n) for n in SIDES]
            grids = [self._dsm(p) if p else None for p in held]
            dsm = mosaic(grids[0], shape.strip, *grids[1:])
            rgb = None
            # a mosaic without any colours is black, and black patches are not shrunk
            if any(p and p.rgb for p in held):
                pixels = [self._rgb(p, len(g)) if p else None for p, g in zip(held, grids, strict=True)]
                rgb = mosaic(pixels[0], shape.strip * shape.scale, *pixels[1:])
            found = fused_patches(rgb, dsm, shape.scale, shape.size, shape.stride)
            carried = [own.coord, *(v for n, v in own.asDict(recursive=False).items() if n not in _NEEDED)]
            west, north = own.x_km * 1000, (own.y_km + 1) * 1000
            for at in range(0, len(found), batch_patches):
                some = found[at : at + batch_patches]
                for (r, c, _), boxes in zip(some, detect_in_halves(_loaded(make_detector), np.stack([p for *_, p in some])), strict=True):
                    x0, y0 = west + c * shape.stride * TARGET_RES, north - r * shape.stride * TARGET_RES
                    for cx, cy, w, h, score, cls in boxes.tolist():
                        if score >= self.conf:
                            yield (*carried, r, c, x0 + TARGET_RES * cx * shape.size, y0 - TARGET_RES * cy * shape.size, score, abs(w * TARGET_RES), abs(h * TARGET_RES), int(cls))

        def _dsm(self, part: Row) -> np.ndarray:
            return _cells(part.dsm, "<f4").reshape(-1, part.width)

        def _rgb(self, part: Row, rows: int) -> np.ndarray:
            wide = part.width * shape.scale
            if not part.rgb:
                return np.zeros((rows * shape.scale, wide, 3), np.uint8)
            return _cells(part.rgb, "u1").reshape(-1, wide, 3)

    return udtf(DetectBoxes)


def register_detection(spark: SparkSession, make_detector: Callable[[], Detector], shape: TileShape | None = None, name: str = "detect_boxes") -> None:
    """Makes :func:`detection_function` known to SQL in this session."""
    spark.udtf.register(name, detection_function(make_detector, shape))
