"""Detection: tiles become fused patches and patches become detections, in one
Python stage, so that only detections leave it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.kernels import mosaic, overhead_shade, patches, shrink
from tilewright.model import DSM_RES, FUSION_CHANNEL, NEIGHBOR_STRIP_DSM, NEIGHBOR_STRIP_RGB, RGB_RES, STRIDE_PX, TARGET_RES, TILE_PX_DSM, TILE_SIZE_PX


class Detector(Protocol):
    """What a model must offer. ``detect`` takes patches (n, 3, size, size) of
    uint8 and gives, for each, rows of (cx, cy, w, h in pixels, confidence, class);
    cx and cy are shares of the patch. Loaded once in each Python worker."""

    def warmup(self) -> None: ...

    def detect(self, batch: np.ndarray) -> list[np.ndarray]: ...


@dataclass
class BrightBlobStub:
    """A deterministic stand-in, no model: one box around the brightest cell of
    each patch's fused band. It makes no claim about what is in an image."""

    confidence: float = 0.1

    def warmup(self) -> None:
        pass

    def detect(self, batch: np.ndarray) -> list[np.ndarray]:
        size = batch.shape[-1]
        bands = batch[:, FUSION_CHANNEL].reshape(len(batch), size * size)
        best = bands.argmax(1)
        scores = bands[np.arange(len(batch)), best] / 255
        boxes = np.stack([(best % size + 0.5) / size, (best // size + 0.5) / size, np.full(len(best), 16.0), np.full(len(best), 16.0), scores, np.zeros(len(best))], axis=1)
        return [boxes[k : k + 1] if scores[k] >= self.confidence else np.empty((0, 6)) for k in range(len(batch))]


#: Colour pixels that are shrunk at once, patches of one tile together; at least one band.
PIXELS_AT_ONCE = 1 << 18


def fused_patches(rgb: np.ndarray | None, dsm: np.ndarray, scale: int, size: int, stride: int) -> list[tuple[int, int, np.ndarray]]:
    """Patches of a mosaic: colours shrunk to the elevation's cells, the fusion
    channel replaced by the shade. rgb: (h, w, 3), None: black; dsm: (h / scale, w / scale)."""
    shade = np.clip(np.rint(overhead_shade(dsm, DSM_RES)), 0, 255).astype(np.uint8)
    shades = patches(shade, size, stride)
    fused = np.zeros((len(shades), 3, size, size), np.uint8)
    for j, (*_, s) in enumerate(shades):
        fused[j, FUSION_CHANNEL] = s
    if rgb is not None:
        colours = [p[..., k] for *_, p in patches(rgb, size * scale, stride * scale) for k in range(3) if k != FUSION_CHANNEL]
        places = [(j, k) for j in range(len(shades)) for k in range(3) if k != FUSION_CHANNEL]
        step = max(1, PIXELS_AT_ONCE // (size * scale) ** 2)
        for at in range(0, len(places), step):
            small = shrink(np.stack(colours[at : at + step]), scale)
            for (j, k), band in zip(places[at : at + step], small, strict=True):
                fused[j, k] = band
    return [(r, c, fused[j]) for j, (r, c, _) in enumerate(shades)]


DETECTED = "tile_id string, patch_id string, easting double, northing double, confidence float, bbox_w_m float, bbox_h_m float, class_id smallint, rgb_source string, dsm_source string"


@dataclass
class TileShape:
    """Sizes of a tile; the defaults are those of production."""

    dsm_px: int = TILE_PX_DSM
    strip: int = NEIGHBOR_STRIP_DSM
    size: int = TILE_SIZE_PX
    stride: int = STRIDE_PX
    scale: int = NEIGHBOR_STRIP_RGB // NEIGHBOR_STRIP_DSM


def detect_in_halves(detector: Detector, batch: np.ndarray) -> list[np.ndarray]:
    """``detector.detect`` over a batch. When memory runs out, parts of half the size
    are tried, and stay that small; a single patch that does not fit is an error."""
    out, at, size = [], 0, len(batch)
    while at < len(batch):
        try:
            out += detector.detect(batch[at : at + size])
        except (MemoryError, RuntimeError) as e:
            if not isinstance(e, MemoryError) and "out of memory" not in str(e).lower():
                raise
            size //= 2
            if not size:
                raise
            continue
        at += size
    return out


def strip_of(load: Callable[..., np.ndarray], url: str, rows: int | None, columns: int | None) -> np.ndarray:
    """The first rows and columns of an image. A loader with the attribute
    ``windowed`` takes them as arguments and reads no more than that."""
    if getattr(load, "windowed", False):
        return load(url, rows, columns)
    return load(url)[:rows, :columns]


def detect_tiles(work: DataFrame, load: Callable[..., np.ndarray], make_detector: Callable[[], Detector], shape: TileShape | None = None, min_elevation: float = 0.0, batch_patches: int = 400, conf: float = 0.0) -> DataFrame:
    """Runs the detector over tiles (coord, x_km, y_km, rgb_url, dsm_url, and the
    structs right, bottom, corner of URLs). load: URL -> array; see strip_of.

    Returns one row for each tile and detection of at least ``conf``, and one for a
    tile without any: the columns of DETECTED (null without a detection), and
    n_patches, skip_reason, error. Elevation is read first, so a low tile costs no
    colours; of neighbours only the strips that they lend are kept, and one counts
    only if both its layers load. Batches take patches of several tiles. A tile that
    fails says why and the others go on; if a batch fails, its tiles are tried one
    by one.
    """
    shape = shape or TileShape()
    kind = DETECTED + ", n_patches int, skip_reason string, error string"
    names = [c.split()[0] for c in kind.split(", ")]

    def bare(row, n: int, reason: str | None, error: str | None) -> tuple:
        return row.coord.replace("-", "_"), *(None,) * 7, row.rgb_url, row.dsm_url, n, reason, error

    def neighbours(row) -> tuple[list, list]:
        near = [], []
        strip = shape.strip
        for side, rows, columns in ((row.right, None, strip), (row.bottom, strip, None), (row.corner, strip, strip)):
            try:
                wide = [None if x is None else x * shape.scale for x in (rows, columns)]
                parts = (strip_of(load, side["dsm_url"], rows, columns), strip_of(load, side["rgb_url"], *wide)) if side is not None else (None, None)
            except OSError:
                parts = None, None
            for found, part in zip(near, parts, strict=True):
                found.append(part)
        return near

    def patches_of(row) -> list | tuple:
        """The patches of a tile, or the row that says why there are none."""
        try:
            dsm = load(row.dsm_url)
            if min_elevation > 0 and dsm.max() < min_elevation:
                return bare(row, 0, "low_elevation", None)
            rgb = load(row.rgb_url)
            near_dsm, near_rgb = neighbours(row)
            return fused_patches(mosaic(rgb, shape.strip * shape.scale, *near_rgb), mosaic(dsm, shape.strip, *near_dsm), shape.scale, shape.size, shape.stride)
        except Exception as e:
            return bare(row, 0, None, str(e)[:500])

    def rows_of(row, found: list, boxes: list[np.ndarray]) -> list[tuple]:
        tile, out = row.coord.replace("-", "_"), []
        for (r, c, _), of_patch in zip(found, boxes, strict=True):
            x0, y0 = row.x_km * 1000 + c * shape.stride * TARGET_RES, (row.y_km + 1) * 1000 - r * shape.stride * TARGET_RES
            for cx, cy, w, h, score, cls in of_patch.tolist():
                if score >= conf:
                    out.append((tile, f"{tile}_{r}_{c}", x0 + TARGET_RES * cx * shape.size, y0 - TARGET_RES * cy * shape.size, score, abs(w * TARGET_RES), abs(h * TARGET_RES), int(cls), row.rgb_url, row.dsm_url, len(found), None, None))
        return out or [bare(row, len(found), None, None)]

    def detected(detector: Detector, held: list[tuple]) -> list[tuple]:
        flat = [p[2] for _, found in held for p in found]
        try:
            boxes = [b for at in range(0, len(flat), batch_patches) for b in detect_in_halves(detector, np.stack(flat[at : at + batch_patches]))]
        except Exception as e:
            if len(held) > 1:
                return [r for one in held for r in detected(detector, [one])]
            return [bare(held[0][0], len(flat), None, str(e)[:500])]
        out, at = [], 0
        for row, found in held:
            out += rows_of(row, found, boxes[at : at + len(found)])
            at += len(found)
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = make_detector()
        detector.warmup()
        held: list[tuple] = []
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                found = patches_of(row)
                if isinstance(found, tuple):
                    yield pd.DataFrame([found], columns=names)
                    continue
                held.append((row, found))
                if sum(len(f) for _, f in held) >= batch_patches:
                    yield pd.DataFrame(detected(detector, held), columns=names)
                    held = []
        if held:
            yield pd.DataFrame(detected(detector, held), columns=names)

    return work.mapInPandas(run, kind)


def detections_of(results: DataFrame) -> DataFrame:
    return results.where("easting is not null").select(*[c.split()[0] for c in DETECTED.split(", ")])


def outcomes_of(results: DataFrame) -> DataFrame:
    """tile_id, n_detections, skip_reason, error of every tile that was tried."""
    return results.groupBy("tile_id").agg(F.count("easting").cast("int").alias("n_detections"), F.max("skip_reason").alias("skip_reason"), F.max("error").alias("error"))


assert round(DSM_RES / RGB_RES) == NEIGHBOR_STRIP_RGB // NEIGHBOR_STRIP_DSM
