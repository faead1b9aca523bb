from __future__ import annotations

import numpy as np
import pytest
from pyspark.errors import AnalysisException

from tilewright.operators.detect import BrightBlobStub, TileShape, detect_tiles, detections_of
from tilewright.operators.table_function import register_detection

SHAPE = TileShape(dsm_px=20, strip=4, size=8, stride=4, scale=2)


def test_same_detections_as_the_stage(spark):
    # within the test, so that workers get them by value
    def layers(x: int, y: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(x * 100 + y)
        return rng.integers(0, 6, (20, 20)).astype("<f4"), rng.integers(0, 256, (40, 40, 3)).astype("u1")

    def load(url: str) -> np.ndarray:
        layer, x, y = url.split("/")
        return layers(int(x), int(y))[layer == "rgb"]

    register_detection(spark, BrightBlobStub, SHAPE)
    places = [(x, y) for x in range(2) for y in range(2)]
    parts, work = [], []
    for x, y in places:
        near = {"own": (x, y), "right": (x + 1, y), "bottom": (x, y - 1), "corner": (x + 1, y - 1)}
        urls = {}
        for side, at in near.items():
            if at not in places:
                continue
            dsm, rgb = layers(*at)
            rows, columns = (None if side in ("own", "right") else 4), (None if side in ("own", "bottom") else 4)
            dsm, rgb = dsm[:rows, :columns], rgb[: rows and 8, : columns and 8]
            parts.append((f"{x}-{y}", x, y, side, dsm.shape[1], bytearray(dsm.tobytes()), bytearray(rgb.tobytes()), f"note {side}"))
            urls[side] = {"rgb_url": f"rgb/{at[0]}/{at[1]}", "dsm_url": f"dsm/{at[0]}/{at[1]}"}
        work.append((f"{x}-{y}", x, y, urls["own"]["rgb_url"], urls["own"]["dsm_url"], urls.get("right"), urls.get("bottom"), urls.get("corner")))
    kind = "coord string, x_km int, y_km int, side string, width int, dsm binary, rgb binary, note string"
    spark.createDataFrame([*parts, parts[0], ("9-9", 9, 9, "right", 4, parts[0][5], None, "x"), ("8-8", 8, 8, "own", 20, None, None, "y")], kind).repartition(3).createOrReplaceTempView("parts")
    found = spark.sql("select * from detect_boxes(table(parts), conf => 0.2D)").collect()
    sides = "struct<rgb_url: string, dsm_url: string>"
    tiles = spark.createDataFrame(work, f"coord string, x_km int, y_km int, rgb_url string, dsm_url string, right {sides}, bottom {sides}, corner {sides}")
    expected = detections_of(detect_tiles(tiles, load, BrightBlobStub, SHAPE, conf=0.2)).collect()
    assert found and sorted((r.coord, r.easting, r.northing, r.confidence, r.note) for r in found) == sorted((r.tile_id.replace("_", "-"), r.easting, r.northing, r.confidence, "note own") for r in expected)


def test_columns_follow_the_argument(spark):
    register_detection(spark, BrightBlobStub, SHAPE)
    spark.sql("select 7L as coord, 1 as x_km, 2 as y_km, 'own' as side, 20 as width, array_repeat(1.0F, 400) as dsm, cast(null as binary) as rgb, map('k', 1) as m").createOrReplaceTempView("flat")
    rows = spark.sql("select * from detect_boxes(table(flat))").collect()
    assert len(rows) == 25 and {r.coord for r in rows} == {7} and rows[0].m == {"k": 1}
    assert spark.sql("select * from detect_boxes(table(select * from flat limit 0))").count() == 0
    with pytest.raises(AnalysisException, match="columns are missing"):
        spark.sql("select * from detect_boxes(table(select 1 as coord))")
    with pytest.raises(AnalysisException, match="already"):
        spark.sql("select * from detect_boxes(table(select *, 1 as easting from flat))")
    with pytest.raises(AnalysisException, match="must be a table"):
        spark.sql("select * from detect_boxes(1)")


def test_patches_of_a_tile_are_shrunk_together(monkeypatch):
    from tilewright.functions.kernels import shrink
    from tilewright.operators import detect

    calls = []
    monkeypatch.setattr(detect, "shrink", lambda band, scale: calls.append(band.shape) or shrink(band, scale))
    rng = np.random.default_rng(3)
    dsm, rgb = rng.integers(0, 6, (24, 24)).astype("<f4"), rng.integers(0, 256, (72, 72, 3)).astype("u1")
    found = detect.fused_patches(rgb, dsm, 3, 8, 4)
    assert len(calls) == 1
    for r, c, bands in found:
        alone = rgb[r * 12 : r * 12 + 24, c * 12 : c * 12 + 24]
        assert all((bands[k] == shrink(alone[..., k], 3)).all() for k in (0, 2))
    # without colours nothing is shrunk, and patches are those of a black mosaic
    bare, black = detect.fused_patches(None, dsm, 3, 8, 4), detect.fused_patches(rgb * 0, dsm, 3, 8, 4)
    assert len(calls) == 2 and all((p == q).all() for (*_, p), (*_, q) in zip(bare, black, strict=True))
    # patches that are large are shrunk one band at a time
    monkeypatch.setattr(detect, "PIXELS_AT_ONCE", 1)
    one = detect.fused_patches(rgb, dsm, 3, 8, 4)
    assert len(calls) == 2 + 50 and all((p == q).all() for (*_, p), (*_, q) in zip(found, one, strict=True))
    assert BrightBlobStub().detect(np.empty((0, 3, 8, 8), np.uint8)) == []
