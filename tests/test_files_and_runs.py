"""Images as TIFF, the shared cache, batches of patches across tiles, runs from end to end."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
from test_operators import SHAPE, load, work

from tilewright.functions import tiff
from tilewright.functions.joins import spread_join
from tilewright.functions.kernels import pca_fusion
from tilewright.operators import dedup, patches
from tilewright.operators.detect import BrightBlobStub, detect_in_halves, detect_tiles, outcomes_of, strip_of
from tilewright.operators.graph import connected_components
from tilewright.operators.pseudo import pseudo_label_rounds
from tilewright.run import RunSettings, box_around_coords, run
from tilewright.sources import files, store


@pytest.mark.parametrize("kind", ["u1", "u2", "i2", "f4", "f8"])
def test_images_and_their_windows(kind):
    rng = np.random.default_rng(1)
    for shape in ((70, 33), (130, 50, 3), (1, 1)):
        image = (rng.normal(size=shape) * 50 + 100).astype(kind)
        data = tiff.write(image, 0.5, 2_600_000.0, -0.5, 1_200_000.0)
        at = tiff.layout(data)
        assert (at.a, at.c, at.e, at.f) == (0.5, 2_600_000.0, -0.5, 1_200_000.0) and (at.height, at.width) == shape[:2]
        assert (tiff.read(data) == image).all() and tiff.read(data).dtype == image.dtype
        assert (tiff.read(data, (20, 66), (5, 40)) == image[20:66, 5:40]).all()
    with pytest.raises(ValueError):
        tiff.read(b"JFIF and so on")


def big_endian_tiles(image: np.ndarray, side: int) -> bytes:
    """The image in deflated tiles with horizontal differences, the other byte order."""
    h, w = image.shape
    parts = []
    for r in range(0, h, side):
        for c in range(0, w, side):
            tile = np.zeros((side, side), ">u2")
            part = image[r : r + side, c : c + side]
            tile[: part.shape[0], : part.shape[1]] = part
            tile[:, 1:] = np.diff(tile.astype("u2"), axis=1)
            parts.append(zlib.compress(tile.tobytes()))
    starts = np.cumsum([8, *map(len, parts)]).tolist()
    at = starts[-1]
    n = len(parts)
    tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [16]), (259, 3, [8]), (277, 3, [1]), (317, 3, [2]), (322, 4, [side]), (323, 4, [side]), (324, 4, starts[:-1]), (325, 4, [len(p) for p in parts])]
    body, more, far = b"", b"", at + 2 + 12 * len(tags) + 4
    for tag, code, values in tags:
        packed = struct.pack(f">{len(values)}{'HI'[code == 4]}", *values)
        body += struct.pack(">HHI", tag, code, len(values)) + (packed.ljust(4, b"\0") if len(packed) <= 4 else struct.pack(">I", far + len(more)))
        more += packed if len(packed) > 4 else b""
    assert n > 1
    return struct.pack(">2sHI", b"MM", 42, at) + b"".join(parts) + struct.pack(">H", len(tags)) + body + struct.pack(">I", 0) + more


def test_tiled_images_of_the_other_byte_order():
    image = np.random.default_rng(2).integers(0, 2**16, (50, 70)).astype("u2")
    data = big_endian_tiles(image, 32)
    assert (tiff.read(data) == image).all() and (tiff.read(data, (30, 41), (31, 66)) == image[30:41, 31:66]).all()


def lzw(data: bytes) -> bytes:
    """Compressed as TIFF does it, by the plain rule."""
    table, width, bits, held = {bytes([k]): k for k in range(256)}, 9, [(256, 9)], b""
    size = 258
    for b in data:
        if held + bytes([b]) in table:
            held += bytes([b])
            continue
        bits.append((table[held], width))
        table[held + bytes([b])] = size
        size += 1
        width = max(width, (size).bit_length())
        held = bytes([b])
        if size == 4094:
            bits.append((table[held], width))
            bits.append((256, width))
            table, width, size, held = {bytes([k]): k for k in range(256)}, 9, 258, b""
    if held:
        bits.append((table[held], width))
        width = max(width, (size + 1).bit_length())
    bits.append((257, width))
    text = "".join(format(code, f"0{w}b") for code, w in bits)
    return int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big")


@pytest.mark.parametrize("n", [1, 5, 300, 3000])
def test_lzw(n):
    data = bytes(np.random.default_rng(n).integers(0, 4, n).astype(np.uint8))
    assert tiff._lzw(lzw(data)) == data


def test_broken_images_are_named(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(tiff.write(np.ones((3, 4), np.uint8)))
    (tmp_path / "b.TIF").write_bytes(b"no image")
    (tmp_path / "c.png").write_bytes(b"")
    assert [r.file_name for r in files.list_patches(spark, str(tmp_path)).collect()] == ["a.tif"]
    found = {r.file_name: (r.width, r.height) for r in files.read_patches(spark, str(tmp_path), any_case=True).collect()}
    assert found == {"a.tif": (4, 3), "b.TIF": (None, None)}


def test_fusion_of_files(spark):
    rng = np.random.default_rng(4)
    colour, shade = rng.integers(0, 255, (8, 9, 3)).astype(np.uint8), rng.integers(0, 255, (8, 9)).astype(np.uint8)
    table = "file_name string, content binary"
    colours = spark.createDataFrame([("a.tif", tiff.write(colour, 0.5, 7.0, -0.5, 9.0)), ("b.tif", tiff.write(colour))], table)
    paired, bare = patches.pair_patches(colours, spark.createDataFrame([("a.tif", tiff.write(shade)), ("z.tif", tiff.write(shade))], table))
    assert [r.file_name for r in bare.collect()] == ["b.tif"]
    data = bytes(patches.fuse_files(paired, patches.replaced(2)).first().content)
    assert (tiff.read(data)[..., 2] == shade).all() and (tiff.read(data)[..., :2] == colour[..., :2]).all() and tiff.layout(data).c == 7.0
    assert (tiff.read(bytes(patches.fuse_files(paired, patches.FILE_FUSIONS["pca"]).first().content)) == pca_fusion(colour, shade)).all()


def test_cache_fetches_once(tmp_path):
    calls = []

    def fetch(url):
        calls.append(url)
        return b"bytes"

    for _ in range(2):
        path = files.ensure_cached("http://host/x/tile.tif", str(tmp_path / "cache"), fetch)
    assert open(path, "rb").read() == b"bytes" and len(calls) == 1
    with pytest.raises(OSError):
        files.ensure_cached("http://host/y.tif", str(tmp_path / "cache"), lambda url: (_ for _ in ()).throw(OSError("gone")))


def limited():
    """A detector that runs out of memory beyond three patches, and fails on bright ones; it travels to the workers by value."""

    class Limited(BrightBlobStub):
        def detect(self, batch):
            if len(batch) > 3:
                raise RuntimeError("CUDA out of memory")
            if batch[:, 0].max() > 250:
                raise ValueError("too bright")
            return [np.array([[0.5, 0.5, 16, 16, 0.9, 0]]) for _ in batch]

    return Limited


def test_batches_are_halved_and_failures_stay_with_their_tile(spark):
    batch = np.zeros((10, 3, 16, 16), np.uint8)
    make = limited()
    assert len(detect_in_halves(make(), batch)) == 10
    with pytest.raises(MemoryError):
        detect_in_halves(type("None_", (), {"detect": lambda self, b: (_ for _ in ()).throw(MemoryError())})(), batch)

    def bright(url):
        image = load(url)
        return np.full_like(image, 255) if url == "white_rgb" else image

    results = detect_tiles(work(spark, ["ok", "white", "fine"]).coalesce(1), bright, make, SHAPE, batch_patches=60)
    by = {r.tile_id: (r.n_detections, r.error) for r in outcomes_of(results).collect()}
    assert by == {"2600_1140": (25, None), "2601_1140": (0, "too bright"), "2602_1140": (25, None)}
    assert detect_tiles(work(spark, ["ok"]), load, BrightBlobStub, SHAPE, conf=1.1).where("easting is not null").count() == 0


def test_strips_are_asked_for():
    asked = []

    def windowed(url, rows, columns):
        asked.append((rows, columns))
        return np.zeros((rows or 40, columns or 40))

    windowed.windowed = True
    assert strip_of(windowed, "u", None, 8).shape == (40, 8) and asked == [(None, 8)]
    assert strip_of(load, "n_dsm", 8, None).shape == (8, 40)


def test_one_source_of_tiles():
    for bad in ({}, {"bbox": "1,2,3,4", "whole_country": True}, {"rgb_urls": "a"}):
        with pytest.raises(ValueError):
            RunSettings("out", **bad)


def test_box_of_coordinates(spark):
    """The corners of the box that the published check values lie in."""
    found = box_around_coords(spark.createDataFrame([(2600, 1200), (2601, 1199)], "x_km int, y_km int"), 0).first()
    assert (found.min_e, found.min_n, found.max_e, found.max_n) == (2600000, 1199000, 2602000, 1201000)
    west, south, east, north = map(float, found.bbox.split(","))
    assert west <= 7.4386 < east and south < 46.9511 < north and east - west < 0.03 and north - south < 0.02


def test_run_and_resume(spark, tmp_path):
    items = [(k, layer, f"x_2020_{c}", f"{c}_{layer}") for k, (c, layer) in enumerate((c, layer) for c in ("2600-1140", "2601-1140", "2601-1139") for layer in ("rgb", "dsm"))]
    asked = []

    def catalogue(bbox):
        asked.append(bbox)
        return spark.createDataFrame(items, "seq int, layer string, item_id string, href string")

    settings = RunSettings(str(tmp_path / "out"), coords=("2601-1140", "2600-1140", "2999-1000"), min_elevation=0)
    first = {r.tile_id: r.n_detections for r in run(spark, settings, catalogue, load, BrightBlobStub, "1", SHAPE, str(tmp_path / "layer")).collect()}
    assert set(first) == {"2600_1140", "2601_1140"} and min(first.values()) > 0
    n = store.all_detections(spark, settings.output).count()
    assert spark.read.parquet(str(tmp_path / "layer")).count() == n > 0
    run(spark, settings, catalogue, load, BrightBlobStub, "2", SHAPE)
    assert store.all_detections(spark, settings.output).count() == n and len(asked) == 1
    everything = RunSettings(str(tmp_path / "out"), whole_country=True, min_elevation=0)
    assert {r.tile_id for r in run(spark, everything, catalogue, load, BrightBlobStub, "3", SHAPE).collect()} == {*first, "2601_1139"}


def test_rounds_end_with_the_pool(spark):
    pool = spark.createDataFrame([(f"i{k}",) for k in range(5)], "img string")
    preds = spark.createDataFrame([(f"i{k}", float(k)) for k in range(1, 5)], "img string, conf double")
    seen = []
    labels, left = pseudo_label_rounds(pool, lambda p, k: preds.join(p, "img"), rounds=4, n=2, learn=lambda found, k: seen.append(found.count()))
    assert sorted((r.img, r["round"]) for r in labels.collect()) == [("i1", 1), ("i2", 1), ("i3", 0), ("i4", 0)]
    assert left.count() == 0 and seen == [2, 4, 4, 4]


def test_suppression_by_rounds_is_that_of_each_tile(spark):
    rng = np.random.default_rng(7)
    rows = [(f"t{k % 3}", k // 3, *(p := rng.uniform(0, 60, 2)).tolist(), *(p + rng.uniform(0, 25, 2)).tolist()) for k in range(400)] + [("t9", 1, 0.0, 0.0, 0.0, 0.0)]
    boxes = spark.createDataFrame(rows, "tile_id string, rk int, xmin double, ymin double, xmax double, ymax double")
    a, b = (sorted((r.tile_id, r.rk) for r in f(boxes, 0.3).collect()) for f in (dedup.nms, dedup.nms_by_rounds))
    assert a == b and 0 < len(a) < len(rows)


def test_joins_of_hot_keys(spark):
    left = spark.range(3000).selectExpr("if(id < 2000, 'hot', concat('k', id % 50)) as key", "id").unionByName(spark.createDataFrame([(None, 5000)], "key string, id long"))
    right = spark.createDataFrame([("hot", 1), ("k7", 2), ("zz", 3)], "key string, v int")
    found = spread_join(left, right, ["key"], by=["id"], ways=8)
    assert sorted(map(str, found.select("key", "id", "v").collect())) == sorted(map(str, left.join(right, "key", "left").select("key", "id", "v").collect()))


def test_components_of_a_star_and_a_long_path(spark):
    edges = [(1, 1000 + k) for k in range(500)] + [(5000 + k, 5001 + k) for k in range(300)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(found.values()) == {1, 5000} and len(found) == 501 + 301


def test_known_files_are_read_by_few_tasks(spark, tmp_path):
    from tilewright.sources.files import TASKS_PER_CORE, read_annotations, read_texts, write_files

    rows = spark.range(700).selectExpr("concat('d', id % 3, '/', id, '.json') as file_path", """concat('{"info":{}, "dataset":[{"file_name":"', id, '","coord":[0,0,1,1],"rocks_annotations":[{"relative_within_patch_location":[0.5,', id, ']}]}]}') as content""")
    put = write_files(rows, f"file://{tmp_path}").localCheckpoint()
    found = read_texts(put, f"file://{tmp_path}")
    assert found.rdd.getNumPartitions() == TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))
    listed, known = (sorted(map(tuple, x[1].collect())) for x in (read_annotations(spark, f"file://{tmp_path}/*"), read_annotations(spark, f"file://{tmp_path}", put)))
    assert listed == known and len(known) == 700
