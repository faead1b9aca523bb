from __future__ import annotations

import json
import math
import random
import struct
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tilewright.functions import geo, kernels
from tilewright.operators import datasets, dedup, raster, tiles
from tilewright.operators.detect import BrightBlobStub, TileShape, detect_tiles, detections_of, outcomes_of
from tilewright.sources import stac, store
from tilewright.streaming.tiles import run_stream, store_batch

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers cannot import tests


def points(spark, rows):
    return spark.createDataFrame([(t, k, float(x), float(y)) for k, (t, x, y) in enumerate(rows)], "tile_id string, rk long, easting double, northing double")


def test_dedup_keeps_what_is_just_at_the_radius(spark):
    rows = [("a", 0, 0), ("a", 7.5, 0), ("a", 14.9, 0), ("a", 0, 7.4), ("b", 0, 0), ("b", 0, 0), ("c", -3, 2)]
    for f in (dedup.dedup_per_tile, dedup.dedup_by_rounds):
        kept = f(points(spark, rows)).collect()
        # 14.9 is near 7.5, which is kept; tiles do not see each other
        assert sorted(r.rk for r in kept) == [0, 1, 4, 6]


def test_both_dedups_agree_with_the_plain_rule(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(40) * 1.5, rng.randrange(40) * 1.5) for _ in range(400)]
    expected = set()
    for t in "ab":
        kept = []
        for k, (tile, x, y) in enumerate(rows):
            if tile == t and all((x - a) ** 2 + (y - b) ** 2 >= 56.25 for a, b in kept):
                kept.append((x, y))
                expected.add(k)
    for f in (dedup.dedup_per_tile, dedup.dedup_by_rounds):
        assert {r.rk for r in f(points(spark, rows)).collect()} == expected
    assert dedup.dedup_per_tile(points(spark, []).limit(0)).count() == 0


def test_matching_is_greedy_by_overlap(spark):
    rng = random.Random(2)

    def box():
        x, y = rng.randrange(30), rng.randrange(30)
        return float(x), float(y), x + 12.0, y + 12.0

    p = [(rng.choice("xy"), k, 0, *box()) for k in range(30)]
    t = [(rng.choice("xy"), k, 0, *box()) for k in range(30)]
    kind = "img string, {} long, cls int, xmin double, ymin double, xmax double, ymax double"

    def overlap(a, b):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        shared = max(w, 0) * max(h, 0)
        return shared / (288 - shared)

    pairs = sorted((-overlap(a[3:], b[3:]), a[1], b[1]) for a in p for b in t if a[0] == b[0] and overlap(a[3:], b[3:]) > 0.3)
    used_p, used_t, expected = set(), set(), set()
    for _, a, b in pairs:
        if a not in used_p and b not in used_t:
            used_p.add(a)
            used_t.add(b)
            expected.add((a, b))
    found = dedup.matched(spark.createDataFrame(p, kind.format("p_id")), spark.createDataFrame(t, kind.format("t_id")), 0.3)
    assert {(r.p_id, r.t_id) for r in found.collect()} == expected


def test_newest_falls_back_and_ties_go_to_the_first(spark):
    rows = [(3, "rgb", "i_2020_2600-1100", "c.tif"), (1, "rgb", "i_2020_2600-1100", "a.tif"), (2, "rgb", "i_2021_2600-1100", None), (4, "rgb", "i_2600-1101", "d.tif"), (5, "rgb", "nothing", "e.tif")]
    items = spark.createDataFrame(rows, "seq long, layer string, item_id string, href string")
    assert sorted((r.coord, r.href, r.yr) for r in tiles.newest_per_coord(items).collect()) == [("2600-1100", "a.tif", 2020), ("2600-1101", "d.tif", 0)]


def test_requested_coords_keep_the_users_order(spark):
    coords = spark.createDataFrame([(0, "c"), (1, "a"), (2, "c"), (3, "zz")], "pos int, coord string")
    found = tiles.requested_coords(spark.createDataFrame([("a",), ("b",), ("c",)], "coord string"), coords)
    assert [r.coord for r in found.collect()] == ["c", "a"]


def test_elevation_rule(spark):
    rows = spark.createDataFrame([(1, [1.0, 5.0]), (2, [7.0]), (3, [float("nan"), 1.0]), (4, [6.0])], "id int, z array<double>")
    assert [r.skip_reason for r in tiles.elevation_outcome(rows, 6.0).orderBy("id").collect()] == ["low_elevation", None, None, None]
    assert tiles.elevation_outcome(rows, 0.0).where("skip_reason is not null").count() == 0


def test_eviction_over_slices(spark):
    rows = spark.createDataFrame([(k, f"2024-01-{1 + k % 28:02d} 00:00:00", 10) for k in range(100)], "file_id long, at string, size long").select("file_id", F.to_timestamp("at").alias("mtime"), "size")
    one = tiles.evict_oldest(rows, 300).collect()
    many = tiles.evict_oldest(rows, 300, per_range=7).collect()
    assert len(one) == 70 and {r.file_id for r in one} == {r.file_id for r in many}


def test_split_is_disjoint_and_whole(spark):
    rows = [(k, k // 4, 4) for k in range(80)] + [(100, 100, 1)]
    split = datasets.group_split(spark.createDataFrame(rows, "idx long, grp long, n long")).collect()
    by_group = {}
    for r in split:
        by_group.setdefault(r.idx // 4, set()).add(r.split)
    assert len(split) == 80 and all(len(s) == 1 for s in by_group.values())
    assert [sum(s == {x} for s in by_group.values()) for x in ("val", "test", "train")] == [2, 2, 16]


def test_pseudo_labels_leave_the_pool(spark):
    images = spark.createDataFrame([("a",), ("b",), ("c",)], "img string")
    preds = spark.createDataFrame([("a", 0, 0.0, 0.0, 64.0, 32.0, 0.4), ("c", 0, 0.0, 0.0, 64.0, 32.0, 0.9)], "img string, cls int, x1 double, y1 double, x2 double, y2 double, conf double")
    labels, pool = datasets.select_pseudo_labels(images, preds, 1)
    assert [tuple(r) for r in labels.collect()] == [("c", 0, 0.05, 0.025, 0.1, 0.05)]
    assert sorted(r.img for r in pool.collect()) == ["a", "b"]


def test_scores_with_nothing_found(spark):
    empty = spark.createDataFrame([], "pred_cls int, true_cls int, n long")
    r = datasets.scores(empty, 1).first()
    assert (r.tp, r.precision, r.recall, r.f1) == (0, 0, 0, 0)


def test_wkb_of_boxes(spark):
    rows = [(2600000.25, 1140000.5, 2600001.0, 1140003.125), (-1.0, 0.0, 0.1, 1e-9), (0.0, -2.0**40, 3.0, 1.0)]
    found = spark.createDataFrame(rows, "a double, b double, c double, d double").select(geo.box_wkb(*[F.col(x) for x in "abcd"])).collect()
    for (wkb,), (a, b, c, d) in zip(found, rows, strict=True):
        assert struct.unpack(">BIII10d", bytes(wkb)) == (0, 3, 1, 5, c, b, c, d, a, d, a, b, c, b)


# --- pixels


def test_shade_of_flat_and_steep_ground():
    flat, steep = np.full((50, 50), 1000.0), np.tile(2.0 * np.arange(50), (50, 1))
    a, b = kernels.overhead_shade(flat, 0.5), kernels.overhead_shade(steep, 0.5)
    assert a.mean() > 250 and a.mean() > b[10:-10, 10:-10].mean()
    assert b[25, 25] == pytest.approx(255 / math.sqrt(17))


def test_small_grids_agree_with_the_kernel(spark):
    z = np.random.default_rng(1).integers(0, 50, (8, 8))
    found = spark.createDataFrame([(z.ravel().tolist(),)], "z array<int>").select(raster.overhead_shade(F.col("z"), 8, 8, 2.0)).first()[0]
    assert np.allclose(np.array(found).reshape(8, 8), kernels.overhead_shade(z, 2.0))


def test_shrinking_keeps_flat_bands_and_ramps():
    assert (kernels.shrink(np.full((50, 50), 77, np.uint8), 5) == 77).all()
    ramp = np.tile(np.arange(200, dtype=np.uint8), (200, 1))
    assert np.abs(kernels.shrink(ramp, 5)[10, 4:-4].astype(int) - (np.arange(40) * 5 + 2)[4:-4]).max() <= 1
    for scale in (4, 5):
        w = kernels.cubic_weights(scale)[1]
        assert w.sum() == pytest.approx(1) and np.allclose(np.trim_zeros(w.round(12)), np.trim_zeros(w.round(12))[::-1])


def test_pca_fills_the_range():
    rng = np.random.default_rng(2)
    out = kernels.pca_fusion(rng.integers(0, 255, (20, 20, 3)), rng.integers(0, 255, (20, 20)))
    assert out.shape == (20, 20, 3) and out.min() == 0 and out.max() == 255
    assert (kernels.pca_fusion(np.ones((4, 4, 3)), np.ones((4, 4))) == 0).all()


def test_replace_channel_refuses_other_bands():
    with pytest.raises(ValueError):
        raster.replace_channel(*[F.lit(1)] * 4, channel=3)


# --- from tiles to stored detections

SHAPE = TileShape(dsm_px=40, strip=8, size=16, stride=8, scale=5)


def load(url: str) -> np.ndarray:
    if "bad" in url:
        raise OSError("gone")
    if "dsm" in url:
        return np.full((40, 40), 5.0 if "low" in url else 1000.0)
    return np.full((200, 200, 3), 128, np.uint8)


def work(spark, names, neighbours=(True, True, True)):
    def urls(name):
        return (f"{name}_rgb", f"{name}_dsm")

    rows = [(f"26{k:02d}-1140", 2600 + k, 1140, *urls(n), *[urls("n") if x else None for x in neighbours]) for k, n in enumerate(names)]
    side = "struct<rgb_url: string, dsm_url: string>"
    return spark.createDataFrame(rows, f"coord string, x_km int, y_km int, rgb_url string, dsm_url string, right {side}, bottom {side}, corner {side}")


@pytest.mark.parametrize("neighbours", [(False, False, False), (True, False, False), (False, True, False), (True, True, False), (True, True, True)])
def test_grid_is_whole_whatever_the_neighbours(spark, neighbours):
    found = detect_tiles(work(spark, ["ok"], neighbours), load, BrightBlobStub, SHAPE).collect()
    assert len(found) == 25 and {r.n_patches for r in found} == {25}
    assert {tuple(map(int, r.patch_id.split("_")[2:])) for r in found} == {(i, j) for i in range(5) for j in range(5)}


def test_skipped_and_failed_tiles(spark):
    results = detect_tiles(work(spark, ["ok", "low", "bad"]), load, BrightBlobStub, SHAPE, min_elevation=100)
    by = {r.tile_id: r for r in outcomes_of(results).collect()}
    assert (by["2600_1140"].n_detections, by["2601_1140"].skip_reason, by["2602_1140"].error) == (25, "low_elevation", "gone")
    first = detections_of(results).where("patch_id = '2600_1140_0_0'").first()
    assert 2600000 <= first.easting <= 2600008 and 1140992 <= first.northing <= 1141000


def test_patches_are_the_same_twice():
    from tilewright.operators.detect import fused_patches

    rng = np.random.default_rng(3)
    rgb, dsm = rng.integers(0, 255, (240, 240, 3)).astype(np.uint8), rng.normal(size=(48, 48))
    a, b = (fused_patches(rgb, dsm, 5, 16, 8) for _ in range(2))
    assert [x[:2] for x in a] == [x[:2] for x in b] and all((x[2] == y[2]).all() and x[2].dtype == np.uint8 and x[2].shape == (3, 16, 16) for x, y in zip(a, b, strict=True))


def test_storing_a_batch_twice_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    store.create_tables(spark, root)
    results = detect_tiles(work(spark, ["ok", "low", "bad"]), load, BrightBlobStub, SHAPE, min_elevation=100)
    for _ in range(2):
        store_batch(results, root, 7)
    kept = store.all_detections(spark, root)
    done = {r.tile_id: r.skip_reason for r in store.processed_tiles(spark, root).collect()}
    assert done == {"2600_1140": None, "2601_1140": "low_elevation"}
    assert 0 < kept.count() < 25
    left = tiles.remaining(work(spark, ["ok", "low", "bad"]), store.processed_tiles(spark, root))
    assert [r.tile_id for r in left.collect()] == ["2602_1140"]
    out = store.export_layer(kept, f"{root}/layer")
    assert spark.read.parquet(out).where("geometry is not null and srid = 2056").count() == kept.count()
    assert store.export_layer(kept.limit(0), f"{root}/none") is None


def test_stream_of_tiles(spark, tmp_path):
    root = str(tmp_path / "store")
    store.create_tables(spark, root)
    df = work(spark, ["ok", "low"])
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    run_stream(stream, lambda d: detect_tiles(d, load, BrightBlobStub, SHAPE, min_elevation=100), root, str(tmp_path / "cp")).awaitTermination()
    assert store.processed_tiles(spark, root).count() == 2


def test_catalogue_cache(spark, tmp_path):
    root = str(tmp_path)
    store.create_tables(spark, root)
    pairs = spark.createDataFrame([("2601-1100", "r", "d"), ("2600-1100", "r", "d")], "coord string, rgb_url string, dsm_url string")
    assert store.load_catalogue(spark, root, "1,2,3,4") is None
    for _ in range(2):
        store.save_catalogue(pairs, root, "1,2,3,4")
    store.save_catalogue(pairs.limit(0), root, "none")
    assert [r.coord for r in store.load_catalogue(spark, root, "1,2,3,4").collect()] == ["2600-1100", "2601-1100"]
    assert store.load_catalogue(spark, root, "none").count() == 0


def test_saved_pages_and_url_lists(spark, tmp_path):
    page = {"features": [{"id": "x_2020_2600-1100", "assets": {"a": {"href": "no.TIF"}, "b": {"href": "yes.tif"}, "c": {"href": "later.tif"}}}, {"id": "y", "assets": {}}]}
    (tmp_path / "p.json").write_text(json.dumps(page))
    rows = stac.read_saved_pages(spark, str(tmp_path / "p.json"), "rgb").orderBy("seq").collect()
    assert [(r.item_id, r.href) for r in rows] == [("x_2020_2600-1100", "yes.tif"), ("y", None)]
    (tmp_path / "rgb.csv").write_text("http://h/a_2600-1100.tif\n\nnonsense\nhttp://h/b_2600-1100.tif \n")
    (tmp_path / "dsm.csv").write_text("http://h/d_2600-1100.tif\nhttp://h/d_2601-1100.tif")
    pairs = tiles.url_list_pairs(*[stac.read_url_list(spark, str(tmp_path / f"{n}.csv")) for n in ("rgb", "dsm")])
    assert [tuple(r) for r in pairs.collect()] == [("2600-1100", "http://h/b_2600-1100.tif", "http://h/d_2600-1100.tif")]


def test_live_catalogue_follows_its_pages(spark, tmp_path):
    folder = tmp_path / "collections" / "c"
    folder.mkdir(parents=True)
    second = folder / "second"
    second.write_text(json.dumps({"features": [{"id": "b", "assets": {}}], "links": []}))
    (folder / "items?limit=100").write_text(json.dumps({"features": [{"id": "a", "assets": {"t": {"href": "a.tif"}}}], "links": [{"rel": "next", "href": f"file://{second}"}]}))
    spark.dataSource.register(stac.StacSource)
    rows = spark.read.format("stac").option("root", f"file://{tmp_path}").option("collections", "c").load().orderBy("seq").collect()
    assert [(r.layer, r.item_id, r.href) for r in rows] == [("c", "a", "a.tif"), ("c", "b", None)]


def test_label_tree_and_metrics(spark, tmp_path):
    rows = spark.createDataFrame([("a", "0 1", "val"), ("b", "", "train")], "file_name string, label string, split string")
    store.write_label_tree(rows, str(tmp_path / "labels"))
    assert spark.read.parquet(str(tmp_path / "labels/split=val")).count() == 1
    store.write_metrics(spark.createDataFrame([(0.123456,)], "precision double"), str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).first()[0] == "0.1235"
