"""The registered queries see every row of their tables, however many there are."""

from __future__ import annotations

import os

import pytest

from tilewright.plans import catalogue
from tilewright.plans.fixtures import view

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the general tables are not here")

GRIDS = ["low_elevation_skip", "hillshade_overhead", "fuse_replace", "fuse_blend", "fuse_blackout", "fuse_multiply", "channel_replace", "mosaic_zero_pad"]


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.mark.parametrize("name", GRIDS)
def test_a_grid_for_each_embedding(spark, name):
    ids = sorted(r.vec_id for r in table(spark, "embeddings").select("vec_id").collect())
    assert sorted(r.vec_id for r in catalogue.QUERIES[name](spark, SF).select("vec_id").collect()) == ids


def test_mosaic_of_grids_beyond_the_first_hundred(spark):
    """Against plain Python: strips come from the ids one east and ten south."""
    z = {r.vec_id: [1500 + int(round(v * 100)) for v in r.embedding] for r in table(spark, "embeddings").collect()}
    found = {r.vec_id: list(r.mosaic) for r in catalogue.QUERIES["mosaic_zero_pad"](spark, SF).collect()}
    for i in (95, 99, 100, 109, 110, max(z) - 1, max(z)):
        east = i % 10 < 9
        right, bottom, corner = z.get(i + 1) if east else None, z.get(i - 10), z.get(i - 9) if east else None
        parts = [[z[i], right], [bottom, corner]]
        expected = [(parts[r // 8][c // 8] or [0] * 64)[r % 8 * 8 + c % 8] for r in range(10) for c in range(10)]
        assert found[i] == expected


def test_log_of_all_orders(spark):
    """Every order is a line of the log, the table has the last line of each key,
    and both done and undone tiles are there for resume."""
    log = [(r.tile_id, r.processed_at, r.seq, r.n_detections, r.skip_reason) for r in view(spark, SF, "done_log").collect()]
    assert sorted(r[2] for r in log) == sorted(r.o_orderkey for r in table(spark, "orders").select("o_orderkey").collect())
    last = {}
    for key, *row in sorted(log, key=lambda r: (r[1], r[2])):
        last[key] = row
    found = catalogue.QUERIES["checkpoint_upsert"](spark, SF).collect()
    assert {r.tile_id: (r.processed_at, r.n_detections, r.skip_reason) for r in found} == {k: (at, n, why) for k, (at, _, n, why) in last.items()}
    assert len(found) == len(last) and sum(r.n for r in catalogue.QUERIES["status_counts"](spark, SF).collect()) == len(last)
    tiles = {r.coord.replace("-", "_") for r in catalogue.QUERIES["rgb_dsm_pairs"](spark, SF).collect()}
    left = {r.tile_id for r in catalogue.QUERIES["resume_remaining"](spark, SF).collect()}
    assert left == tiles - set(last) and 0 < len(left) < len(tiles)


def test_items_of_all_orders_take_in_the_tiles_of_all_detections(spark):
    items = view(spark, SF, "stac_items").collect()
    assert sorted(r.seq for r in items) == sorted(r.o_orderkey for r in table(spark, "orders").select("o_orderkey").collect())
    coords = {r.item_id[-9:] for r in items}
    tiles = {r.coord for r in catalogue.QUERIES["rgb_dsm_pairs"](spark, SF).collect()}
    assert tiles == {r.coord for r in catalogue.QUERIES["url_list_pairs"](spark, SF).collect()}
    assert {r.item_id[-9:] for r in items if r.layer == "dsm" and r.href} >= tiles and tiles < coords
    assert len(catalogue.QUERIES["patch_grid_25"](spark, SF).collect()) == 25 * len(tiles)
    outcomes = {r.tile_id: r.n_detections for r in catalogue.QUERIES["tile_outcomes"](spark, SF).collect()}
    assert sum(outcomes.values()) == table(spark, "lineitem").count() and 0 in outcomes.values()


def test_all_events_are_scored(spark):
    cents = {}
    for r in table(spark, "events").select("user_id", "value").collect():
        cents.setdefault(str(r.user_id), []).append(int(abs(r.value) * 100 + 0.5) * (1 if r.value >= 0 else -1))
    found = {r.img: r.mean_conf for r in catalogue.QUERIES["mean_confidence"](spark, SF).collect()}
    assert {i: found[i] for i in cents} == pytest.approx({i: sum(v) / len(v) for i, v in cents.items()}, abs=1)
    assert len(found) > len(cents) and all(found[i] == 0 for i in found if i not in cents)


def test_all_line_items_are_labelled(spark):
    labels = [r.label for r in catalogue.QUERIES["yolo_labels"](spark, SF).collect()]
    assert sum(len(x.splitlines()) for x in labels) == table(spark, "lineitem").count() and "" in labels


def test_all_boxes_are_matched_or_left_over(spark):
    n, background = table(spark, "lineitem").count(), 2
    found = catalogue.QUERIES["confusion_matrix"](spark, SF).collect()
    assert sum(r.n for r in found if r.pred_cls != background) == sum(r.n for r in found if r.true_cls != background) == n
    hits = sum(r.n for r in found if background not in (r.pred_cls, r.true_cls))
    assert 0 < hits < n
