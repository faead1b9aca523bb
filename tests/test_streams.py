"""Streams with state and the paged source, with stops in between."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest

from tilewright.streaming.state import EVENTS, fold_events, item_events, newest_items, open_tiles, outcome_events, tile_states


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def feed(spark, rows, at):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{at}/events")
    fold_events(spark.readStream.schema(EVENTS).parquet(f"{at}/events"), f"{at}/states", f"{at}/checkpoint").awaitTermination()
    return {r.coord: r for r in tile_states(spark, f"{at}/states").collect()}


def item(coord, kind, year, seq, href="h"):
    return (coord, kind, year, seq, href, None, None, None)


def done(coord, day, seq, n, why=None):
    return (coord, "done", None, seq, None, dt.datetime(2020, 1, day), n, why)


def test_state_lives_on_after_a_stop(spark, tmp_path, few_partitions):
    at = f"file://{tmp_path}"
    first = feed(spark, [item("1-1", "rgb", 2010, 5, "a"), item("1-1", "dsm", 2010, 6, "b"), item("2-2", "rgb", 2000, 1, "c"), done("1-1", 5, 9, 4)], at)
    assert first["1-1"].rgb_href == "a" and first["1-1"].n_detections == 4 and first["1-1"].version == 1
    # an older item, an earlier outcome and a repeated event change nothing; an equal year counts with a lesser seq
    second = feed(spark, [item("1-1", "rgb", 2009, 1, "old"), done("1-1", 4, 99, 7), item("1-1", "dsm", 2010, 6, "b"), item("2-2", "rgb", 2000, 0, "d")], at)
    assert second["1-1"] == first["1-1"]
    assert second["2-2"].rgb_href == "d" and second["2-2"].version == 2
    third = feed(spark, [item("2-2", "dsm", 1999, 3, "e"), done("2-2", 1, 1, 0, "low_elevation"), item("3-3", "rgb", 1, 1, "f")], at)
    states = tile_states(spark, f"{at}/states")
    assert third["1-1"].version == 1
    assert sorted((r.coord, r.status, r.n_detections) for r in open_tiles(states).collect()) == [("1-1", "ok", 4), ("2-2", "skipped", 0)]
    assert sorted((r.layer, r.coord, r.href) for r in newest_items(states).collect()) == [("dsm", "1-1", "b"), ("dsm", "2-2", "e"), ("rgb", "1-1", "a"), ("rgb", "2-2", "d"), ("rgb", "3-3", "f")]


def test_any_order_and_dealing_gives_one_state(spark, tmp_path, few_partitions):
    rng = random.Random(3)
    rows = [item(f"{rng.randrange(4)}-0", rng.choice(["rgb", "dsm"]), rng.randrange(2000, 2004), rng.randrange(5), f"h{rng.randrange(3)}") for _ in range(300)]
    rows += [done(f"{rng.randrange(4)}-0", rng.randrange(1, 9), rng.randrange(3), rng.randrange(3), rng.choice([None, "x"])) for _ in range(200)]
    rows += rows[:50]
    expected = {}
    for coord in {r[0] for r in rows}:
        for kind in ("rgb", "dsm"):
            expected[coord, kind] = min((-r[2], r[3], r[4]) for r in rows if r[0] == coord and r[1] == kind)
        expected[coord, "done"] = max((r[5], r[3], r[6], r[7] or "") for r in rows if r[0] == coord and r[1] == "done")
    rng.shuffle(rows)
    at = f"file://{tmp_path}"
    feed(spark, rows[:200], at)
    states = feed(spark, rows[200:], at)
    for coord, r in states.items():
        assert (-r.rgb_year, r.rgb_seq, r.rgb_href) == expected[coord, "rgb"] and (-r.dsm_year, r.dsm_seq, r.dsm_href) == expected[coord, "dsm"]
        assert (r.done_at, r.done_seq, r.n_detections, r.skip_reason or "") == expected[coord, "done"]


def test_state_is_folded_without_python(spark, capfd):
    from tilewright.streaming.state import CHANGES, folded_by_coord

    events = spark.createDataFrame([item("1-1", "rgb", None, 1), item("1-1", "rgb", 1, 2, "b"), item("1-1", "map", 9, 9), done("1-1", 1, 1, None, "")], EVENTS).localCheckpoint()
    states = folded_by_coord(events)
    states.explain()
    assert not {"Python", "Pandas", "Arrow"} & set(capfd.readouterr().out.replace("In", " ").split())
    assert [tuple(r)[:4] for r in states.collect()] == [("1-1", 1, 2, "b")]
    assert [(r.n_detections, r.skip_reason) for r in states.collect()] == [(0, None)]
    assert CHANGES.split(", ")[:-1] == ["coord string", *(f"{f.name} {'long' if f.dataType.simpleString() == 'bigint' else f.dataType.simpleString()}" for f in states.schema.fields[1:])]


def test_events_are_written_by_all_tasks_and_folded_in_four_batches(spark, tmp_path, monkeypatch, few_partitions):
    from tilewright.plans import stream_catalogue

    monkeypatch.setattr(stream_catalogue, "fresh_path", lambda spark, name: f"file://{tmp_path}/{name}")
    rows = [item(f"{k % 50}-0", "rgb", 2000 + k % 3, k, f"h{k}") for k in range(600)]
    states = stream_catalogue.folded(spark, spark.createDataFrame(rows, EVENTS).repartition(5))
    assert len(list(tmp_path.glob("events/*.parquet"))) == 20
    assert len(list(tmp_path.glob("states/batch-*"))) == 4
    assert sorted((r.coord, r.rgb_seq) for r in states.collect()) == sorted((f"{k}-0", min(j for j in range(k, 600, 50) if j % 3 == 2)) for k in range(50))


def test_events_leave_out_what_has_no_key(spark):
    items = spark.createDataFrame([(1, "rgb", "x_2020_2500-1100", "u"), (2, "rgb", "x", "u"), (3, "rgb", "x_2020_2500-1100", None), (4, "map", "x_2020_2500-1100", "u"), (None, "dsm", "2500-1100", "u")], "seq long, layer string, item_id string, href string")
    assert sorted((r.coord, r.kind, r.year, r.seq) for r in item_events(items).collect()) == [("2500-1100", "dsm", 0, 2**63 - 1), ("2500-1100", "rgb", 2020, 1)]
    log = spark.createDataFrame([("1_1", 1, None, dt.datetime(2020, 1, 1), None), (None, 1, None, dt.datetime(2020, 1, 1), 2), ("1_1", 1, None, None, 3)], "tile_id string, n_detections int, skip_reason string, processed_at timestamp, seq long")
    assert [(r.coord, r.seq) for r in outcome_events(log).collect()] == [("1-1", -(2**63))]


def write_pages(at, layer, numbers, per_page=3):
    folder = at / "pages" / layer
    folder.mkdir(parents=True, exist_ok=True)
    for n in numbers:
        boxes = [[n * 10 + k, 0, n * 10 + k + 1, 1] for k in range(per_page)]
        features = [{"id": f"{layer}-{n}-{k}", "bbox": b, "assets": {"x": {"href": "a.txt"}, "y": {"href": f"{n}.tif"}}} for k, b in enumerate(boxes)]
        (folder / f"{n}.json").write_text(json.dumps({"features": features, "bbox": [n * 10, 0, n * 10 + per_page, 1]}))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 40])
def test_pages_are_counted_by_halving(tmp_path, n):
    from tilewright.sources.pages import count_pages

    write_pages(tmp_path, "rgb", range(n))
    root = f"file://{tmp_path}/pages"
    assert count_pages(root, "rgb") == n and count_pages(root, "rgb", n) == n and count_pages(root, "rgb", n // 2) == n


def test_filters_reach_the_pages(spark, tmp_path, capfd):
    from tilewright.sources.pages import pages, with_pushdown

    write_pages(tmp_path, "rgb", range(20))
    # never read, or the scan would fail
    (tmp_path / "pages" / "dsm").mkdir()
    (tmp_path / "pages" / "dsm" / "0.json").write_text("no JSON")
    root = f"file://{tmp_path}/pages"
    near = pages(spark, root).where("layer in ('rgb', 'map') and west >= 30 and east <= 52 and href like '%.tif'")
    rows = with_pushdown(near, "near").orderBy("page", "pos").collect()
    assert [(r.page, r.pos) for r in rows] == [(p, k) for p in range(20) for k in range(3) if p * 10 + k >= 30 and p * 10 + k + 1 <= 52]
    assert rows[0].href == "3.tif"
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        pages(spark, root).where("layer = 'rgb' and west >= 30").explain("formatted")
    finally:
        spark.conf.set(key, before)
    told = capfd.readouterr().out
    assert "PushedFilters" in told and "west" in told.split("PushedFilters")[1] and "* Filter" not in told


def test_pages_outside_are_skipped():
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThanOrEqual, Not

    from tilewright.sources.pages import Pushed

    p = Pushed(["rgb", "dsm"])
    assert p.take(GreaterThan(("west",), 5)) and p.take(LessThanOrEqual(("north",), 3)) and p.take(EqualTo(("layer",), "dsm")) and p.layers == ["dsm"]
    assert not p.take(EqualTo(("item_id",), "x")) and not p.take(Not(EqualTo(("layer",), "x")))
    assert p.skips_page([0, 0, 5, 1]) and not p.skips_page([0, 0, 6, 1]) and p.skips_page([0, 4, 9, 9]) and not p.skips_page(None)
    assert p.keeps([6, 0, 7, 3]) and not p.keeps([5, 0, 7, 3]) and not p.keeps(None)


def test_stream_of_pages_goes_on_from_its_offset(spark, tmp_path):
    from tilewright.sources.pages import pages_stream

    root = f"file://{tmp_path}/pages"

    def take(name, **since):
        pages_stream(spark, root, "rgb", since).writeStream.format("parquet").option("path", f"{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/{name}-check").trigger(availableNow=True).start().awaitTermination()
        return sorted(r.page for r in spark.read.parquet(f"{tmp_path}/{name}").where("pos = 0").collect())

    write_pages(tmp_path, "rgb", range(3))
    assert take("all") == [0, 1, 2]
    assert take("all") == [0, 1, 2]
    write_pages(tmp_path, "rgb", range(3, 40))
    assert take("all") == list(range(40))
    assert take("late", rgb=37) == [37, 38, 39]


def test_pages_of_a_layer_are_read_by_few_tasks():
    from tilewright.sources.pages import MOST_TASKS, _ranges

    for n in (0, 1, 16, 17, 1600, 45_001):
        found = [p.value for p in _ranges("rgb", 5, 5 + n)]
        assert len(found) <= MOST_TASKS and [k for _, a, b in found for k in range(a, b)] == list(range(5, 5 + n))
