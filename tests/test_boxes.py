"""Pairs of boxes of any size against all pairs, and how many rows they send."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tilewright.operators.boxes import cross_pairs, filed, level_of, looked_up, self_pairs
from tilewright.operators.datasets import confusion, overlap_pairs, validate
from tilewright.operators.dedup import matched, matched_by_rounds, nms_by_rounds, nms_of_any_size

SCHEMA = "tile_id string, rk int, xmin double, ymin double, xmax double, ymax double"


def boxes(seed, n=250):
    rng = random.Random(seed)
    rows = [("a", 0, -1e6, -1e6, 1e6, 1e6), ("b", 0, 0.0, 0.0, 1024.0, 1024.0), ("a", 1, 5.0, 5.0, 5.0, 5.0), ("a", 2, 0.0, 0.0, 8.0, 8.0), ("a", 3, 8.0, 0.0, 16.0, 8.0), ("a", 4, 0.0, 0.0, 8.0, 8.0), ("b", 5, None, 0.0, 1.0, 1.0)]
    for k in range(len(rows), n):
        side = 2.0 ** rng.uniform(-3, 11)
        x, y = rng.uniform(-400, 400), rng.uniform(-400, 400)
        long = rng.choice([1, 1, 1.2, 5])
        rows.append((rng.choice("ab"), k, x, y, x + side * long, y + side))
        if k % 3 == 0:
            rows.append((rows[-1][0], k + 10_000, x + side / 9, y, x + side * long * 1.1, y + side))
    return rows


def share(a, b):
    w, h = min(a[4], b[4]) - max(a[2], b[2]), min(a[5], b[5]) - max(a[3], b[3])
    both = max(w, 0) * max(h, 0)
    whole = (a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - both
    meet = a[4] > b[2] and b[4] > a[2] and a[5] > b[3] and b[5] > a[3]
    return meet, both / whole if whole else 0.0


def brute(rows, t):
    fine = [r for r in rows if None not in r]
    for i, a in enumerate(fine):
        for b in fine[i + 1 :]:
            if a[0] == b[0]:
                meet, of = share(a, b)
                if of > t if t else meet:
                    yield a[0], min(a[1], b[1]), max(a[1], b[1])


@pytest.mark.parametrize("t", [0.0, 0.1, 0.3, 0.5, 0.6, 0.95])
def test_pairs_of_one_table(spark, t):
    rows = boxes(int(t * 100))
    got = [tuple(r) for r in self_pairs(spark.createDataFrame(rows, SCHEMA), "tile_id", "rk", t).collect()]
    assert sorted(got) == sorted(brute(rows, t))


@pytest.mark.parametrize("t", [0.0, 0.4])
def test_pairs_of_two_tables(spark, t):
    left, right = boxes(7), boxes(8)
    a = spark.createDataFrame(left, SCHEMA)
    b = spark.createDataFrame(right, SCHEMA).withColumnRenamed("rk", "other")
    got = sorted((r.tile_id, r.rk, r.other) for r in cross_pairs(a, b, "tile_id", t).collect())
    fine = [[r for r in x if None not in r] for x in (left, right)]
    assert got == sorted((p[0], p[1], q[1]) for p in fine[0] for q in fine[1] if p[0] == q[0] and (share(p, q)[1] > t if t else share(p, q)[0]))


def test_rows_sent_are_bounded_whatever_the_sizes(spark):
    df = spark.createDataFrame(boxes(1, 2000), SCHEMA).dropna()
    n = df.count()
    assert filed(df).count() <= 4 * n
    for t in (0.3, 0.5):
        up = math.ceil(math.log2(1 / t))
        assert looked_up(df, up, coarser=False).count() <= 4 * (1 + up) * n
        # the box over the whole map meets no small one in any cell
        cells = ["tile_id", "level", "ci", "cj"]
        wide = filed(df).where("rk = 0 and tile_id = 'a'").join(looked_up(df, up, coarser=False).where("rk > 0"), cells).count()
        assert wide == 0


def test_levels_at_powers_of_two(spark):
    rows = [(8.0, 3), (8.0000001, 4), (0.0, -30), (1e30, 60), (0.25, -2), (2.0**-40, -30)]
    df = spark.createDataFrame([("a", k, 0.0, 0.0, s, s / 2) for k, (s, _) in enumerate(rows)], SCHEMA)
    assert [r.level for r in df.orderBy("rk").select(level_of().alias("level")).collect()] == [w for _, w in rows]


def test_suppression_of_any_size(spark):
    rows = boxes(3)
    kept = []
    for r in sorted((r for r in rows if None not in r), key=lambda r: (r[0], r[1])):
        if not any(k[0] == r[0] and share(k, r)[1] > 0.3 for k in kept):
            kept.append(r)
    got = nms_by_rounds(spark.createDataFrame(rows, SCHEMA), 0.3).where("xmin is not null").select("tile_id", "rk").collect()
    assert sorted(map(tuple, got)) == [r[:2] for r in kept]


def test_overlap_pairs_without_a_side(spark):
    rows = [r for r in boxes(4) if None not in r]
    df = spark.createDataFrame([(r[1], *r[2:]) for r in rows], "idx int, xmin double, ymin double, xmax double, ymax double")
    one = [("x", *r[1:]) for r in rows]
    assert sorted(map(tuple, overlap_pairs(df).collect())) == sorted((i, j) for _, i, j in brute(one, 0))
    assert overlap_pairs(df.limit(0)).collect() == []


def test_validation_suppresses_before_it_matches(spark):
    preds = [("i", 1, 0, 0.9, 0.0, 0.0, 10.0, 10.0), ("i", 2, 0, 0.8, 0.5, 0.0, 10.5, 10.0), ("i", 3, 1, 0.7, 50.0, 50.0, 60.0, 60.0), ("i", 4, 0, 0.1, 90.0, 90.0, 99.0, 99.0)]
    p = spark.createDataFrame(preds, "img string, p_id int, cls int, conf double, xmin double, ymin double, xmax double, ymax double")
    t = spark.createDataFrame([("i", 1, 0, 0.0, 0.0, 10.0, 10.0), ("i", 2, 1, 50.0, 50.0, 60.0, 60.0)], "img string, t_id int, cls int, xmin double, ymin double, xmax double, ymax double")
    assert validate(p, t, background=2, suppress=0.5).select("tp", "fp", "fn").first() == (2, 0, 0)
    assert validate(p, t, background=2).select("tp", "fp", "fn").first() == (2, 1, 0)
    assert p.where(F.col("conf") > 2).count() == 0


def test_look_ups_are_never_broadcast(spark):
    # a table whose size Spark knows: a thousand rows, so it would broadcast what is made of them
    x = F.col("id").cast("double")
    df = spark.range(1000).select(F.lit("a").alias("tile_id"), F.col("id").cast("int").alias("rk"), x.alias("xmin"), x.alias("ymin"), (x + 3).alias("xmax"), (x + 3).alias("ymax"))
    for pairs in (self_pairs(df, "tile_id", "rk"), cross_pairs(df, df.withColumnRenamed("rk", "other"), "tile_id", 0.4)):
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def sides(spark):
    p = spark.createDataFrame(boxes(11), SCHEMA).withColumnRenamed("tile_id", "img").withColumn("cls", F.col("rk") % 2)
    t = spark.createDataFrame(boxes(12) + boxes(11)[:60], SCHEMA).withColumnRenamed("tile_id", "img").withColumn("cls", F.col("rk") % 3)
    return p.withColumnRenamed("rk", "p_id"), t.withColumn("rk", F.concat(F.lit("t"), F.col("rk"), F.lit("-"), F.monotonically_increasing_id())).withColumnRenamed("rk", "t_id")


@pytest.mark.parametrize("few", [0, 180, 4000])
def test_matching_inside_a_task_or_in_rounds(spark, few):
    p, t = sides(spark)
    ids = ["img", "p_id", "t_id", "p_cls", "t_cls"]
    want = sorted(map(tuple, matched_by_rounds(p, t, 0.3).select(*ids).collect()))
    assert len(want) > 50 and sorted(map(tuple, matched(p, t, 0.3, few=few).select(*ids).collect())) == want
    assert matched(p.limit(0), t, 0.3, few=few).collect() == []


def test_matching_sends_no_pairs_and_joins_no_cells(spark):
    p, t = sides(spark)
    plan = matched(p, t, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Generate" not in plan and "Join" not in plan


def test_what_is_left_over_is_counted(spark):
    p, t = sides(spark)
    m = matched(p, t, 0.3)
    found = {(r.pred_cls, r.true_cls): r.n for r in confusion(m, p, t, background=9).collect()}
    hits = m.count()
    assert sum(n for (a, b), n in found.items() if b == 9) == p.count() - hits and sum(n for (a, b), n in found.items() if a == 9) == t.count() - hits
    # a class all of whose boxes are matched has no row
    one, other = p.where("p_id = 2"), p.where("p_id = 2").withColumnRenamed("p_id", "t_id")
    assert [tuple(r) for r in confusion(matched(one, other), one, other, background=9).collect()] == [(0, 0, 1)]


@pytest.mark.parametrize("few", [0, 180, 4000])
def test_suppression_inside_a_task_or_in_rounds(spark, few):
    df = spark.createDataFrame(boxes(13), SCHEMA)
    want = sorted(tuple(r) for r in nms_by_rounds(df, 0.3).select("tile_id", "rk").collect())
    assert sorted(tuple(r) for r in nms_of_any_size(df, 0.3, few=few).select("tile_id", "rk").collect()) == want


def test_points_are_sent_to_few_cells(spark):
    from tilewright.operators.dedup import near_pairs

    rng = random.Random(5)
    rows = [(rng.choice("ab"), k, 2_500_000 + 1.5 * rng.randrange(60), 1_200_000 + 1.5 * rng.randrange(60)) for k in range(500)]
    found = near_pairs(spark.createDataFrame(rows, "tile_id string, rk int, easting double, northing double"), 7.5)
    want = [(a[0], a[1], b[1]) for i, a in enumerate(rows) for b in rows[i + 1 :] if a[0] == b[0] and (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 < 56.25]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    # the cells that its circle touches, not all nine around
    assert "sequence(" in found._jdf.queryExecution().toString()


def test_kept_by_overlap_in_pieces(monkeypatch):
    import numpy as np

    from tilewright.operators import dedup

    rows = [r for r in boxes(17) if None not in r and r[0] == "a"]
    kept = []
    for r in rows:
        if not any(share(k, r)[1] > 0.3 for k in kept):
            kept.append(r)
    for at_once in (1, 1000, 10**6):
        monkeypatch.setattr(dedup, "AT_ONCE", at_once)
        keep = dedup.kept_by_overlap(np.array([r[2:] for r in rows], float), 0.3)
        assert [r for r, k in zip(rows, keep, strict=True) if k] == kept


def test_dealt_boxes_of_one_size_are_never_broadcast(spark):
    x = F.col("id").cast("double") * 100
    df = spark.range(1000).select("id", x.alias("xmin"), x.alias("ymin"), (x + 320).alias("xmax"), (x + 320).alias("ymax")).withColumnRenamed("id", "idx")
    plan = overlap_pairs(df, 320)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
