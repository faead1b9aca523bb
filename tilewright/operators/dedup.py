"""Greedy removal of near-duplicate detections, by distance or by overlap."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.storage import forget, written
from tilewright.model import DEDUP_RADIUS_M
from tilewright.operators.boxes import EDGES, cross_pairs, self_pairs

#: Boxes of one image or tile (on one side) that one task takes as a group at most; those with more are settled in rounds.
FEW = 4_000
#: Pairs of boxes that a task compares at a time.
AT_ONCE = 1_000_000


def kept_by_distance(x: np.ndarray, y: np.ndarray, radius: float = DEDUP_RADIUS_M) -> np.ndarray:
    """Which points are kept, if each (in order) is dropped when a kept one lies
    nearer than ``radius``. Kept points are filed under cells as wide as the
    radius, so a point looks at nine cells, not at all before it."""
    cells: dict[tuple[int, int], list[int]] = {}
    keep = np.zeros(len(x), bool)
    cx, cy = np.floor(x / radius).astype(np.int64).tolist(), np.floor(y / radius).astype(np.int64).tolist()
    xs, ys, square = x.tolist(), y.tolist(), radius * radius
    around = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    for k, (a, b) in enumerate(zip(cx, cy, strict=True)):
        near = (p for i, j in around for p in cells.get((a + i, b + j), ()))
        if not any((xs[k] - xs[p]) ** 2 + (ys[k] - ys[p]) ** 2 < square for p in near):
            keep[k] = True
            cells.setdefault((a, b), []).append(k)
    return keep


def dedup_per_tile(detections: DataFrame, radius: float = DEDUP_RADIUS_M, order: tuple[str, ...] = ("rk",)) -> DataFrame:
    """Greedy spatial dedup of each tile: in order, a detection goes if a kept one
    is strictly nearer than ``radius``; classes do not matter, nor other tiles.

    One shuffle by tile_id; a tile (one square kilometre) is one task's work. For
    tiles beyond that, see :func:`dedup_by_rounds`.
    """

    def one_tile(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable")
        return pdf[kept_by_distance(pdf["easting"].to_numpy(), pdf["northing"].to_numpy(), radius)]

    return detections.groupBy("tile_id").applyInPandas(one_tile, detections.schema)


def near_pairs(points: DataFrame, radius: float) -> DataFrame:
    """(tile_id, first, second) of points nearer than ``radius``, by rank. Every point
    goes to its own cell, four radii wide, and as the second of a pair to those that
    its circle touches: two or three rows on average, at most four."""
    side, reach = 4 * radius, radius * (1 + 1e-6)
    at = points.select("tile_id", "rk", "easting", "northing", *[F.floor(F.col(c) / side).cast("long").alias(k) for c, k in (("easting", "i"), ("northing", "j"))])
    cells = [F.explode(F.sequence(F.floor((F.col(c) - reach) / side), F.floor((F.col(c) + reach) / side))).alias(k) for c, k in (("x", "i"), ("y", "j"))]
    sent = points.select("tile_id", F.col("rk").alias("second"), F.col("easting").alias("x"), F.col("northing").alias("y")).dropna()
    sent = sent.select("*", cells[0]).select("*", cells[1])
    d2 = (F.col("easting") - F.col("x")) ** 2 + (F.col("northing") - F.col("y")) ** 2
    return at.join(sent.hint("merge"), ["tile_id", "i", "j"]).where((F.col("rk") < F.col("second")) & (d2 < radius * radius)).select("tile_id", F.col("rk").alias("first"), "second")


def greedy_by_rounds(points: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same greedy rule over any pairs (tile_id, first, second), without a
    task that holds a tile: in each round, points without an open point before
    them are kept, and those behind a kept one go. Points: (tile_id, rk, ...).
    Each round settles the head of every chain, so there are as many rounds as the
    longest chain of alternating decisions has links."""
    open_pairs, gone = pairs, None
    while True:
        # kept now: firsts that are nobody's second
        heads = open_pairs.select("tile_id", F.col("first").alias("rk")).distinct().join(open_pairs.select("tile_id", F.col("second").alias("rk")).distinct(), ["tile_id", "rk"], "left_anti")
        drop = open_pairs.join(heads.withColumnRenamed("rk", "first"), ["tile_id", "first"], "left_semi").select("tile_id", F.col("second").alias("rk")).distinct()
        drop = written(drop, "dedup-gone")
        if drop.isEmpty():
            break
        gone = drop if gone is None else gone.union(drop)
        left = open_pairs.join(drop.withColumnRenamed("rk", "second"), ["tile_id", "second"], "left_anti").join(drop.withColumnRenamed("rk", "first"), ["tile_id", "first"], "left_anti")
        before, open_pairs = open_pairs, written(left.select("tile_id", "first", "second"), "dedup-open")
        forget(before)
    return points if gone is None else points.join(gone, ["tile_id", "rk"], "left_anti")


def dedup_by_rounds(detections: DataFrame, radius: float = DEDUP_RADIUS_M) -> DataFrame:
    """:func:`dedup_per_tile` for tiles of any size: pairs come from a grid join,
    and the greedy order is settled in rounds of joins."""
    return greedy_by_rounds(detections, written(near_pairs(detections, radius), "dedup-pairs"))


def kept_by_overlap(b: np.ndarray, threshold: float) -> np.ndarray:
    """Which boxes (rows of edges) are kept, if each (in order) is dropped when a kept one
    has an IoU above ``threshold`` with it."""
    area = (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
    keep = np.ones(len(b), bool)
    # overlaps of some rows with all after them at a time; the order matters for those few pairs only
    for low in range(0, len(b), step := max(1, AT_ONCE // max(1, len(b)))):
        at, after = slice(low, low + step), slice(low + 1, None)
        w = np.minimum(b[at, 2, None], b[after, 2]) - np.maximum(b[at, 0, None], b[after, 0])
        h = np.minimum(b[at, 3, None], b[after, 3]) - np.maximum(b[at, 1, None], b[after, 1])
        shared = np.maximum(w, 0) * np.maximum(h, 0)
        i, j = np.nonzero(shared > threshold * (area[at, None] + area[after] - shared))
        i, j = i[j >= i] + low, j[j >= i] + low + 1
        for first, second in zip(i.tolist(), j.tolist(), strict=True):
            if keep[first]:
                keep[second] = False
    return keep


def nms(boxes: DataFrame, threshold: float) -> DataFrame:
    """Greedy suppression by overlap in each tile, in order of rk: a box goes if a
    kept one has an IoU above ``threshold`` with it."""

    def one_tile(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rk", kind="stable")
        return pdf[kept_by_overlap(pdf[list(EDGES)].to_numpy(float), threshold)]

    return boxes.groupBy("tile_id").applyInPandas(one_tile, boxes.schema)


def nms_of_any_size(boxes: DataFrame, threshold: float, few: int = FEW) -> DataFrame:
    """:func:`nms` with ranks of any kind: tiles of at most ``few`` boxes inside one task
    each, and those with more by :func:`nms_by_rounds`. Boxes without a tile, a rank or an
    edge stay, as they overlap with none."""
    fine = " and ".join(f"{c} is not null" for c in ("tile_id", "rk", *EDGES))
    many = crowded({"tile_id": boxes.where(fine)}, few)
    whole = boxes.where(fine)
    small = whole if many is None else whole.join(many, whole["tile_id"] == many["key"], "left_anti")
    by = small.select(*boxes.columns, F.row_number().over(Window.partitionBy("tile_id").orderBy("rk")).alias("__by"), *[F.col(e).cast("double").alias(f"__{e}") for e in EDGES])
    names = boxes.columns

    def one_tile(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("__by")
        keep = kept_by_overlap(np.stack([rows.column(f"__{e}").to_numpy() for e in EDGES], axis=1), threshold)
        return rows.select(names).filter(pa.array(keep))

    found = by.groupBy("tile_id").applyInArrow(one_tile, boxes.schema).union(boxes.where(f"not ({fine})"))
    return found if many is None else found.union(nms_by_rounds(whole.join(many, whole["tile_id"] == many["key"], "left_semi"), threshold))


def nms_by_rounds(boxes: DataFrame, threshold: float) -> DataFrame:
    """:func:`nms` for tiles and boxes of any size: pairs come from a join on cells of
    the boxes' own levels, and the greedy order is settled in rounds of joins."""
    held = written(boxes, "nms-boxes")
    return greedy_by_rounds(held, written(self_pairs(held, "tile_id", "rk", threshold), "nms-pairs"))


def crowded(tables: dict[str, DataFrame], few: int) -> DataFrame | None:
    """(key) of the groups with more than ``few`` rows in one of the tables by key
    column, or None if there are none."""
    found = None
    for key, table in tables.items():
        part = table.groupBy(F.col(key).alias("key")).count().where(F.col("count") > few).select("key")
        found = part if found is None else found.union(part)
    found = written(found.where("key is not null").distinct(), "crowded")
    return None if found.isEmpty() else found


def _greedy_matches(p: pa.Table, t: pa.Table, threshold: float) -> pa.Table:
    """The greedy matching of one image. p and t: ids, classes, edges and by, the order of the ids."""
    edges = [[x.column(c).to_numpy() for c in EDGES] for x in (p, t)]
    by = [x.column("by").to_numpy() for x in (p, t)]
    (pw, ps, pe, pn), (tw, ts, te, tn) = edges
    areas = (pe - pw) * (pn - ps), (te - tw) * (tn - ts)
    found = []
    for low in range(0, len(pw), step := max(1, AT_ONCE // max(1, len(tw)))):
        at = slice(low, low + step)
        w = np.maximum(0.0, np.minimum(pe[at, None], te) - np.maximum(pw[at, None], tw))
        h = np.maximum(0.0, np.minimum(pn[at, None], tn) - np.maximum(ps[at, None], ts))
        rest = areas[0][at, None] + areas[1] - w * h
        i, j = np.nonzero((w * h > 0) & (rest != 0))
        iou = (w * h)[i, j] / rest[i, j]
        over = iou > threshold
        found.append((iou[over], i[over] + low, j[over]))
    iou, i, j = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0), np.empty(0, int), np.empty(0, int))
    free_p, free_t, hits = [True] * len(pw), [True] * len(tw), []
    order = np.lexsort((by[1][j], by[0][i], -iou))
    for k, a, b in zip(order.tolist(), i[order].tolist(), j[order].tolist(), strict=True):
        if free_p[a] and free_t[b]:
            free_p[a] = free_t[b] = False
            hits.append(k)
    p, t = p.take(pa.array(i[hits], pa.int64())), t.take(pa.array(j[hits], pa.int64()))
    return pa.table([p.column("img"), p.column("p_id"), t.column("t_id"), p.column("p_cls"), t.column("t_cls"), pa.array(iou[hits], pa.float64())], names=["img", "p_id", "t_id", "p_cls", "t_cls", "iou"])


def matched(predictions: DataFrame, truths: DataFrame, threshold: float = 0.5, few: int = FEW) -> DataFrame:
    """Predictions (img, p_id, cls, xmin..ymax) matched with truths (img, t_id,
    cls, xmin..ymax): pairs of one image with an IoU above ``threshold``, each side
    used once, in the order of IoU (larger first), then ids.

    An image with at most ``few`` boxes on either side is matched inside one task, so
    that its boxes are shuffled once and its pairs never. Images with more are matched
    in rounds, see :func:`matched_by_rounds`; none of them is one task's work."""
    p = predictions.select("img", "p_id", F.col("cls").alias("p_cls"), *EDGES).dropna(subset=["img", *EDGES])
    t = truths.select("img", "t_id", F.col("cls").alias("t_cls"), *EDGES).dropna(subset=["img", *EDGES])
    many = crowded({"img": p.select("img").unionAll(t.select("img"))}, few)
    small = [x if many is None else x.join(many, x["img"] == many["key"], "left_anti") for x in (p, t)]
    # ids of any kind become numbers in their order; the shuffle for that is the one that the groups need
    by = [x.select("*", F.row_number().over(Window.partitionBy("img").orderBy(i)).alias("by")).select(*x.columns, "by", *[F.col(e).cast("double").alias(f"__{e}") for e in EDGES]).drop(*EDGES).withColumnsRenamed({f"__{e}": e for e in EDGES}) for x, i in zip(small, ("p_id", "t_id"), strict=True)]
    kinds = {f.name: f.dataType.simpleString() for x in (p, t) for f in x.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("img", "p_id", "t_id", "p_cls", "t_cls")) + ", iou double"
    found = by[0].groupBy("img").cogroup(by[1].groupBy("img")).applyInArrow(lambda a, b: _greedy_matches(a, b, threshold), schema)
    if many is None:
        return found
    rest = [x.join(many, x["img"] == many["key"], "left_semi") for x in (predictions, truths)]
    return found.unionByName(matched_by_rounds(*rest, threshold))


def matched_by_rounds(predictions: DataFrame, truths: DataFrame, threshold: float = 0.5) -> DataFrame:
    """:func:`matched` for images of any size. A pair counts if it is the best of both
    its sides (larger IoU, then lesser ids); such pairs leave and the rest is looked at
    again. Boxes meet in cells of their image and level, so an image with many boxes is
    not one task's work, nor does a large box make it so."""
    p = predictions.select("img", "p_id", F.col("cls").alias("p_cls"), *EDGES)
    t = truths.select("img", "t_id", F.col("cls").alias("t_cls"), *EDGES)
    pairs = cross_pairs(p, t, "img", threshold).select("img", "p_id", "t_id", "p_cls", "t_cls", "iou")
    pairs = written(pairs, "match-pairs")
    found = None
    order = [F.col("iou").desc(), F.col("p_id"), F.col("t_id")]
    while not pairs.isEmpty():
        by_p, by_t = Window.partitionBy("img", "p_id").orderBy(*order), Window.partitionBy("img", "t_id").orderBy(*order)
        best = pairs.withColumn("a", F.row_number().over(by_p)).withColumn("b", F.row_number().over(by_t)).where("a = 1 and b = 1").drop("a", "b")
        best = written(best, "match-found")
        found = best if found is None else found.union(best)
        old = pairs
        pairs = written(pairs.join(best.select("img", "p_id"), ["img", "p_id"], "left_anti").join(best.select("img", "t_id"), ["img", "t_id"], "left_anti").select(*old.columns), "match-pairs")
        forget(old)
    return pairs if found is None else found
