"""Pairs of overlapping boxes of any size, by levels of cells.

A box is filed at the level of its own longer side: in the cells, as wide as the next
power of two, that it touches (four at most). It also looks into the cells that it
touches at coarser levels (four at most at each), where larger boxes are filed. So a
box over the whole map widens nobody's cells, and no cell holds all small boxes.

With an overlap (IoU) above t, the longer sides of two boxes differ by less than a
factor of 1/t: then only the next ceil(log2(1/t)) levels are looked into, and each box
is sent at most 4 + 4 * (1 + ceil(log2(1/t))) times. Without a threshold all coarser
levels that occur are; there are at most as many as powers of two in the sizes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions.geo import iou, overlaps

#: Sides below 2^LEAST or above 2^MOST count as these.
LEAST, MOST = -30, 60
EDGES = ("xmin", "ymin", "xmax", "ymax")


def level_of() -> Column:
    """The least power of two that is not below the longer side."""
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    guess = F.ceil(F.log2(F.when(side > 0, side).otherwise(F.lit(2.0**LEAST)))).cast("int")
    exact = guess + F.when(side > F.pow(F.lit(2.0), guess), 1).otherwise(0)
    return F.greatest(F.lit(LEAST), F.least(F.lit(MOST), exact))


def _in_cells(boxes: DataFrame) -> DataFrame:
    """The boxes with the cells of their column ``level`` that they touch."""
    width = F.pow(F.lit(2.0), F.col("level"))
    cells = [F.sequence(F.floor(F.col(f"{c}min") / width), F.floor(F.col(f"{c}max") / width)) for c in ("x", "y")]
    return boxes.select("*", F.explode(cells[0]).alias("ci")).select("*", F.explode(cells[1]).alias("cj"))


def filed(boxes: DataFrame) -> DataFrame:
    return _in_cells(boxes.withColumn("level", level_of()))


def looked_up(boxes: DataFrame, up: list[int] | int, coarser: bool) -> DataFrame:
    """The boxes in the cells of coarser levels, and of their own unless ``coarser``.
    up: how many levels further, or the levels that there are."""
    own = boxes.withColumn("own", level_of())
    first = F.col("own") + (1 if coarser else 0)
    if isinstance(up, int):
        last = F.least(F.col("own") + up, F.lit(MOST))
        levels = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    else:
        levels = F.filter(F.array(*map(F.lit, up)).cast("array<int>"), lambda x: x >= first)
    return _in_cells(own.withColumn("level", F.explode(levels)))


def _levels(threshold: float, *tables: DataFrame) -> list[int] | int:
    if threshold > 0:
        return math.ceil(math.log2(1 / threshold))
    found: set[int] = set()
    for t in tables:
        # at most MOST - LEAST + 1 rows
        found |= {r.level for r in t.select(level_of().alias("level")).distinct().collect()}
    return sorted(found)


def _met(a: DataFrame, b: DataFrame, key: str, threshold: float) -> DataFrame:
    """Filed boxes a with those that looked them up, b: pairs of one key that overlap
    (by more than ``threshold``), each in the one cell that holds the lower left corner
    of the intersection. A cell with very many look-ups is one that Spark may split:
    the join needs no order after it."""
    c = F.col
    a, b = a.alias("a"), b.alias("b")
    same = (c(f"a.{key}") == c(f"b.{key}")) & (c("a.level") == c("b.level")) & (c("a.ci") == c("b.ci")) & (c("a.cj") == c("b.cj"))
    width = F.pow(F.lit(2.0), c("a.level"))
    once = [F.floor(F.greatest(f"a.{x}min", f"b.{x}min") / width) == c(f"a.{cell}") for x, cell in (("x", "ci"), ("y", "cj"))]
    fits = iou("a", "b") > threshold if threshold > 0 else overlaps("a", "b")
    # never broadcast: Spark takes the look-ups for as small as the boxes that they come from
    return a.join(b.hint("merge"), same & once[0] & once[1] & fits)


def self_pairs(boxes: DataFrame, key: str, rank: str, threshold: float = 0.0) -> DataFrame:
    """(key, first, second), by rank, of boxes (key, rank, xmin, ymin, xmax, ymax) of one
    key that overlap, or have an IoU above ``threshold``. Each pair once; ranks of a key
    differ. Boxes with a null edge, key or rank are in no pair."""
    slim = boxes.select(key, rank, *EDGES).dropna()
    up = _levels(threshold, slim)
    pairs = _met(filed(slim), looked_up(slim, up, coarser=False), key, threshold).where((F.col("b.own") < F.col("b.level")) | (F.col(f"a.{rank}") < F.col(f"b.{rank}")))
    ranks = F.col(f"a.{rank}"), F.col(f"b.{rank}")
    return pairs.select(F.col(f"a.{key}").alias(key), F.least(*ranks).alias("first"), F.greatest(*ranks).alias("second"))


def cross_pairs(left: DataFrame, right: DataFrame, key: str, threshold: float = 0.0) -> DataFrame:
    """All columns of ``left`` and of ``right`` but key and edges, and iou, of boxes of one
    key that overlap, or have an IoU above ``threshold``. Apart from key and edges the
    tables share no column names. Each pair once."""
    keep = [[x for x in t.columns if x not in (key, *EDGES)] for t in (left, right)]
    sides = left.dropna(subset=[key, *EDGES]), right.dropna(subset=[key, *EDGES])
    up = _levels(threshold, *[s.select(*EDGES) for s in sides])
    found = None
    for big, small, coarser in ((0, 1, False), (1, 0, True)):
        met = _met(filed(sides[big]), looked_up(sides[small], up, coarser), key, threshold)
        part = met.select(F.col(f"a.{key}").alias(key), *keep[0], *keep[1], iou("a", "b").alias("iou"))
        found = part if found is None else found.union(part)
    return found
