"""Which tiles to work on: catalogue items, pairs of layers, neighbours, resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions.geo import coord_from, coord_of, tile_id, x_km, y_km, year_of
from tilewright.functions.prefix import sums_before


def keyed_items(items: DataFrame) -> DataFrame:
    """Catalogue items (item_id, ...) with coord, year; items without a coord go."""
    return items.withColumn("coord", coord_of(F.col("item_id"))).withColumn("yr", year_of(F.col("item_id"))).where("coord is not null")


def first_tif(assets: Column) -> Column:
    """href of the first asset (in map order) that ends in .tif, case-sensitively."""
    return F.try_element_at(F.filter(F.map_values(assets), lambda a: F.endswith(a["href"], F.lit(".tif"))), F.lit(1))["href"]


def newest_per_coord(items: DataFrame, target_year: int = 0) -> DataFrame:
    """The newest item with an href of each layer and coord; of equal years the
    first seen (least seq). target_year: that year's only, 0 for any."""
    rows = keyed_items(items).where("href is not null")
    if target_year:
        rows = rows.where(F.col("yr") == target_year)
    # one partial aggregation: the least of (-year, seq) carries its href along
    best = rows.groupBy("layer", "coord").agg(F.min(F.struct((-F.col("yr")).alias("y"), "seq", "href")).alias("m"))
    return best.select("layer", "coord", F.col("m.href").alias("href"), (-F.col("m.y")).alias("yr"))


def rgb_dsm_pairs(newest: DataFrame) -> DataFrame:
    """coord, x_km, y_km, rgb_url, dsm_url of the coords that have both layers."""
    c = F.col("coord")
    both = newest.where("layer in ('rgb', 'dsm')").groupBy("coord").agg(F.max(F.when(F.col("layer") == "rgb", F.col("href"))).alias("rgb_url"), F.max(F.when(F.col("layer") == "dsm", F.col("href"))).alias("dsm_url"))
    return both.where("rgb_url is not null and dsm_url is not null").select("coord", x_km(c).alias("x_km"), y_km(c).alias("y_km"), "rgb_url", "dsm_url")


def url_list_pairs(rgb: DataFrame, dsm: DataFrame) -> DataFrame:
    """Two URL lists (line, url) joined on the coord; the last line of a coord wins."""

    def last(df: DataFrame, name: str) -> DataFrame:
        keyed = df.withColumn("coord", coord_of(F.col("url"))).where("coord is not null")
        return keyed.groupBy("coord").agg(F.max(F.struct("line", F.trim("url").alias("url"))).alias("m")).select("coord", F.col("m.url").alias(name))

    return last(rgb, "rgb_url").join(last(dsm, "dsm_url"), "coord")


#: Neighbours that lend a strip to a tile: name, steps east, steps north.
NEIGHBOURS = (("right", 1, 0), ("bottom", 0, -1), ("corner", 1, -1))


def attach_neighbours(requested: DataFrame, available: DataFrame) -> DataFrame:
    """``requested`` tiles with the URLs of their right, bottom and corner
    neighbours, null where there is none.

    Each available tile is sent to the tiles that it is a neighbour of, and one
    aggregation gathers what came: one shuffle in place of three joins.
    """
    tile = ["coord", "x_km", "y_km", "rgb_url", "dsm_url"]
    lends = F.explode(F.array(*[F.struct(F.lit(n).alias("side"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for n, dx, dy in NEIGHBOURS])).alias("s")
    sent = available.select(*tile, lends).select(coord_from(F.col("x_km") - F.col("s.dx"), F.col("y_km") - F.col("s.dy")).alias("to"), "s.side", F.struct("rgb_url", "dsm_url").alias("urls"))
    gathered = sent.groupBy("to").agg(*[F.first(F.when(F.col("side") == n, F.col("urls")), ignorenulls=True).alias(n) for n, _, _ in NEIGHBOURS])
    return requested.join(gathered, requested["coord"] == gathered["to"], "left").drop("to")


def remaining(requested: DataFrame, done: DataFrame) -> DataFrame:
    """Requested tiles that are in no checkpoint; skipped tiles count as done."""
    keyed = requested.withColumn("tile_id", tile_id(F.col("coord")))
    return keyed.join(done.select("tile_id").distinct(), "tile_id", "left_anti")


def requested_coords(available: DataFrame, coords: DataFrame) -> DataFrame:
    """Available tiles among ``coords`` (pos, coord) in the user's order, each once."""
    once = coords.groupBy("coord").agg(F.min("pos").alias("pos"))
    return available.join(once, "coord").orderBy("pos")


def elevation_outcome(grids: DataFrame, least: float) -> DataFrame:
    """Tiles whose highest elevation lies below ``least`` (0: off) are skipped.
    A NaN counts as higher than any number, so it keeps its tile."""
    top = F.array_max("z")
    low = (F.lit(least) > 0) & (top < least)
    return grids.withColumn("max_z", top).withColumn("skip_reason", F.when(low, "low_elevation"))


def latest_by_key(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """An append-only log as a table with one row for each key: the last by
    ``order``. One aggregation; no window sort."""
    rest = [c for c in log.columns if c not in (key, *order)]
    newest = log.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("m"))
    return newest.select(key, *[F.col(f"m.{c}").alias(c) for c in log.columns if c != key])


def tile_outcomes(tiles: DataFrame, detections: DataFrame) -> DataFrame:
    """Detections of each tile, 0 where there are none."""
    n = detections.groupBy("tile_id").agg(F.count("*").alias("n"))
    return tiles.join(n, "tile_id", "left").withColumn("n_detections", F.coalesce("n", F.lit(0))).drop("n")


def status_counts(outcomes: DataFrame) -> DataFrame:
    """Tiles by status: failed (an error), skipped (a reason) or ok."""
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("skip_reason").isNotNull(), "skipped").otherwise("ok")
    return outcomes.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def evict_oldest(files: DataFrame, budget: int, per_range: int = 100_000) -> DataFrame:
    """Least recently used first: the files (file_id, mtime, size) to delete until
    the rest is within ``budget`` bytes. Files of one mtime go in order of file_id; a
    null mtime is the oldest, and a null size counts as 0."""
    total = files.agg(F.sum("size")).first()[0] or 0
    placed = sums_before(files, ["mtime", "file_id"], "size", per_range)
    return placed.where(F.lit(total) - F.col("before") > budget).select("row.*")
