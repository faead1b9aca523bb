"""A run from end to end: one source of tiles, resume, detection, storage, export."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.lv95 import to_wgs84
from tilewright.operators.detect import Detector, TileShape, detect_tiles
from tilewright.operators.tiles import attach_neighbours, newest_per_coord, remaining, requested_coords, rgb_dsm_pairs, url_list_pairs
from tilewright.sources.stac import read_url_list
from tilewright.sources.store import all_detections, create_tables, export_layer, load_catalogue, processed_tiles, save_catalogue
from tilewright.streaming.tiles import store_batch

#: Fixed value: the union of the extents of both layers (west, south, east, north).
COUNTRY_BBOX = "5.95,45.72,10.50,47.83"


@dataclass
class RunSettings:
    """Exactly one of whole_country, bbox, coords and rgb_urls says which tiles.

    min_elevation: tiles that lie below are skipped, 0 for none; conf: least
    confidence of a detection; batch_patches: patches that a model gets at a time;
    dedup: whether near-duplicates of a tile go.
    """

    output: str
    whole_country: bool = False
    bbox: str | None = None
    coords: tuple[str, ...] = ()
    rgb_urls: str | None = None
    dsm_urls: str | None = None
    min_elevation: float = 1500.0
    conf: float = 0.10
    batch_patches: int = 400
    dedup: bool = True

    def __post_init__(self):
        given = [n for n in ("whole_country", "bbox", "coords", "rgb_urls") if getattr(self, n)]
        if len(given) != 1:
            raise ValueError(f"give exactly one of whole_country, bbox, coords and rgb_urls, not {given or 'none'}")
        if self.rgb_urls and not self.dsm_urls:
            raise ValueError("rgb_urls needs dsm_urls")


def box_around_coords(coords: DataFrame, pad_tiles: int = 1, between: tuple[float, float] | None = None) -> DataFrame:
    """One row: the box of tile coordinates (x_km, y_km) and pad_tiles more on each
    side in metres, and around its projected corners as "west,south,east,north" in
    degrees to four places. between: see :func:`to_wgs84`."""
    box = coords.agg(
        ((F.min("x_km") - pad_tiles) * 1000).alias("min_e"),
        ((F.min("y_km") - pad_tiles) * 1000).alias("min_n"),
        ((F.max("x_km") + 1 + pad_tiles) * 1000).alias("max_e"),
        ((F.max("y_km") + 1 + pad_tiles) * 1000).alias("max_n"),
    )
    corners = [to_wgs84(F.col(e), F.col(n), between=between) for e in ("min_e", "max_e") for n in ("min_n", "max_n")]
    lon, lat = [c[0] for c in corners], [c[1] for c in corners]
    text = F.format_string("%.4f,%.4f,%.4f,%.4f", F.least(*lon), F.least(*lat), F.greatest(*lon), F.greatest(*lat))
    return box.select("*", text.alias("bbox"))


def resolve_tiles(spark: SparkSession, settings: RunSettings, catalogue: Callable[[str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(tiles to work on, all tiles that may lend strips to them), each with coord,
    x_km, y_km, rgb_url, dsm_url. catalogue(bbox) gives items (seq, layer, item_id,
    href); its answers are cached under the output."""
    if settings.rgb_urls:
        pairs = url_list_pairs(read_url_list(spark, settings.rgb_urls), read_url_list(spark, settings.dsm_urls))
    else:
        bbox = settings.bbox or COUNTRY_BBOX
        if settings.coords:
            asked = spark.createDataFrame([(c,) for c in settings.coords], "coord string").select(_km("coord", 1).alias("x_km"), _km("coord", 6).alias("y_km"))
            bbox = box_around_coords(asked).first().bbox
        pairs = load_catalogue(spark, settings.output, bbox)
        if pairs is None:
            save_catalogue(rgb_dsm_pairs(newest_per_coord(catalogue(bbox))), settings.output, bbox)
            pairs = load_catalogue(spark, settings.output, bbox)
    found = pairs.select("coord", _km("coord", 1).alias("x_km"), _km("coord", 6).alias("y_km"), "rgb_url", "dsm_url")
    if not settings.coords:
        return found, found
    order = spark.createDataFrame(list(enumerate(settings.coords)), "pos int, coord string")
    return requested_coords(found, order).drop("pos"), found


def _km(coord: str, at: int):
    return F.substring(coord, at, 4).cast("int")


def run(spark: SparkSession, settings: RunSettings, catalogue: Callable[[str], DataFrame], load: Callable[[str], np.ndarray], make_detector: Callable[[], Detector], batch_id: str, shape: TileShape | None = None, export: str | None = None) -> DataFrame:
    """Works through the tiles that are not in the checkpoints yet, stores what is
    found, exports all detections if asked to, and returns the outcome of each tile
    in the store. A run that broke off goes on under a new batch_id."""
    create_tables(spark, settings.output)
    asked, available = resolve_tiles(spark, settings, catalogue)
    todo = remaining(asked, processed_tiles(spark, settings.output)).drop("tile_id")
    results = detect_tiles(attach_neighbours(todo, available), load, make_detector, shape, settings.min_elevation, settings.batch_patches, settings.conf)
    store_batch(results, settings.output, batch_id, settings.dedup)
    if export:
        export_layer(all_detections(spark, settings.output), export)
    return processed_tiles(spark, settings.output)
