"""Registered queries over keyed tables, and over layers that executors write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.storage import fresh_path, written
from tilewright.plans.catalogue import DONE, query
from tilewright.plans.fixtures import duck, view
from tilewright.sources.keyed import KeyedTable
from tilewright.sources.layers import read_layer, write_layer
from tilewright.sources.store import detection_boxes

LOG = "tile_id string, n_detections int, skip_reason string, processed_at timestamp, seq long"


def checkpoints(spark: SparkSession, sf_dir: str) -> KeyedTable:
    """The log of all orders in four batches, one of them twice; the first two are
    compacted, and the third arrives while that goes on."""
    table = KeyedTable(spark, fresh_path(spark, "keyed"), "processed_tiles", LOG, "tile_id", ["processed_at", "seq"], buckets=16)
    log = written(view(spark, sf_dir, "done_log").withColumn("processed_at", F.col("processed_at").cast("timestamp")), "done-log")

    def put(k: int) -> None:
        table.append(log.where(F.pmod("seq", F.lit(4)) == k), k)

    for k in (0, 1, 0):
        put(k)
    table.compact(between=lambda: put(2))
    put(3)
    return table


@query(f"with {duck('done_log')}, {DONE} select tile_id, n_detections, skip_reason from done")
def keyed_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpoints(spark, sf_dir).read().select("tile_id", "n_detections", "skip_reason")


@query(f"with {duck('done_log')}, {DONE} select tile_id, n_detections, skip_reason from done where tile_id in ('2500_1100', '2502_1100', '2510_1101', '9999_9999')")
def keyed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few tiles of the checkpoints; the buckets of the others are not read."""
    found = checkpoints(spark, sf_dir).lookup(["2500_1100", "2502_1100", "2510_1101", "9999_9999"])
    return found.select("tile_id", "n_detections", "skip_reason")


def _little(x: str) -> str:
    """Hex digits of a positive double's bytes, the least first, from its exponent and
    its mantissa."""
    bits = f"(((1023 + floor(log2({x})))::bigint << 52) + (({x} / pow(2, floor(log2({x}))) - 1) * 4503599627370496)::bigint)"
    big = f"lpad(lower(to_hex({bits})), 16, '0')"
    return " || ".join(f"substr({big}, {k}, 2)" for k in range(15, 0, -2))


@query(f"""with {duck("detections")}, b as (select tile_id, round(confidence::double, 4) as confidence, easting - bbox_w_m::double / 2 as x0, northing - bbox_h_m::double / 2 as y0, easting + bbox_w_m::double / 2 as x1, northing + bbox_h_m::double / 2 as y1 from detections),
 h as (select tile_id, confidence, {_little("x0")} as x0, {_little("y0")} as y0, {_little("x1")} as x1, {_little("y1")} as y1 from b)
 select tile_id, confidence, '4750000308080000' || x0 || x1 || y0 || y1 || '01030000000100000005000000' || x1 || y0 || x1 || y1 || x0 || y1 || x0 || y0 || x1 || y0 as geometry from h""")
def layer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All detections as files of a layer that executors write, and read again: their
    geometries to the byte."""
    path = fresh_path(spark, "layer")
    boxes = detection_boxes(view(spark, sf_dir, "detections")).select("tile_id", F.round(F.col("confidence").cast("double"), 4).alias("confidence"), "xmin", "ymin", "xmax", "ymax")
    write_layer(boxes, path)
    return read_layer(spark, path, "tile_id string, confidence double").select("tile_id", "confidence", F.lower(F.hex("geom")).alias("geometry"))
