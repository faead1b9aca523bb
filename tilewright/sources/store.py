"""Results at rest: detections, checkpoints, cached catalogue answers, exports.

Parquet has no keys. A table that needs one is an append-only log, read through
:func:`tilewright.operators.tiles.latest_by_key`, or partitioned by its key and
overwritten a partition at a time, so that writing again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.geo import box_around, box_wkb
from tilewright.model import DETECTIONS, PROCESSED_TILES, STAC_CACHE, STAC_CACHE_META
from tilewright.operators.tiles import latest_by_key

#: Tiles of one bucket are written together.
BUCKETS = 64


def create_tables(spark: SparkSession, root: str) -> None:
    """Empty tables where there are none."""
    for name, schema in (("detections", DETECTIONS), ("processed_tiles", PROCESSED_TILES), ("stac_cache", STAC_CACHE), ("stac_cache_meta", STAC_CACHE_META)):
        spark.createDataFrame([], schema).write.mode("append").parquet(f"{root}/{name}")


def read_table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/{name}")


def append_detections(detections: DataFrame, root: str, batch_id: str | int) -> int:
    """Writes a batch of detections into a folder of its own and says how many there
    are. A batch that is written again replaces itself, so a retry adds nothing
    twice."""
    stamped = detections if "inserted_at" in detections.columns else detections.withColumn("inserted_at", F.current_timestamp())
    seen = Observation()
    stamped.observe(seen, F.count("*").alias("n")).write.mode("overwrite").parquet(f"{root}/detections/batch-{batch_id}")
    return seen.get["n"]


def mark_done(outcomes: DataFrame, root: str, batch_id: str | int) -> None:
    """Checkpoints tiles (tile_id, n_detections, skip_reason, error); failed ones
    are left out, so they are tried again."""
    done = outcomes.where("error is null").select("tile_id", "n_detections", "skip_reason", F.current_timestamp().alias("processed_at"))
    done.write.mode("overwrite").parquet(f"{root}/processed_tiles/batch-{batch_id}")


def processed_tiles(spark: SparkSession, root: str) -> DataFrame:
    """The last outcome of each tile."""
    return latest_by_key(read_table(spark, root, "processed_tiles", PROCESSED_TILES), "tile_id", ["processed_at"])


def all_detections(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "detections", DETECTIONS)


def total_detections(spark: SparkSession, root: str) -> DataFrame:
    """One row: how many detections are stored."""
    return all_detections(spark, root).agg(F.count("*").alias("n"))


def save_catalogue(pairs: DataFrame, root: str, bbox: str) -> None:
    """Replaces what is cached for exactly this box; an empty answer is kept too."""
    spark = pairs.sparkSession
    key = spark.range(1).select(F.sha2(F.lit(bbox), 256)).first()[0]
    rows = pairs.select(F.lit(bbox).alias("bbox"), "coord", "rgb_url", "dsm_url")
    rows.write.mode("overwrite").parquet(f"{root}/stac_cache/{key}")
    n = spark.read.parquet(f"{root}/stac_cache/{key}").count()
    spark.range(1).select(F.lit(bbox).alias("bbox"), F.lit(n).cast("int").alias("n_tiles"), F.current_timestamp().alias("cached_at")).write.mode("overwrite").parquet(f"{root}/stac_cache_meta/{key}")


def load_catalogue(spark: SparkSession, root: str, bbox: str) -> DataFrame | None:
    """What is cached for this box in order of coord, or None: nothing, or not as
    many rows as were saved."""
    meta = read_table(spark, root, "stac_cache_meta", STAC_CACHE_META).where(F.col("bbox") == bbox).select("n_tiles").first()
    rows = read_table(spark, root, "stac_cache", STAC_CACHE).where(F.col("bbox") == bbox).select("coord", "rgb_url", "dsm_url")
    if meta is None or rows.count() != meta.n_tiles:
        return None
    return rows.orderBy("coord")


def detection_boxes(detections: DataFrame) -> DataFrame:
    """Detections with the corners of their boxes."""
    return detections.select("*", *box_around(F.col("easting"), F.col("northing"), F.col("bbox_w_m"), F.col("bbox_h_m")))


def export_layer(detections: DataFrame, path: str) -> str | None:
    """All detections with rounded attributes and a box polygon (WKB, EPSG:2056)
    as Parquet; None without any. Rounding is that of decimal halves away from 0."""
    if detections.isEmpty():
        return None
    boxes = detection_boxes(detections.drop("inserted_at"))
    shown = boxes.withColumns({"confidence": F.round(F.col("confidence").cast("double"), 4), "bbox_w_m": F.round(F.col("bbox_w_m").cast("double"), 2), "bbox_h_m": F.round(F.col("bbox_h_m").cast("double"), 2)})
    shown.withColumn("geometry", box_wkb(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")])).withColumn("srid", F.lit(2056)).write.mode("overwrite").parquet(path)
    return path


def write_label_tree(labels: DataFrame, path: str) -> None:
    """(file_name, label, split) as one folder for each split."""
    labels.write.mode("overwrite").partitionBy("split").parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One CSV with a header, numbers to four places."""
    rounded = metrics.select(*[F.round(c, 4).alias(c) if t in ("double", "float") else F.col(c) for c, t in metrics.dtypes])
    rounded.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
