"""Tiles as a stream: new work is detected, deduplicated and stored batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tilewright.functions.storage import forget, written
from tilewright.operators.dedup import dedup_per_tile
from tilewright.operators.detect import detections_of, outcomes_of
from tilewright.sources.store import append_detections, mark_done


def store_batch(results: DataFrame, root: str, batch_id: str | int, dedup: bool = True) -> None:
    """Stores the results of :func:`detect_tiles`: detections first, then the
    checkpoints. Both replace what a broken attempt at this batch has left."""
    held = written(results, "results")
    found = detections_of(held)
    if dedup:
        ranked = found.withColumn("c", -F.col("confidence"))
        found = dedup_per_tile(ranked, order=("c", "patch_id", "easting", "northing")).drop("c")
    append_detections(found, root, batch_id)
    mark_done(outcomes_of(held), root, batch_id)
    forget(held)


def run_stream(work: DataFrame, detect: Callable[[DataFrame], DataFrame], root: str, checkpoint: str) -> StreamingQuery:
    """Works through all tiles that have arrived in a streaming ``work`` table."""

    def batch(df: DataFrame, batch_id: int) -> None:
        store_batch(detect(df), root, batch_id)

    return work.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_key(events: DataFrame, key: str) -> DataFrame:
    """Running counts by key; on a stream, state holds one number for each key."""
    return events.groupBy(key).agg(F.count("*").alias("n"))


def to_memory(counts: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """The final counts of a stream that has come to its end."""
    query = counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return counts.sparkSession.table(name)
