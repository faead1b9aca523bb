"""Tiles as a stream with state: for each coordinate, the newest item of either
layer and the last outcome, kept across micro-batches and restarts.

Events may come in any order and more than once: what is kept is a maximum, so
the state after a batch does not depend on the order, nor on how events are dealt
to batches. It is a streaming aggregation, with one row for each coordinate in
RocksDB, so it does not have to fit in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tilewright.functions.geo import coord_of, year_of

#: What happens to a coordinate: an item of a layer (year, seq, href), or an outcome
#: (at, seq, n_detections, skip_reason).
EVENTS = "coord string, kind string, year int, seq long, href string, at timestamp, n_detections int, skip_reason string"
_ITEM = "{0}_year int, {0}_seq long, {0}_href string"
STATE = ", ".join([_ITEM.format("rgb"), _ITEM.format("dsm"), "done_at timestamp, done_seq long, n_detections int, skip_reason string"])
CHANGES = f"coord string, {STATE}, batch long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def item_events(items: DataFrame) -> DataFrame:
    """Events of catalogue items (seq, layer, item_id, href). Items without a coord or
    an href, and those of other layers than rgb and dsm, are none. A null seq comes
    last."""
    c = F.col
    seq = F.coalesce(c("seq").cast("long"), F.lit(2**63 - 1)).alias("seq")
    rows = items.select(coord_of(c("item_id")).alias("coord"), c("layer").alias("kind"), year_of(c("item_id")).alias("year"), seq, "href")
    rows = rows.where("coord is not null and href is not null and kind in ('rgb', 'dsm')")
    return rows.select("*", F.lit(None).cast("timestamp").alias("at"), F.lit(None).cast("int").alias("n_detections"), F.lit(None).cast("string").alias("skip_reason"))


def outcome_events(log: DataFrame) -> DataFrame:
    """Events of lines of the log of finished tiles (tile_id, n_detections, skip_reason,
    processed_at, seq). Lines without a tile or a time are none; a null seq comes
    first."""
    c, none = F.col, F.lit(None)
    seq = F.coalesce(c("seq").cast("long"), F.lit(-(2**63))).alias("seq")
    rows = log.where("tile_id is not null and processed_at is not null")
    return rows.select(F.translate("tile_id", "_", "-").alias("coord"), F.lit("done").alias("kind"), none.cast("int").alias("year"), seq, none.cast("string").alias("href"), c("processed_at").cast("timestamp").alias("at"), c("n_detections").cast("int").alias("n_detections"), "skip_reason")


_FIELDS = [c.split()[0] for c in STATE.split(", ")]


def folded_by_coord(events: DataFrame) -> DataFrame:
    """The state of each coordinate. The newest item of a layer is that of the largest
    year (an item without one is of the year 0), then the least seq and href; the last
    outcome that of the latest time, then the largest seq, n_detections and
    skip_reason. Other kinds of events are none."""
    c = F.col
    year = F.coalesce("year", F.lit(0)).cast("long")
    item = F.struct((-year).alias("before"), "seq", "href")
    # after the order, the content: a repeated line decides nothing by its arrival
    outcome = F.struct("at", "seq", F.coalesce("n_detections", F.lit(0)).alias("n"), F.coalesce("skip_reason", F.lit("")).alias("why"))
    best = [F.min(F.when(c("kind") == k, item)).alias(k) for k in ("rgb", "dsm")]
    kept = events.where("kind in ('rgb', 'dsm', 'done')").groupBy("coord").agg(*best, F.max(F.when(c("kind") == "done", outcome)).alias("done"))
    sides = [x for k in ("rgb", "dsm") for x in ((-c(f"{k}.before")).cast("int").alias(f"{k}_year"), c(f"{k}.seq").alias(f"{k}_seq"), c(f"{k}.href").alias(f"{k}_href"))]
    return kept.select("coord", *sides, c("done.at").alias("done_at"), c("done.seq").alias("done_seq"), c("done.n").alias("n_detections"), F.nullif("done.why", F.lit("")).alias("skip_reason"))


def fold_events(events: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Folds a stream of EVENTS into the state of each coordinate until it has taken
    in all that has arrived, and appends the states of the coordinates that a batch
    has events of to ``root``. Started again on the same checkpoint, it goes on from
    the state that it had. A batch that is done again replaces what it had written."""
    spark = events.sparkSession

    def store(df: DataFrame, batch_id: int) -> None:
        df.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{root}/batch-{batch_id}")

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        return folded_by_coord(events).writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before)


def tile_states(spark: SparkSession, root: str) -> DataFrame:
    """The last state of each coordinate, and as version the number of its different
    states so far; none comes back once it has changed."""
    stored = spark.read.schema(CHANGES).option("recursiveFileLookup", "true").parquet(root)
    state = F.struct(*_FIELDS)
    last = stored.groupBy("coord").agg(F.max(F.struct("batch", state.alias("s"))).alias("m"), F.count_distinct(state).alias("version"))
    return last.select("coord", *[F.col(f"m.s.{c}").alias(c) for c in _FIELDS], "version")


def newest_items(states: DataFrame) -> DataFrame:
    """layer, coord, href, yr of the newest item of each layer and coord."""
    sides = [F.struct(F.lit(s).alias("layer"), F.col(f"{s}_href").alias("href"), F.col(f"{s}_year").alias("yr")) for s in ("rgb", "dsm")]
    return states.select("coord", F.explode(F.array(*sides)).alias("s")).where("s.href is not null").select("s.layer", "coord", "s.href", "s.yr")


def open_tiles(states: DataFrame) -> DataFrame:
    """coord, rgb_url, dsm_url, status, n_detections of the coords that have both
    layers. status: todo without an outcome, else skipped or ok."""
    status = F.when(F.col("done_at").isNull(), "todo").when(F.col("skip_reason").isNotNull(), "skipped").otherwise("ok")
    return states.where("rgb_href is not null and dsm_href is not null").select("coord", F.col("rgb_href").alias("rgb_url"), F.col("dsm_href").alias("dsm_url"), status.alias("status"), "n_detections")
