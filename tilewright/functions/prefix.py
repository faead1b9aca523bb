"""Running sums over a whole table, without a task that sorts or sums all of it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.storage import written

#: Ranges that a table is dealt into at most; their sums pass through the driver.
MOST_RANGES = 10_000


def sums_before(rows: DataFrame, order: list[str], size: str, per_range: int = 100_000) -> DataFrame:
    """``rows`` as a struct ``row``, and ``before``: the sum of ``size`` over all rows that
    come earlier in ``order``. Equal rows of the order come in any one order, but a row
    is counted before another or after it, never both. A null size counts as 0.

    Spark samples the order and deals rows into ranges, however few different values its
    first column has; each is sorted and summed by itself. The sums of the ranges, at
    most MOST_RANGES numbers, are added up on the driver and given back.
    """
    spark = rows.sparkSession
    n = rows.count()
    ranges = max(1, min(MOST_RANGES, -(-n // per_range)))
    value = F.coalesce(F.col(size).cast("long"), F.lit(0))
    dealt = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *[F.col(c).alias(f"o{k}") for k, c in enumerate(order)], value.alias("size"))
    # a hash of the row ends the order, so that rows of one key do not stay in one range
    keys = [*[f"o{k}" for k in range(len(order))], "tie"]
    dealt = dealt.withColumn("tie", F.xxhash64(F.to_json("row")))
    sorted_ = dealt.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).select("row", "size", F.spark_partition_id().alias("range"), F.lit(0).cast("long").alias("inside"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = 0
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            sums = so_far + np.cumsum(sizes)
            so_far = int(sums[-1]) if len(sums) else so_far
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums - sizes, pa.int64())], schema=batch.schema)

    held = written(sorted_.mapInArrow(run, sorted_.schema), "ranges")
    totals = {r.range: r.total for r in held.groupBy("range").agg(F.sum("size").alias("total")).collect()}
    places = sorted(totals)
    starts = dict(zip(places, accumulate([0, *[totals[p] for p in places][:-1]]), strict=True)) if places else {}
    offsets = spark.createDataFrame(list(starts.items()), "range int, start long")
    return held.join(F.broadcast(offsets), "range").select("row", (F.col("start") + F.col("inside")).alias("before"))

