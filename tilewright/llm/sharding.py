"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard stands at many places of a ring. A document goes to the next shard
clockwise of its own place; if that is full, on to the next that is not. Which
shard is full when is settled by one order of all documents, their *priority*:
the result is that of inserting them one by one in that order. Shards take no
more than their capacity, so the balance is guaranteed, and only documents that
overflow move beyond their first shard.

A shard is full from some priority on. Once these cut-offs (one for each shard)
are known, the shard of every document follows from the document alone. They are
found from counts: documents by priority bucket and arc of the ring, a table whose
size depends on the ring only. A bucket in which a shard fills up is counted
again in finer buckets, and looked at row by row when it is small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Buckets of one count, as bits of the priority.
BITS = 8
#: Rows of a bucket that the driver puts in order at most.
FEW_ROWS = 20_000


@dataclass
class Ring:
    """places: sorted positions of the virtual nodes; order: for each of them, all
    shards in the order in which a walk clockwise first meets them."""

    shards: int
    virtual_nodes: int = 64
    places: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)

    def __post_init__(self):
        owner = np.repeat(np.arange(self.shards), self.virtual_nodes)
        names = [f"shard-{s}/{v}".encode() for s in range(self.shards) for v in range(self.virtual_nodes)]
        places = np.array([_hash(n) for n in names], np.uint64)
        rank = np.lexsort((owner, places))
        self.places, owner = places[rank], owner[rank]
        self.order = np.empty((len(owner), self.shards), np.int32)
        for k in range(len(owner)):
            _, first = np.unique(np.roll(owner, -k), return_index=True)
            self.order[k] = np.roll(owner, -k)[np.sort(first)]

    def arcs(self, points: np.ndarray) -> np.ndarray:
        """The index of the next place clockwise of each point."""
        return np.searchsorted(self.places, points.astype(np.uint64)) % len(self.places)


def _hash(name: bytes) -> int:
    from hashlib import blake2b

    return int.from_bytes(blake2b(name, digest_size=8).digest(), "little")


def even_capacities(rows: int, shards: int) -> list[int]:
    """Counts at most one apart that add up to ``rows``."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _placed(batches: Iterator[pa.RecordBatch], ring: Ring) -> Iterator[pa.RecordBatch]:
    """The last column, a point of the ring, as the arc that it lies on."""
    for batch in batches:
        arc = ring.arcs(batch.column(batch.num_columns - 1).to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(arc, pa.int32())], [*batch.schema.names[:-1], "arc"])


def cut_offs(rows: DataFrame, ring: Ring, capacities: list[int]) -> list[tuple[int, int] | None]:
    """For each shard the (priority, row) of the last document that it takes, or
    None if it never fills up. rows: priority, row, arc."""
    room = np.array(capacities, np.int64)
    last: list[tuple[int, int] | None] = [None] * ring.shards
    for s in np.flatnonzero(room == 0):
        last[s] = (-(2**63), -1)

    def targets() -> np.ndarray:
        return ring.order[np.arange(len(ring.order)), (room[ring.order] > 0).argmax(axis=1)]

    def walk(part: DataFrame, low: int, bits: int, by: str = "priority") -> None:
        """Inserts the documents with priorities from low to low + 2^bits - 1; those
        of one priority (repeated rows) by row."""
        step = max(0, bits - BITS)
        bucket = F.shiftright(F.col(by) - F.lit(low), step) if bits < 64 else F.shiftright(by, step) + F.lit(1 << (BITS - 1))
        counts = np.zeros((1 << min(BITS, bits), len(ring.places)), np.int64)
        for r in part.groupBy(bucket.cast("int").alias("bucket"), "arc").count().collect():
            counts[r.bucket, r.arc] = r["count"]
        for b in range(len(counts)):
            to = targets()
            load = np.bincount(to, counts[b], ring.shards).astype(np.int64)
            if (load <= room).all() and not ((load == room) & (load > 0)).any():
                room[:] -= load
                continue
            first = low + (b << step)
            inner = part.where(F.col(by).between(first, first + (1 << step) - 1))
            if counts[b].sum() > FEW_ROWS:
                if step > 0:
                    walk(inner, first, step, by)
                else:
                    walk(inner, -(2**63), 64, "row")
                continue
            # FEW_ROWS at most, in one job: an iterator would start a job for every partition of the sort
            for p, r, arc in sorted(map(tuple, inner.select("priority", "row", "arc").collect())):
                s = targets_one(arc)
                room[s] -= 1
                if room[s] == 0:
                    last[s] = (p, r)

    def targets_one(arc: int) -> int:
        return next(s for s in ring.order[arc] if room[s] > 0)

    walk(rows, -(2**63), 64)
    return last


def _dealt(batches: Iterator[pa.RecordBatch], ring: Ring, last: list[tuple[int, int] | None]) -> Iterator[pa.RecordBatch]:
    p_end = np.array([2**63 - 1 if x is None else x[0] for x in last], np.int64)
    r_end = np.array([2**63 - 1 if x is None else x[1] for x in last], np.int64)
    for batch in batches:
        order = ring.order[batch.column("arc").to_numpy()]
        p, r = batch.column("priority").to_numpy()[:, None], batch.column("row").to_numpy()[:, None]
        takes = (p < p_end[order]) | (p == p_end[order]) & (r <= r_end[order])
        shard = order[np.arange(len(order)), takes.argmax(axis=1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32()), pa.array(takes.argmax(axis=1), pa.int32())], [*batch.schema.names, "shard", "steps"])


def shard_documents(docs: DataFrame, shards: int = 8, virtual_nodes: int = 64, capacities: list[int] | None = None) -> DataFrame:
    """The shard of every row of ``docs`` (doc_id, text): doc_id, size (UTF-8
    bytes and 1; a null text has 1), text_crc32, law, shard, slot, steps (shards
    that were passed as full).

    By default the counts of the shards are at most one apart (law "rows").
    ``capacities`` gives other limits, which must add up to the rows at least.
    The key is (doc_id, text); rows that agree in both differ in the order in
    which they were read only, and a null doc_id or text is a key like any.
    Slots count from 0 without gaps in each shard, in order of priority. More
    shards than rows leave some empty; an empty table gives an empty result.
    """
    ring = Ring(shards, virtual_nodes)
    text = F.col("text").cast("string")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")))
    keyed = slim.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.xxhash64(F.lit("priority"), "doc_id", "text").alias("priority"), F.xxhash64(F.lit("point"), "doc_id", "text").alias("point"))
    rows = written(keyed.mapInArrow(lambda it: _placed(it, ring), "doc_id long, size long, text_crc32 long, priority long, arc int").withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    n = rows.count()
    limits = capacities or even_capacities(n, shards)
    if len(limits) != shards or sum(limits) < n:
        raise ValueError("the capacities must be one for each shard and hold all rows")
    last = cut_offs(rows, ring, limits) if n else [None] * shards
    kept = "doc_id long, size long, text_crc32 long, priority long, arc int, row long, shard int, steps int"
    dealt = rows.mapInArrow(lambda it: _dealt(it, ring, last), kept)

    # slots: ranks inside (shard, bucket), and the rows of the buckets before
    bits = max(4, min(20, (max(1, n) // 2000).bit_length()))
    dealt = dealt.withColumn("bucket", F.shiftright("priority", 64 - bits).cast("int"))
    before = dealt.groupBy("shard", "bucket").count().withColumn("before", F.sum("count").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("count")).drop("count")
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("priority", "row")) - 1
    return (
        dealt.withColumn("rank", rank)
        .join(before, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law") if capacities is None else F.lit("capacity").alias("law"), "shard", (F.col("rank") + F.col("before")).cast("long").alias("slot"), "steps")
    )
