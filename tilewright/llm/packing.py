"""Best-fit packing of token sequences, in supersteps.

A superstep takes a band of pieces, from the largest size that is left down to
``1 / SPREAD`` of it (further down where that is a small part of a sequence), and the
gaps that may hold one of them:

1. sequences are opened, as many as a lower bound says are needed in any case;
2. each gap is offered as places: some that hold the largest of these pieces, and
   what is over as one more place;
3. pieces and places are range-sorted together, from large to small, and each task
   sweeps its range: a piece takes the smallest place before it that is free, so of
   pieces that want one place the one of higher rank has it, and the others go on to
   the next larger place;
4. pieces that found no place in their own range take those that earlier ranges left,
   smallest first. Counts of what each range left settle which ones;
5. gaps shrink by what they took, and the next superstep begins with the pieces that
   are left and the next smaller ones.

A superstep places at least the largest piece that is left, and mostly nearly all.
The driver sees counts by size (at most ``capacity``) and by range; pieces and gaps
stay in tables. A superstep writes the gaps that it touched and no others: what the
bands so far leave alone stays where it was written, and is read by its size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from .shared import forget, joined, quoted, slices, written, written_slim
from .tokenise import default_tokenizer, encoder

#: Pieces and places that one task sweeps, about.
SHARD_PIECES = 100_000
#: Largest by smallest size of the pieces of a superstep, about ...
SPREAD = 1.5
#: ... or else the part of a sequence that they may differ by.
LEAST_BAND = 1 / 16

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SWEPT = "part int, nth long, row long, size long, seq long, gap long"


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole sequences, but for
    the first, which takes what is over."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    end = np.array([end_id], "<u4").tobytes()
    for batch in slices(batches):
        rows = []
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(path).encode(batch.column(1).to_pylist()), strict=True):
            ids += end
            rows += [(doc_id, k, s, n, zlib.crc32(memoryview(ids)[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(ids) // 4, capacity))]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])


def token_pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """Every whole text of ``docs`` (doc_id, text) as token ids and an end id,
    cut into pieces of at most ``capacity`` tokens: doc_id, piece, start, length
    and the crc32 of the piece's ids. A null text is an empty one."""
    path = tokenizer or default_tokenizer()
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(lambda it: _pieces(it, path, capacity, end_id), PIECES)


def sweep(events: Iterable[tuple[int, int, int | None, int | None]], taken: list) -> tuple[list, list]:
    """Sweeps (size, row, None, None) of pieces and (size, None, sequence, gap) of
    places, from large to small, places first among equals. Adds a (row, size,
    sequence, gap) to ``taken`` for each piece with a place, and gives the pieces
    without one, in order, and the places that are left, smallest first."""
    free, without = [], []
    for size, row, seq, gap in events:
        if row is None:
            free.append((seq, gap))
        elif free:
            taken.append((row, size, *free.pop()))
        else:
            without.append((row, size))
    return without, free[::-1]


def crossings(left: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """From (range, pieces left, places left), ranges in order: (range, first, end,
    other, shift), by which piece ``i`` that is left in ``range``, first <= i < end,
    takes place ``i + shift`` that is left in ``other``. Sizes fall from range to
    range, so the places of the last range before are the smallest."""
    stack, found = [], []
    for part, pieces, places in left:
        at = 0
        while at < pieces and stack:
            top = stack[-1]
            n = min(pieces - at, top[2])
            found.append((part, at, at + n, top[0], top[1] - at))
            at += n
            top[1] += n
            top[2] -= n
            if not top[2]:
                stack.pop()
        if places:
            stack.append([part, 0, places])
    return found


def sequences_needed(pieces: np.ndarray, gaps: np.ndarray, low: int, capacity: int) -> int:
    """Sequences that must be opened for ``pieces`` of more than ``low`` tokens beside
    ``gaps`` (both: how many there are of each size from 0 to ``capacity``). For each
    t, pieces above t fit only into gaps above t, by their tokens and by their number."""
    size = np.arange(capacity + 1)
    tokens = np.cumsum((size * (pieces - gaps))[::-1])[::-1]
    number = np.cumsum(pieces[::-1])[::-1]
    need = 0
    for t in range(low + 1, int(np.flatnonzero(pieces)[-1]) + 1):
        need = max(need, -(-int(tokens[t]) // capacity), -(-int(number[t] - gaps @ (size // t)) // (capacity // t)))
    return need


def _sweep_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, taken = TaskContext.get().partitionId(), []

    def events():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("value", "row", "seq", "gap")), strict=True)

    without, free = sweep(events(), taken)
    rows = [(part, None, *t) for t in taken]
    rows += [(part, k, *t, None, None) for k, t in enumerate(without)]
    rows += [(part, k, None, None, *t) for k, t in enumerate(free)]
    if rows:
        kinds = (pa.int32(), *[pa.int64()] * 5)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "nth", "row", "size", "seq", "gap"])


def _places(bins: DataFrame, low: int, top: int, most: int) -> DataFrame:
    """What ``bins`` (seq, gap) offer to pieces of more than ``low`` and at most
    ``top`` tokens: up to ``most`` places for any of them, and the rest of the gap."""
    whole = F.least(F.expr(f"gap div {top}"), F.lit(most)).cast("int")
    values = F.concat(F.array_repeat(F.lit(top).cast("long"), whole), F.array(F.col("gap") - whole * top))
    return bins.filter(F.col("gap") > low).select(F.explode(values).alias("value"), F.lit(None).cast("long").alias("row"), "seq", "gap").filter(F.col("value") > low)


def _counted(df: DataFrame, values: Column, capacity: int, name: str) -> tuple[DataFrame, np.ndarray]:
    """``df`` as a table, and how many of ``values`` (nulls apart) there are of each
    size from 0 to ``capacity``, counted by the job that writes it. The histogram has
    a bin for each size, so its counts are exact."""
    seen = Observation()
    out = written(df.observe(seen, F.histogram_numeric(values, F.lit(capacity + 2)).alias("sizes")), name)
    return out, _histogram(((b.x, b.y) for b in seen.get["sizes"] or ()), capacity)


def _superstep(pieces: DataFrame, places: DataFrame, parts: int, capacity: int) -> tuple[DataFrame, np.ndarray]:
    """One sweep of ``pieces`` (row, size) and ``places`` over ``parts`` ranges, as a
    table of row, size, seq, gap: pieces with the gap that they take or nulls, and
    places that were left with null pieces. Beside it, how many pieces of each size
    have no place."""
    unplaced = F.when(F.col("row").isNotNull() & F.col("seq").isNull(), F.col("size"))
    none = F.lit(None).cast("long")
    events = pieces.select(F.col("size").alias("value"), "row", none.alias("seq"), none.alias("gap")).unionByName(places)
    order = [F.desc("value"), F.asc_nulls_first("row"), F.asc("seq")]
    swept, over = _counted(events.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_sweep_range, _SWEPT), unplaced, capacity, "pack-swept")
    # Spark settles how many ranges there are, not ``parts``
    left = swept.filter("nth is not null").groupBy("part").agg(F.count("row"), F.count("seq")).orderBy("part").collect() if over.any() else []
    crossed = crossings(tuple(r) for r in left)
    if not crossed:
        return swept, over
    # at most two rows for each range
    cross = F.broadcast(swept.sparkSession.createDataFrame(crossed, "part int, first long, end long, other int, shift long"))
    free = swept.filter("nth is not null and seq is not null")
    taken = free.select(F.col("part").alias("other"), F.col("nth").alias("slot"), "seq", "gap")
    without = swept.filter("nth is not null and row is not null").select("part", "nth", "row", "size").alias("w")
    near = without.join(cross.alias("c"), F.expr("w.part = c.part and w.nth >= c.first and w.nth < c.end"), "left").select("row", "size", "other", F.expr("nth + shift").alias("slot"))
    columns = ["row", "size", "seq", "gap"]
    settled = swept.filter("nth is null").select(columns).union(near.join(taken, ["other", "slot"], "left").select(columns)).union(free.select(columns))
    out = _counted(settled, unplaced, capacity, "pack-settled")
    forget(swept)
    return out


def _histogram(rows: Iterable, capacity: int) -> np.ndarray:
    out = np.zeros(capacity + 1, np.int64)
    for value, n in rows:
        out[value] += n
    return out


def band(top: int, capacity: int) -> int:
    """The size that pieces must exceed to share a superstep with ones of ``top``."""
    return max(0, min(int(top / SPREAD), top - int(capacity * LEAST_BAND)))


def _supersteps(spark: SparkSession, sizes: DataFrame, fresh: np.ndarray, capacity: int, shard_pieces: int) -> list[DataFrame]:
    """Tables with (row, size, seq, gap), rows and sequences not null, of all ``sizes``
    (row, size), of which ``fresh`` counts how many there are of each size."""
    size = np.arange(capacity + 1)
    over = spark.createDataFrame([], "row long, size long")
    gaps, pieces, below, used, settled, shrunk = np.zeros_like(fresh), np.zeros_like(fresh), capacity, 0, [], []
    while pieces.any() or fresh[: below + 1].any():
        top = int(np.flatnonzero(pieces + np.where(size <= below, fresh, 0))[-1])
        low, before = band(top, capacity), below
        now = pieces + np.where((size > low) & (size <= below), fresh, 0)
        todo = over.unionByName(sizes.filter((F.col("size") > low) & (F.col("size") <= below)))
        below = min(below, low)

        needed = sequences_needed(now, np.where(size > low, gaps, 0), low, capacity)
        gaps[capacity] += needed
        # the last superstep touched all gaps above its band: older tables hold smaller ones only
        state = [t.filter(F.col("gap") > low) for t in shrunk[-1:]]
        if shrunk[:-1]:
            state.append(joined(*shrunk[:-1]).filter((F.col("gap") > low) & (F.col("gap") <= before)))
        if needed:
            state.append(spark.range(used, used + needed, 1, -(-needed // shard_pieces)).select(F.col("id").alias("seq"), F.lit(capacity).cast("long").alias("gap")))
        used += needed
        # no more places than pieces, about
        most, whole = 1, size // top
        while most < whole[-1] and gaps @ np.minimum(whole, most) < now.sum():
            most += 1
        n_places = int(gaps[low + 1 :].sum() + gaps @ np.minimum(whole, most))
        parts = -(-(int(now.sum()) + n_places) // shard_pieces)
        swept, pieces = _superstep(todo, _places(reduce(DataFrame.unionByName, state), low, top, most), parts, capacity)
        settled.append(swept)
        over = swept.filter("row is not null and seq is null").select("row", "size")
        touched = swept.filter("seq is not null").groupBy("seq").agg((F.max("gap") - F.coalesce(F.sum("size"), F.lit(0))).alias("gap")).filter("gap > 0")
        touched, found = _counted(touched, F.col("gap"), capacity, "pack-gaps")
        shrunk.append(touched)
        gaps = np.where(size > low, 0, gaps) + found
    forget(*shrunk)
    return settled


def pack_pieces(pieces: DataFrame, capacity: int = 2048, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (with length between 1 and capacity) with sequence_id and offset:
    the pieces of a sequence lie without gaps from 0 and hold at most ``capacity``
    tokens.

    Repeated rows are packed as often as they come; null doc_ids and pieces are
    packed like others. Other columns stay, whatever their names and kinds; ones named
    as the two that are added are an error, as are lengths that are null or out of
    range. A task sweeps about ``shard_pieces`` pieces and places of a superstep. One
    table stays in the shared folder: the one that the result reads.
    """
    spark = pieces.sparkSession
    if clash := {"sequence_id", "offset"} & {n.lower() for n in pieces.columns}:
        raise ValueError(f"columns that packing adds are there already: {sorted(clash)}")
    whole = pieces.withColumn("length", F.col("length").cast("long"))
    rest = F.struct(*(F.col(quoted(n)) for n in whole.columns)).alias("rest")
    held = written_slim(whole.select(rest, F.col("length").alias("size"), F.monotonically_increasing_id().alias("row")).sortWithinPartitions("size"), "pack-pieces")
    low, high, bad = held.agg(F.min("size"), F.max("size"), F.count_if(F.col("size").isNull())).first()
    if bad or low is not None and (low < 1 or high > capacity):
        forget(held)
        raise ValueError(f"lengths must be from 1 to {capacity}")
    if low is None:
        none = F.lit(None).cast("long")
        return held.select("rest.*", none.alias("sequence_id"), none.alias("offset"))
    # at most ``capacity`` counts
    fresh = _histogram(((r["size"], r["count"]) for r in held.groupBy("size").count().collect()), capacity)
    settled = _supersteps(spark, held.select("row", "size"), fresh, capacity, shard_pieces)
    places = reduce(DataFrame.union, (t.filter("row is not null and seq is not null").select("row", "size", "seq") for t in settled))
    # a sequence holds at most ``capacity`` pieces
    within = Window.partitionBy("seq").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    put = places.select("row", F.col("seq").alias("sequence_id"), (F.sum("size").over(within) - F.col("size")).alias("offset"))
    out = written(held.join(put, "row").select("rest.*", "sequence_id", "offset"), "pack-packed")
    forget(held, *settled)
    return out


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 0, tokenizer: str | None = None) -> DataFrame:
    """Packs all ``docs`` (doc_id, text) into sequences of at most ``capacity``
    tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece, the end id alone. A long document is cut,
    and its pieces are packed apart. Repeated rows are packed as often as they
    come; a null doc_id stays null; other columns are ignored. An empty table
    gives an empty result.
    """
    return pack_pieces(token_pieces(docs, capacity, end_id, tokenizer), capacity)
