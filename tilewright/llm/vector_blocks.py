"""Vectors in blocks of bounded size, and the pairing of query and candidate blocks."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable_vectors(vectors: DataFrame, zeros: bool) -> DataFrame:
    """(vec_id, dim, v): vectors of doubles without null or non-finite components;
    those of zeros only if asked for. Null ids, null and empty vectors go."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0").where(fine)
    if not zeros:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.select("vec_id", F.size("v").alias("dim"), "v")


def as_blocks(rows: DataFrame, n_blocks: int, build: Callable[[np.ndarray, np.ndarray], bytes]) -> DataFrame:
    """One row for each block: its ids as int64 bytes, and build(ids, matrix).
    Blocks hold vectors of one length; a hash of the row deals them out."""

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        ids, m = pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()).astype(np.float64)
        return pd.DataFrame({"dim": [int(pdf["dim"].iloc[0])], "block": [int(pdf["block"].iloc[0])], "ids": [ids.tobytes()], "data": [build(ids, m)]})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)).cast("int"))
    return dealt.groupBy("dim", "block").applyInPandas(block, "dim int, block int, ids binary, data binary")


#: Candidate blocks of one task at most, whatever the size of the tables.
GROUP_BLOCKS = 64


def search_blocks(queries: DataFrame, blocks: DataFrame, n_blocks: int, q_blocks: int, visit: Callable, state: Callable) -> DataFrame:
    """Runs ``visit`` over every query block and candidate block of one length.

    A task holds one query block and a group of candidate blocks, and goes
    through these in order, so the k best so far carry over from one to the next.
    state(ids, data) makes what it carries; visit(state, ids, data) takes in a
    block; state.best() gives (query_id, vec_id, score) arrays, at most k of a
    query. n_blocks and q_blocks: how many blocks of each there are; few query
    blocks make for smaller groups, so that there are tasks enough.

    Every candidate block travels once for each query block, and every query block
    once for each group. At a fixed number of queries the shuffle grows with the
    rows; query blocks are large, so that there are few of them.
    """
    groups = max(1, -(-n_blocks // GROUP_BLOCKS), min(n_blocks, -(-24 // q_blocks)))
    # a stated query set against all rows, in blocks: pairs of blocks, never of rows
    sent = blocks.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).withColumn("group", F.pmod("block", F.lit(groups)))
    asked = queries.withColumnRenamed("block", "q_block").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    key = ["dim", "q_block", "group"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        held = state(np.frombuffer(right["ids"][0], np.int64), right["data"][0])
        for ids, data in left.sort_values("block")[["ids", "data"]].itertuples(index=False):
            visit(held, np.frombuffer(ids, np.int64), data)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), held.best(), strict=True)))

    kind = "query_id long, vec_id long, score " + ("long" if state.integer else "double")
    return sent.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(run, kind)


class Best:
    """The k best candidates of each query of a block, each in a heap with the worst
    on top; ties go to the lesser id. lowest: whether small scores are good."""

    def __init__(self, ids: np.ndarray, k: int, lowest: bool, dtype):
        self.ids, self.k, self.sign, self.dtype = ids, k, -1 if lowest else 1, dtype
        self.heaps: list[list[tuple]] = [[] for _ in ids]

    def bound(self, q: int):
        """The kth best score so far, or None."""
        heap = self.heaps[q]
        return self.sign * heap[0][0] if len(heap) == self.k else None

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        heap = self.heaps[q]
        for i, s in zip(ids.tolist(), scores.tolist(), strict=True):
            item = (self.sign * s, -i)
            if len(heap) < self.k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)

    def best(self):
        rows = [(q, -i, self.sign * s) for q, heap in zip(self.ids.tolist(), self.heaps, strict=True) for s, i in sorted(heap, reverse=True)]
        return tuple(np.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ((), (), ()), (np.int64, np.int64, self.dtype), strict=True))


def ranked(found: DataFrame, k: int, lowest: bool) -> DataFrame:
    """query_id, rank, vec_id, score of the k best in all groups."""
    by = F.col("score").asc() if lowest else F.col("score").desc()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(by, "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def block_counts(rows: DataFrame, rows_per_block: int) -> int:
    return max(1, -(-rows.count() // rows_per_block))
