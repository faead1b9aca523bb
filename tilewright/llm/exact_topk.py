"""Exact top-k by inner product, with a KD-tree in each shard.

Vectors are integers (components scaled and rounded down), so scores are exact.
Each shard of the candidates is a KD-tree: median splits along the widest side,
and at each node the tight bounding box of what lies below. The largest inner
product of a query with any point of a box is known from the box alone. A query
visits nodes best bound first and stops at the first bound below its k-th score;
that score carries over from shard to shard of a task.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .vector_blocks import Best, as_blocks, block_counts, ranked, search_blocks, usable_vectors

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 2048, 4096, 64
#: Whole numbers below this are exact as doubles.
EXACT = 2.0**53


class KdTree:
    """left and right: the children of a node, -1 at a leaf; first and last: the
    run of rows below it, in the order of ``rows``."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        rows, nodes = np.arange(len(points)), []

        def grow(first: int, last: int) -> int:
            below = points[rows[first:last]]
            low, high = below.min(0), below.max(0)
            me = len(nodes)
            nodes.append([low, high, -1, -1, first, last])
            wide = int((high - low).argmax())
            if last - first > leaf_rows and high[wide] > low[wide]:
                half = (last - first) // 2
                rows[first:last] = rows[first:last][np.argpartition(below[:, wide], half)]
                nodes[me][2] = grow(first, first + half)
                nodes[me][3] = grow(first + half, last)
            return me

        grow(0, len(points))
        self.low, self.high = np.array([n[0] for n in nodes]), np.array([n[1] for n in nodes])
        self.left, self.right, self.first, self.last = np.array([n[2:] for n in nodes], np.int32).T
        self.rows, self.points = rows, points[rows]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product of each query with each node's box, or a little
        more where products are too large to be exact as doubles."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        with np.errstate(over="ignore", invalid="ignore"):
            out = up @ self.high.T + down @ self.low.T
            size = up @ np.abs(self.high).T - down @ np.abs(self.low).T
            return np.where(size < EXACT, out, np.where(np.isfinite(size), out + size * 1e-9, np.inf))

    _PARTS = ("low", "high", "left", "right", "first", "last", "rows", "points")

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{p: getattr(self, p) for p in self._PARTS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> KdTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as parts:
            for p in cls._PARTS:
                setattr(tree, p, parts[p])
        return tree


def products(points: np.ndarray, query: np.ndarray, small: bool) -> np.ndarray:
    """Inner products of whole numbers, exact at any size. small: no sum can reach
    EXACT. Scores that do not fit into 64 bits are an error."""
    if small:
        return (points @ query).astype(np.int64)
    whole = [int(x) for x in query.tolist()]
    found = [sum(int(x) * y for x, y in zip(p, whole, strict=True)) for p in points.tolist()]
    if max(map(abs, found)) >= 2**63:
        raise OverflowError("an inner product does not fit into 64 bits")
    return np.array(found, np.int64)


def _best_first(tree: KdTree, ids: np.ndarray, bounds: np.ndarray, query: np.ndarray, small: bool, q: int, best: Best) -> None:
    own = best.ids[q]
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        kth = best.bound(q)
        if kth is not None and -bound < kth:
            return
        if tree.left[node] >= 0:
            for child in (tree.left[node], tree.right[node]):
                if kth is None or bounds[child] >= kth:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        a, b = tree.first[node], tree.last[node]
        others = ids[a:b] != own
        scores, found = products(tree.points[a:b][others], query, small), ids[a:b][others]
        keep = scores >= (scores.min(initial=0) if kth is None else kth)
        if keep.any():
            best.add(q, found[keep], scores[keep])


class _Search:
    def __init__(self, ids: np.ndarray, data: bytes, k: int):
        self.queries = np.frombuffer(data, np.float64).reshape(len(ids), -1)
        self.found = Best(ids, k, lowest=False, dtype=np.int64)

    def best(self):
        return self.found.best()


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """For each row of ``queries`` (vec_id, embedding) the k rows of ``vectors``
    with the largest inner product, its own vec_id aside, all if there are fewer:
    query_id, rank (from 1), vec_id, score. Ties go to the lesser vec_id.

    Components x count as floor(scale * x). Vectors that are null, empty or hold
    null or non-finite components take no part, nor do null ids; zero vectors do.
    Vectors meet those of their own length only. A repeated vec_id is as many
    candidates, but one query (the least vector). Products beyond 2^53 are added up
    as whole numbers of any size; a score beyond 64 bits is an error.
    """

    def whole(df: DataFrame) -> DataFrame:
        return usable_vectors(df, zeros=True).withColumn("v", F.transform("v", lambda x: F.when(F.abs(x) < EXACT / scale, F.floor(x * scale).cast("double")).otherwise(x * scale)))

    rows = whole(vectors)
    asked = whole(queries).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("m")).select("vec_id", "m.dim", "m.v")
    shards, blocks = block_counts(rows, SHARD_ROWS), block_counts(asked, QUERY_ROWS)
    trees = written(as_blocks(rows, shards, lambda ids, m: KdTree(m).dump()), "kd-trees")
    q = written(as_blocks(asked, blocks, lambda ids, m: m.tobytes()), "kd-queries")

    def state(ids, data):
        return _Search(ids, data, k)

    def visit(search, ids, data):
        tree = KdTree.load(data)
        bounds = tree.bounds(search.queries)
        mine = ids[tree.rows]
        # the root's box holds all points
        small = np.abs(search.queries) @ np.maximum(np.abs(tree.low[0]), np.abs(tree.high[0])) < EXACT
        for n in range(len(search.queries)):
            _best_first(tree, mine, bounds[n], search.queries[n], small[n], n, search.found)

    state.integer = True
    return ranked(search_blocks(q, trees, shards, blocks, visit, state), k, lowest=False)
