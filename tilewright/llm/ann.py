"""Nearest neighbours by a block matrix join over quantised vectors.

Every vector is stored as int8 times a scale of its own, with the length of the
error this makes. A query block and a candidate block give one tile of integer
products, and with it a distance for every pair that is wrong by no more than
the two errors. Pairs whose least possible distance is above the k-th greatest
possible one are out; the others are recomputed in double precision on the
original vectors, and the k best carry over from block to block. Nothing is lost
by the quantisation, so recall is 1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .vector_blocks import Best, as_blocks, block_counts, ranked, search_blocks, usable_vectors

BLOCK_ROWS, QUERY_ROWS = 1024, 4096
#: Query rows that meet a candidate block in one tile.
TILE_ROWS = 512
#: What rounding in the tile's own arithmetic may add, as a share of the lengths.
ROUNDING = 1e-6


class Quantised:
    """``m`` as int8 codes; error: length of what the codes miss, for each row."""

    def __init__(self, m: np.ndarray):
        self.m = m
        self.scale = np.abs(m).max(1) / 127
        self.codes = np.rint(m / np.where(self.scale, self.scale, 1)[:, None]).astype(np.int8)
        told = self.codes * self.scale[:, None]
        # what overflows has no bounds, and its pairs are recomputed
        with np.errstate(over="ignore", invalid="ignore"):
            self._measure(told)

    def _measure(self, told: np.ndarray) -> None:
        m = self.m
        self.error = np.sqrt(((m - told) ** 2).sum(1)) * (1 + ROUNDING)
        self.length = np.sqrt((told**2).sum(1))

    def dump(self) -> bytes:
        head = np.array([*self.m.shape], np.int64)
        return b"".join(x.tobytes() for x in (head, self.m, self.scale, self.error, self.length, self.codes))

    @classmethod
    def load(cls, data: bytes) -> Quantised:
        out = cls.__new__(cls)
        n, d = np.frombuffer(data, np.int64, 2)
        at = 16
        for name, size in (("m", n * d), ("scale", n), ("error", n), ("length", n)):
            setattr(out, name, np.frombuffer(data, np.float64, size, at))
            at += 8 * size
        out.m = out.m.reshape(n, d)
        out.codes = np.frombuffer(data, np.int8, n * d, at).reshape(n, d)
        return out

    def tile(self, other: Quantised, rows: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) possible distance of each pair of these rows and the
        other's; 0 and infinity where that is not finite."""
        with np.errstate(over="ignore", invalid="ignore"):
            least, greatest = self._tile(other, rows)
        fine = np.isfinite(least) & np.isfinite(greatest)
        return np.where(fine, least, 0), np.where(fine, greatest, np.inf)

    def _tile(self, other: Quantised, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        codes, scale, length, error = self.codes[rows], self.scale[rows], self.length[rows], self.error[rows]
        # sums of int8 products are whole numbers below 2^24 up to 1040 components, exact as float32
        kind = np.float32 if self.codes.shape[1] <= 1040 else np.float64
        product = (codes.astype(kind) @ other.codes.astype(kind).T).astype(np.float64)
        square = length[:, None] ** 2 + other.length[None, :] ** 2 - 2 * product * scale[:, None] * other.scale[None, :]
        about = np.sqrt(np.maximum(square, 0))
        wrong = error[:, None] + other.error[None, :] + ROUNDING * (length[:, None] + other.length[None, :])
        return about - wrong, about + wrong


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances; squares are added in the order of the components. Where
    squares overflow, differences are divided by their largest first."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(rows))
        for column, x in zip(rows.T, query, strict=True):
            total += (column - x) ** 2
        out = np.sqrt(total)
        for k in np.flatnonzero(~np.isfinite(total)):
            far = np.abs(rows[k] / 2 - query / 2)
            out[k] = np.sqrt(((far / far.max()) ** 2).sum()) * far.max() * 2
    return out


class _Search:
    def __init__(self, ids: np.ndarray, data: bytes, k: int):
        self.queries = Quantised.load(data)
        self.found = Best(ids, k, lowest=True, dtype=np.float64)

    def best(self):
        return self.found.best()


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """For each row of ``queries`` (vec_id, embedding) the k rows of ``vectors``
    at the smallest Euclidean distance, its own vec_id aside, all if there are
    fewer: query_id, rank (from 1), vec_id, score (the distance, in double
    precision). Ties go to the lesser vec_id.

    Vectors that are null, empty, zero or hold null or non-finite components take
    no part, nor do null ids. Vectors meet those of their own length only. A
    repeated vec_id is as many candidates, but one query (the least vector).
    """
    rows = usable_vectors(vectors, zeros=False)
    asked = usable_vectors(queries, zeros=False).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("m")).select("vec_id", "m.dim", "m.v")
    blocks, q_blocks = block_counts(rows, BLOCK_ROWS), block_counts(asked, QUERY_ROWS)
    stored = written(as_blocks(rows, blocks, lambda ids, m: Quantised(m).dump()), "int8-blocks")
    q = written(as_blocks(asked, q_blocks, lambda ids, m: Quantised(m).dump()), "int8-queries")

    def state(ids, data):
        return _Search(ids, data, k)

    def visit(search, ids, data):
        block, best = Quantised.load(data), search.found
        for first in range(0, len(best.ids), TILE_ROWS):
            part = slice(first, min(first + TILE_ROWS, len(best.ids)))
            least, greatest = search.queries.tile(block, part)
            own = best.ids[part, None] == ids[None, :]
            greatest[own] = np.inf
            few = min(k, len(ids)) - 1
            limit = np.partition(greatest, few, axis=1)[:, few] if len(ids) >= k else np.full(len(greatest), np.inf)
            limit = np.minimum(limit, [np.inf if (x := best.bound(n)) is None else x for n in range(part.start, part.stop)])
            left = (least <= limit[:, None]) & ~own
            for n in np.flatnonzero(left.any(1)):
                at = np.flatnonzero(left[n])
                best.add(first + n, ids[at], distances(block.m[at], search.queries.m[first + n]))

    state.integer = False
    return ranked(search_blocks(q, stored, blocks, q_blocks, visit, state), k, lowest=True)
