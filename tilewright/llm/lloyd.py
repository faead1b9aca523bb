"""What the operators on integer vectors share: scaled rows, exact assignment in
numpy, and rounds of Lloyd's algorithm whose sums are made by Spark.

A round is one pass over the rows. Each task adds up its own rows by centroid and
gives one row for each centroid it met, so what is shuffled and what the driver
collects depend on the number of centroids and not on the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scaled components must be smaller, so that sums of squares fit in 64 bits.
MOST = 2**27
#: Rows that are compared with all centroids at a time.
SLICE = 4096


def whole_vectors(vectors: DataFrame, scale: int, *keep: str) -> DataFrame:
    """(keep..., v): floor(scale * x) of every component x, as longs. Vectors that are
    null or hold null or non-finite components go. A scaled component of 2^27 or
    more is an error."""
    x = F.transform("embedding", lambda c: F.lit(float(scale)) * c.cast("double"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(*keep, x.alias("x")).where(F.col("x").isNotNull() & fine)
    whole = F.transform("x", lambda c: F.when(F.abs(c) < MOST, F.floor(c)).otherwise(F.raise_error(F.lit("a scaled component is too large"))))
    return rows.select(*keep, whole.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of one width as a matrix of int64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest centroid of each row; ties go to the
    lesser index. Exact: whole numbers below 2^53 in doubles, else 64-bit ones."""
    index, square = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    most = max((int(np.abs(m).max()) for m in (rows, centroids) if m.size), default=0)
    small = rows.shape[1] * (2 * most) ** 2 < 2**53
    for at in range(0, len(rows), SLICE):
        part = slice(at, at + SLICE)
        if small:
            m, c = rows[part].astype(np.float64), centroids.astype(np.float64)
            d = (m * m).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (m @ c.T)
        else:
            d = sum((rows[part, j, None] - centroids[None, :, j]) ** 2 for j in range(rows.shape[1]))
        index[part] = d.argmin(1)
        square[part] = d.min(1)
    return index, square


Assign = Callable[[int, np.ndarray], tuple[np.ndarray, np.ndarray]]


def moved(rows: DataFrame, books: list[np.ndarray], assign: Assign) -> list[np.ndarray]:
    """The centroids after one round over weighted rows (pos, v, n): each becomes the
    componentwise floor(sum / count) of its rows; those without rows stay.
    assign(pos, matrix) gives the index of each row's centroid in books[pos]."""
    width = books[0].shape[1]
    names = [f"s{j}" for j in range(width)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(b), width + 1), np.int64) for b in books]
        for batch in batches:
            where = batch.column(0).to_numpy()
            m, n = matrix(batch.column(1), width), batch.column(2).to_numpy()
            for pos in np.unique(where).tolist():
                at = np.flatnonzero(where == pos)
                index = assign(pos, m[at])[0]
                np.add.at(total[pos], index, np.concatenate([n[at, None], m[at] * n[at, None]], axis=1))
        for pos, t in enumerate(total):
            met = np.flatnonzero(t[:, 0])
            columns = [np.full(len(met), pos), met, *t[met].T]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["pos", "entry", "n", *names])

    found = rows.select("pos", "v", "n").mapInArrow(sums, "pos long, entry long, n long, " + ", ".join(f"{c} long" for c in names))
    out = [b.copy() for b in books]
    # one row for each centroid at most
    for r in found.groupBy("pos", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect():
        out[r.pos][r.entry] = [r[c] // r.n for c in names]
    return out


def digest(*books: np.ndarray) -> str:
    """SHA-256, in lower-case hex, of all components in order, as decimal numbers
    with commas between them."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
