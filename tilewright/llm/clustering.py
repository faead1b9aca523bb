"""Clusters around centroids, with partial-distance search.

Squared differences are added up over the dimensions of the greatest variance
first. A centroid is given up once its partial sum is strictly above the best
distance that the vector has so far; whoever survives has gone through all
dimensions, so the result is that of the full search, ties included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lloyd import digest, matrix, moved, whole_vectors
from .shared import forget, written

RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
#: Dimensions that are added up between two looks at the best distance.
STEP = 8
#: Vectors that are searched at a time.
SLICE = 8192


class PartialSearch:
    """``search(rows)`` gives (cluster, squared distance) of each row. order: the
    dimensions, those of the greatest variance first. ``terms`` counts the squared
    differences that were made, ``pairs`` the pairs of rows and centroids."""

    def __init__(self, centroids: np.ndarray, order: np.ndarray):
        self.order, self.centroids = order, centroids[:, order]
        self.terms = self.pairs = 0

    def __call__(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cluster, distance = np.empty((2, len(rows)), np.int64)
        for at in range(0, len(rows), SLICE):
            part = slice(at, at + SLICE)
            cluster[part], distance[part] = self._search(rows[part][:, self.order])
        return cluster, distance

    def _squares(self, rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Squared lengths of the differences, row by row."""
        self.terms += rows.size
        difference = rows - centroids
        return np.einsum("ij,ij->i", difference, difference)

    def _search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c, (n, dim) = self.centroids, rows.shape
        k = len(c)
        self.pairs += n * k
        partial = np.stack([self._squares(rows[:, :STEP], np.broadcast_to(c[j, :STEP], (n, min(STEP, dim)))) for j in range(k)], axis=1)
        # the centroid that begins best is gone through first: it sets the bound
        cluster = partial.argmin(1)
        every = np.arange(n)
        best = partial[every, cluster] + self._squares(rows[:, STEP:], c[cluster, STEP:])
        alive = partial <= best[:, None]
        alive[every, cluster] = False
        row, other = np.nonzero(alive)
        so_far = partial[row, other]
        for at in range(STEP, dim, STEP):
            so_far = so_far + self._squares(rows[row, at : at + STEP], c[other, at : at + STEP])
            left = so_far <= best[row]
            row, other, so_far = row[left], other[left], so_far[left]
        # survivors are whole now; of each row the least distance, then the least number
        first = np.lexsort((other, so_far, row))
        row, other, so_far = row[first], other[first], so_far[first]
        top = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
        row, other, so_far = row[top], other[top], so_far[top]
        better = (so_far < best[row]) | ((so_far == best[row]) & (other < cluster[row]))
        cluster[row[better]], best[row[better]] = other[better], so_far[better]
        return cluster, best


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dim: int = 64, seed: int = 1) -> DataFrame:
    """One row for each kept row of ``vectors`` (vec_id, embedding): vec_id, cluster,
    distance (squared, to the cluster's centroid), cluster_inertia and inertia
    (distances summed over the cluster and over all), centroid_sha256 (of the
    centroid's components).

    Kept are vectors of exactly ``dim`` components, none null or non-finite; x
    becomes floor(scale * x). Centroids start as the k rows of the least SHA-256 of
    "seed:vec_id", in that order (null ids last, equal ids by vector; fewer rows,
    fewer centroids). A round assigns every vector to the nearest centroid, ties to
    the lesser number, and moves centroids to the floor of their means; empty ones
    stay. Then vectors are assigned once more. Repeated rows are as many vectors;
    other columns are ignored. No rows give none back. A component of 2^27 or more
    after scaling is an error.
    """
    spark = vectors.sparkSession
    slim = vectors.where(F.size("embedding") == dim).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    kept = written(whole_vectors(slim, scale, "vec_id"), "cluster-vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    seeds = kept.orderBy(name.asc_nulls_last(), "v").select("v").limit(k).collect()
    if not seeds:
        return spark.createDataFrame([], RESULT)
    centroids = np.array([r.v for r in seeds], np.int64)
    spreads = kept.agg(*[F.var_pop(F.get("v", F.lit(j))) for j in range(dim)]).first()
    order = np.argsort(-np.array(spreads, np.float64), kind="stable")
    rows = kept.select(F.lit(0).alias("pos"), "v", F.lit(1).cast("long").alias("n"))
    for _ in range(rounds):
        search = PartialSearch(centroids, order)
        centroids = moved(rows, [centroids], lambda pos, m, search=search: search(m))[0]
    search = PartialSearch(centroids, order)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = search(matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    found = written(kept.select("vec_id", "v").mapInArrow(assigned, "vec_id long, cluster int, distance long"), "clusters")
    forget(kept)
    # k rows at most
    sums = {r.cluster: r.d for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    told = spark.createDataFrame([(c, d, digest(centroids[c])) for c, d in sums.items()], "cluster int, cluster_inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(told), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(sums.values())).cast("long").alias("inertia"), "centroid_sha256")
