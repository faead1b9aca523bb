"""Fusion of four bands on their main components, from moments that can be merged.

An image may lie in any number of blocks. The first pass adds up counts, sums and
products of bands (whole numbers, so the order does not matter); its axes follow from
these alone, by Jacobi rotations over many images at a time. The second pass projects
the pixels and finds the least and the greatest value of the image, by which the
third stretches it. No task holds an image.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions.storage import written

BANDS = ("red", "green", "blue", "shade")
PAIRS = [(i, j) for i in range(4) for j in range(i, 4)]
#: Sweeps of rotations; after six the rest is below what doubles can tell.
SWEEPS = 12


def jacobi(m: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of symmetric matrices (n, d, d), largest
    first; equal ones keep the order of their columns."""
    a = m.astype(np.float64).copy()
    n, d, _ = a.shape
    v = np.broadcast_to(np.eye(d), a.shape).copy()
    for _ in range(sweeps):
        for p in range(d):
            for q in range(p + 1, d):
                off = a[:, p, q]
                with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                    theta = (a[:, q, q] - a[:, p, p]) / (2 * off)
                    t = np.where(theta >= 0, 1.0, -1.0) / (np.abs(theta) + np.sqrt(theta * theta + 1))
                t = np.where(off == 0, 0.0, t)
                c = 1 / np.sqrt(t * t + 1)
                s = t * c
                for x in (a.transpose(0, 2, 1), a, v):
                    # columns p and q, of the transpose for the rows
                    low, high = x[:, :, p].copy(), x[:, :, q].copy()
                    x[:, :, p], x[:, :, q] = c[:, None] * low - s[:, None] * high, s[:, None] * low + c[:, None] * high
    values = np.einsum("nii->ni", a)
    order = np.argsort(-values, axis=1, kind="stable")
    return np.take_along_axis(values, order, 1), np.take_along_axis(v, order[:, None, :], 2)


def moments(blocks: DataFrame) -> DataFrame:
    """image, n, s0 .. s3 (sums) and p00 .. p33 (products) of blocks (image, and a list of
    whole numbers for each band). Each block is folded before the shuffle."""

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)

    def product(i: int, j: int) -> Column:
        return total(F.zip_with(BANDS[i], BANDS[j], lambda a, b: a.cast("long") * b))

    sums = [F.sum(total(F.col(b))).alias(f"s{k}") for k, b in enumerate(BANDS)]
    products = [F.sum(product(i, j)).alias(f"p{i}{j}") for i, j in PAIRS]
    return blocks.groupBy("image").agg(F.sum(F.size("red")).cast("long").alias("n"), *sums, *products)


def axes(found: DataFrame) -> DataFrame:
    """image, mean (4) and axes (3 x 4, row by row) from moments: the three main
    components, each pointing to where its largest weight (the first of equals) is
    positive."""

    @F.pandas_udf("array<double>")
    def solved(n: pd.Series, *columns: pd.Series) -> pd.Series:
        s = np.stack([c.to_numpy(np.int64) for c in columns[:4]], axis=1)
        k = n.to_numpy(np.int64)
        m = np.zeros((len(k), 4, 4))
        for (i, j), c in zip(PAIRS, columns[4:], strict=True):
            # whole numbers up to here: n times the products less the product of the sums
            m[:, i, j] = m[:, j, i] = k * c.to_numpy(np.int64) - s[:, i] * s[:, j]
        _, v = jacobi(m)
        main = v.transpose(0, 2, 1)[:, :3]
        top = np.take_along_axis(main, np.abs(main).argmax(2)[:, :, None], 2)
        return pd.Series(list((main * np.where(top < 0, -1, 1)).reshape(len(k), 12)))

    mean = F.array(*[F.col(f"s{k}") / F.col("n") for k in range(4)]).alias("mean")
    return found.where("n > 0").select("image", mean, solved("n", *[f"s{k}" for k in range(4)], *[f"p{i}{j}" for i, j in PAIRS]).alias("axes"))


def pca_blocks(blocks: DataFrame) -> DataFrame:
    """image, block and bands (three lists of whole numbers from 0 to 255) of blocks
    (image, block, and a list for each of red, green, blue, shade): pixels on the three
    main components of their image, stretched over all three from its least to its
    greatest value and cut to whole numbers. An image of one value is 0. Lists of a
    block have one length and no nulls; where images are cut does not matter."""
    told = axes(moments(blocks))

    def projected(k: int) -> Column:
        def at(i: int, x: Column) -> Column:
            return F.col("axes")[4 * k + i] * (x.cast("double") - F.col("mean")[i])

        left = F.zip_with("red", "green", lambda r, g: at(0, r) + at(1, g))
        right = F.zip_with("blue", "shade", lambda b, s: at(2, b) + at(3, s))
        return F.zip_with(left, right, lambda x, y: x + y)

    on = written(blocks.join(told, "image").select("image", "block", F.array(*map(projected, range(3))).alias("bands")), "pca")
    flat = F.flatten("bands")
    reach = on.groupBy("image").agg(F.min(F.array_min(flat)).alias("low"), F.max(F.array_max(flat)).alias("high"))
    wide = F.col("high") - F.col("low")
    stretched = F.transform("bands", lambda b: F.transform(b, lambda x: F.when(wide > 0, ((x - F.col("low")) / wide * 255).cast("int")).otherwise(0)))
    return on.join(reach, "image").select("image", "block", stretched.alias("bands"))
