"""Pairs of colour and shade patches, and their fusion into new images."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions import tiff
from tilewright.functions.kernels import pca_fusion


def pair_patches(colours: DataFrame, shades: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(patches with both images: file_name, colour, shade; names of colour patches
    without a shade). Both sides: (file_name, content); names must agree exactly."""
    shade = shades.select("file_name", F.col("content").alias("shade"))
    paired = colours.select("file_name", F.col("content").alias("colour")).join(shade, "file_name")
    return paired, colours.select("file_name").join(shades.select("file_name"), "file_name", "left_anti")


def replaced(channel: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A fusion that puts the shade in place of one band."""

    def fuse(colour: np.ndarray, shade: np.ndarray) -> np.ndarray:
        out = colour.copy()
        out[..., channel] = shade.astype(colour.dtype)
        return out

    return fuse


def fuse_files(paired: DataFrame, fuse: Callable[[np.ndarray, np.ndarray], np.ndarray] = replaced(1)) -> DataFrame:
    """(file_name, content) of fused images, as TIFF with the place of the colour
    patch. fuse: replaced(channel), kernels.pca_fusion, or another of that shape."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for colour, shade in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                at, grey = tiff.layout(colour), tiff.read(shade)
                out.append(tiff.write(fuse(tiff.read(colour), grey[..., 0] if grey.ndim == 3 else grey), at.a, at.c, at.e, at.f))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["file_name", "content"])

    return paired.select("file_name", "colour", "shade").mapInArrow(run, "file_name string, content binary")


FILE_FUSIONS = {"replace": replaced(1), "pca": pca_fusion}
