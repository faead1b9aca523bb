"""Patches, annotations and labels as files: listings, JSON, TIFF and text trees."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import tiff
from tilewright.functions.storage import open_store

ANNOTATIONS = "info map<string, string>, dataset array<struct<file_name: string, coord: array<double>, rocks_annotations: array<struct<relative_within_patch_location: array<double>>>>>"
#: Tasks among which known files are dealt out to be read.
TASKS_PER_CORE = 8
RASTER = "width int, height int, bands int, a double, c double, e double, f double"


def base_name(path: str):
    """Column: what follows the last slash of a path or URL."""
    return F.element_at(F.split(path, "/"), -1)


def list_patches(spark: SparkSession, folder: str, any_case: bool = False) -> DataFrame:
    """(file_name, path, length) of the .tif files in a folder. Only names are read.
    any_case: endings in other letter cases count too."""
    pattern = "*.[tT][iI][fF]" if any_case else "*.tif"
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(base_name("path").alias("file_name"), "path", "length")


def read_patches(spark: SparkSession, folder: str, any_case: bool = False) -> DataFrame:
    """(file_name, content, and the layout of each image). An image that cannot be
    read has nulls for its layout."""
    pattern = "*.[tT][iI][fF]" if any_case else "*.tif"
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select(base_name("path").alias("file_name"), "content")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in batch.column(1).to_pylist():
                try:
                    at = tiff.layout(data)
                    rows.append((at.width, at.height, at.bands, at.a, at.c, at.e, at.f))
                except (ValueError, KeyError):
                    rows.append((None,) * 7)
            kinds = [pa.int32()] * 3 + [pa.float64()] * 4
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 7, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["file_name", "content", *[x.split()[0] for x in RASTER.split(", ")]])

    return files.mapInArrow(described, f"file_name string, content binary, {RASTER}")


def read_annotations(spark: SparkSession, path: str, names: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(patches: file_name, xmin, ymin, xmax, ymax, n; annotations: file_name, seq,
    cx, cy) of annotation files: JSON objects with info and dataset. names: (file_path)
    of the files, if they are known; otherwise the folder is listed."""
    if names is None:
        parsed = spark.read.schema(ANNOTATIONS).json(path, multiLine=True)
    else:
        parsed = read_texts(names, path).select(F.from_json("content", ANNOTATIONS).alias("j")).select("j.*")
    samples = parsed.select(F.explode("dataset").alias("s"))
    notes = F.coalesce("s.rocks_annotations", F.array())
    corner = [F.get("s.coord", F.lit(k)).alias(n) for k, n in enumerate(("xmin", "ymin", "xmax", "ymax"))]
    patches = samples.select("s.file_name", *corner, F.size(notes).alias("n"))
    points = samples.select("s.file_name", F.posexplode(notes).alias("seq", "note"))
    place = F.col("note.relative_within_patch_location")
    return patches, points.select("file_name", "seq", F.get(place, F.lit(0)).alias("cx"), F.get(place, F.lit(1)).alias("cy"))


def write_files(rows: DataFrame, folder: str) -> DataFrame:
    """Writes one file for each row (file_path, content as text or bytes) below a
    folder of the shared store, and returns (file_path, bytes) of all. A task that
    runs again writes the same files again."""
    as_text = dict(rows.dtypes)["content"] == "string"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_store(folder)
        made: set[str] = set()
        for batch in batches:
            sizes = []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = (data or "").encode() if as_text else data or b""
                target = f"{place}/{name}"
                if (parent := os.path.dirname(target)) not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                with store.open_output_stream(target, compression=None) as out:
                    out.write(data)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["file_path", "bytes"])

    return rows.select("file_path", "content").mapInArrow(put, "file_path string, bytes long")


def read_texts(names: DataFrame, folder: str) -> DataFrame:
    """(file_path, content) of the files of ``names`` (file_path) below a folder of the
    shared store. The tasks open them: no folder is listed by the driver, and a task
    has many small files."""

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_store(folder)
        for batch in batches:
            texts = []
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{place}/{name}", compression=None) as f:
                    texts.append(f.read().decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["file_path", "content"])

    tasks = TASKS_PER_CORE * names.sparkSession.sparkContext.defaultParallelism
    return names.select("file_path").repartition(tasks, "file_path").mapInArrow(get, "file_path string, content string")


def label_files(labels: DataFrame, split: str = "split") -> DataFrame:
    """(file_path, content) of label rows (file_name, label, split): a text for each
    image under labels/{split}, a line end after every line, empty without lines."""
    name = F.concat(F.regexp_replace("file_name", r"\.tif$", ""), F.lit(".txt"))
    text = F.when(F.col("label") == "", "").otherwise(F.concat("label", F.lit("\n")))
    return labels.select(F.concat_ws("/", F.lit("labels"), split, name).alias("file_path"), text.alias("content"))


def image_files(images: DataFrame, split: str = "split") -> DataFrame:
    """(file_path, content) of images (file_name, content, split) under images/{split}."""
    return images.select(F.concat_ws("/", F.lit("images"), split, "file_name").alias("file_path"), "content")


def prediction_texts(predictions: DataFrame) -> DataFrame:
    """(file_name, label): lines "class cx cy w h confidence" of predictions (img, seq,
    cls, cx, cy, w, h, conf), six significant digits, for images that have any."""
    line = F.format_string("%d %.6f %.6f %.6f %.6f %.6f", "cls", "cx", "cy", "w", "h", "conf")
    lines = F.array_sort(F.collect_list(F.struct("seq", line.alias("line"))))
    return predictions.groupBy(F.col("img").alias("file_name")).agg(F.array_join(F.transform(lines, lambda s: s["line"]), "\n").alias("label"))


def ensure_cached(url: str, folder: str, fetch: Callable[[str], bytes], tries: int = 2) -> str:
    """The path of a URL's bytes in a shared cache folder; fetched if they are not
    there, and once more if they vanish meanwhile. A reader never sees half a file."""
    from pyarrow import fs

    store, place = open_store(folder)
    path = f"{place}/{os.path.basename(url)}"
    for _ in range(tries):
        if store.get_file_info(path).type == fs.FileType.File:
            return path
        store.create_dir(place, recursive=True)
        part = f"{path}.{os.getpid()}.part"
        with store.open_output_stream(part, compression=None) as out:
            out.write(fetch(url))
        store.move(part, path)
    if store.get_file_info(path).type == fs.FileType.File:
        return path
    raise OSError(f"{url} is not in the cache after {tries} fetches")
