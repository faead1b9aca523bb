"""Tables, and byte ranges in the shared store, for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.storage import forget, fresh_path, open_store, shared_folder, written

__all__ = ["forget", "fresh_path", "joined", "open_store", "quoted", "row_hash", "shared_folder", "slices", "table", "written", "written_slim"]

#: Rows of whole texts that a task turns into Python objects at a time.
SLICE_ROWS = 250
#: Bytes of an Arrow batch of whole texts.
BATCH_BYTES = "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(*tables: DataFrame) -> DataFrame:
    """Tables of one schema, made by :func:`written`, as one scan."""
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*(t._written_path for t in tables))


def quoted(name: str) -> str:
    """A column's name for F.col, dots and ticks included."""
    return "`" + name.replace("`", "``") + "`"


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row by all its columns; those with maps in them count as JSON."""
    return F.xxhash64(*(F.to_json(F.struct(F.col(quoted(n)).alias("c"))) if "map<" in kind else F.col(quoted(n)) for n, kind in df.dtypes))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows. Memory that Arrow holds in reserve goes
    back at the end, since the worker lives on."""
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        pa.default_memory_pool().release_unused()


def written_slim(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """:func:`written` (or a write to ``path``) of a table that whole texts are read
    for, with Arrow batches of few bytes, so that tasks hold few texts."""
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, BATCH_BYTES)
    try:
        if path is None:
            return written(df, name)
        df.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        out._written_path = path
        return out
    finally:
        spark.conf.set(key, before)
