"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a session on one machine (a test) that names
    none gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tilewright-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there, so that a
    lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables made by :func:`written` that no later plan reads."""
    for t in tables:
        path = getattr(t, "_written_path", None)
        if path:
            spark = t.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def open_store(uri: str):
    """(file system, path) of a folder in the shared store, for tasks that write
    or read files and byte ranges. Works for every scheme that pyarrow knows."""
    from pyarrow import fs

    if uri.startswith("file:") and "://" not in uri:
        uri = uri.replace("file:", "file://", 1)
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
