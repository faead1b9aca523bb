"""Tables with a key at rest: a base in buckets, deltas on top, and compaction.

Rows are filed by a hash of their key into buckets, which are folders, so a look-up of
a few keys reads their buckets alone. New rows are deltas; the last row of a key
counts. Which base and deltas make up the table stands in a small version file, the
one with the highest number. Versions are only ever created, never changed: a
reader keeps what it began with, and of two writers one creates the next version and
the other tries again on top of it. So a compaction that takes long loses nothing of
what is appended meanwhile.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators.tiles import latest_by_key

#: A version file's name has so many digits.
DIGITS = 12


class KeyedTable:
    """The table ``name`` below ``root`` with the columns of ``schema``, of which ``key`` is
    one and ``order`` says which row of a key is the last (ties: the other columns)."""

    def __init__(self, spark: SparkSession, root: str, name: str, schema: str, key: str, order: list[str], buckets: int = 64):
        self.spark, self.place, self.schema, self.key, self.order, self.buckets = spark, f"{root.rstrip('/')}/{name}", schema, key, order, buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.place).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- versions

    def version(self) -> tuple[int, dict]:
        """(number, content) of the last version: base (a folder or None), deltas (folders
        in the order that they came in)."""
        folder = self._path(f"{self.place}/_versions")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        for name in sorted((n for n in names if n.endswith(".json")), reverse=True):
            text = self._read(f"{self.place}/_versions/{name}")
            # a version that is being written, or whose writer died, is not there yet
            if text.endswith("\n"):
                return int(name[:DIGITS]), json.loads(text)
        return 0, {"base": None, "deltas": []}

    def _read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _publish(self, change: Callable[[dict], dict]) -> None:
        """Makes the next version from the last one. If another writer makes it first, the
        change is made to that one's instead."""
        skip = 0
        while True:
            number, now = self.version()
            path = self._path(f"{self.place}/_versions/{number + 1 + skip:0{DIGITS}d}.json")
            try:
                out = self._fs.create(path, False)
            except Py4JJavaError:
                # taken: by a writer that is done, or by one that died on the way
                skip = skip + 1 if self.version()[0] == number else 0
                if skip > 100:
                    raise
                continue
            out.write(bytearray((json.dumps(change(now)) + "\n").encode()))
            out.close()
            return

    # --- writing

    def _store(self, rows: DataFrame, folder: str) -> None:
        filed = rows.withColumn("bucket", self.bucket_of(F.col(self.key)))
        # one task writes a bucket, or a part of it
        filed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.place}/{folder}")

    def bucket_of(self, key):
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def append(self, rows: DataFrame, batch_id: str | int) -> None:
        """Adds rows. A batch that is written again replaces itself, unless a compaction has
        taken it in meanwhile; then its rows are those of the same key and order, and
        change nothing. Rows with a null key are an error of the caller's."""
        names = [c.split()[0] for c in self.schema.split(", ")]
        folder = f"delta-{batch_id}"
        # a key with very many rows is folded before it is shuffled to its bucket
        self._store(latest_by_key(rows.select(*names), self.key, self.order), folder)
        self._publish(lambda v: v if folder in v["deltas"] else {**v, "deltas": [*v["deltas"], folder]})

    def compact(self, between: Callable[[], None] = lambda: None) -> None:
        """Folds base and deltas into a new base. What is appended while it works stays a
        delta. Old folders stay for readers that have begun; see :meth:`vacuum`.
        between: called before the new version is published."""
        _, seen = self.version()
        folder = f"base-{uuid.uuid4().hex}"
        self._store(self._merged(seen), folder)
        between()

        def change(now: dict) -> dict:
            if now["base"] != seen["base"]:
                raise RuntimeError("another compaction was faster")
            return {"base": folder, "deltas": [d for d in now["deltas"] if d not in seen["deltas"]]}

        self._publish(change)

    def vacuum(self) -> None:
        """Deletes folders that the last version does not name. Only when nobody reads an
        older one, and nobody writes."""
        number, now = self.version()
        keep = {now["base"], *now["deltas"], "_versions"}
        for s in self._fs.listStatus(self._path(self.place)):
            if s.getPath().getName() not in keep:
                self._fs.delete(s.getPath(), True)
        for s in self._fs.listStatus(self._path(f"{self.place}/_versions")):
            if int(s.getPath().getName()[:DIGITS]) < number:
                self._fs.delete(s.getPath(), False)

    # --- reading

    def _rows(self, version: dict) -> DataFrame:
        folders = [f for f in (version["base"], *version["deltas"]) if f]
        if not folders:
            return self.spark.createDataFrame([], f"{self.schema}, bucket int")
        # the kind of the partition column is told, so that no folder is read for it
        read = self.spark.read.schema(f"{self.schema}, bucket int")
        parts = [read.option("basePath", f"{self.place}/{f}").parquet(f"{self.place}/{f}") for f in folders]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _merged(self, version: dict, keys: list[str] | None = None) -> DataFrame:
        rows = self._rows(version)
        if keys is not None:
            buckets = [r.b for r in self.spark.createDataFrame([(k,) for k in keys], "k string").select(self.bucket_of(F.col("k")).alias("b")).distinct().collect()]
            rows = rows.where(F.col("bucket").isin(buckets) & F.col(self.key).isin(keys))
        return latest_by_key(rows.drop("bucket"), self.key, self.order)

    def read(self) -> DataFrame:
        """The last row of every key."""
        return self._merged(self.version()[1])

    def lookup(self, keys: list[str]) -> DataFrame:
        """The last row of each of a few keys; only their buckets are read."""
        return self._merged(self.version()[1], keys)
