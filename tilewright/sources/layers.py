"""Layers as GeoPackage files that executors write, as a data source.

``df.write.format("geopackage")`` puts the rows of each task into files of its own. A
task tells the driver its files when it is done; only then the driver writes the
manifest, which says what belongs to the layer. What a failed or repeated task leaves
is in no manifest, so no reader sees it; if the job fails, known files are deleted.
"""

from __future__ import annotations

import json
import sqlite3
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import BooleanType, ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType

from tilewright.functions.storage import open_store

EDGES = ("xmin", "ymin", "xmax", "ymax")
#: Rows of a file; a file is built in memory.
ROWS_PER_FILE = 50_000
_SQL_TYPES = {StringType: "TEXT", DoubleType: "DOUBLE", FloatType: "FLOAT", LongType: "INTEGER", IntegerType: "MEDIUMINT", ShortType: "SMALLINT", ByteType: "TINYINT", BooleanType: "BOOLEAN"}

# The tables that the format demands, its application id and version.
_TABLES = """
PRAGMA application_id = 0x47504B47;
PRAGMA user_version = 10300;
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT NOT NULL PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME NOT NULL DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now')), min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER REFERENCES gpkg_spatial_ref_sys(srs_id));
CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);
INSERT INTO gpkg_spatial_ref_sys VALUES ('Undefined Cartesian SRS', -1, 'NONE', -1, 'undefined', NULL), ('Undefined geographic SRS', 0, 'NONE', 0, 'undefined', NULL), ('WGS 84', 4326, 'EPSG', 4326, 'GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563]],PRIMEM["Greenwich",0],UNIT["degree",0.0174532925199433]]', NULL), ('CH1903+ / LV95', 2056, 'EPSG', 2056, 'undefined', NULL);
"""


def box_blob(xmin: float, ymin: float, xmax: float, ymax: float, srid: int) -> bytes:
    """A rectangle in the format's binary: header with its envelope, then well-known
    binary, all little-endian, counter-clockwise from the lower right corner."""
    head = struct.pack("<2sBBi4d", b"GP", 0, 0b11, srid, xmin, xmax, ymin, ymax)
    ring = (xmax, ymin, xmax, ymax, xmin, ymax, xmin, ymin, xmax, ymin)
    return head + struct.pack("<BIII10d", 1, 3, 1, 5, *ring)


@dataclass
class Files(WriterCommitMessage):
    """What a task has written: path below the layer, rows, extent."""

    found: list[tuple[str, int, list[float] | None]] = field(default_factory=list)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class LayerWriter(DataSourceWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.table, self.srid = options["path"], options.get("table", "layer"), int(options.get("srid", 2056))
        self.overwrite, self.names = overwrite, [f.name for f in schema.fields]
        if missing := [e for e in EDGES if e not in self.names]:
            raise ValueError(f"a layer needs the edges of its boxes: {missing} are not there")
        self.kept = [f.name for f in schema.fields if f.name not in EDGES]
        self.types = {f.name: _SQL_TYPES.get(type(f.dataType), "TEXT") for f in schema.fields}
        if clash := {"fid", "geom"} & {n.lower() for n in self.kept}:
            raise ValueError(f"a layer has columns fid and geom of its own: rename {sorted(clash)}")

    def write(self, rows: Iterator) -> Files:
        done, held = Files(), []
        for row in rows:
            held.append(row)
            if len(held) >= ROWS_PER_FILE:
                done.found.append(self._file(held))
                held = []
        if held:
            done.found.append(self._file(held))
        return done

    def _file(self, rows: list) -> tuple[str, int, list[float] | None]:
        at = [self.names.index(e) for e in EDGES]
        keep = [self.names.index(n) for n in self.kept]
        boxes = [b if None not in (b := tuple(row[k] for k in at)) else None for row in rows]
        known = [b for b in boxes if b]
        extent = [min(b[0] for b in known), min(b[1] for b in known), max(b[2] for b in known), max(b[3] for b in known)] if known else None
        table = _quoted(self.table)
        con = sqlite3.connect(":memory:")
        con.executescript(_TABLES)
        columns = "".join(f", {_quoted(n)} {self.types[n]}" for n in self.kept)
        con.execute(f"CREATE TABLE {table} (fid INTEGER PRIMARY KEY, geom POLYGON{columns})")
        con.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, min_x, min_y, max_x, max_y, srs_id) VALUES (?, 'features', ?, ?, ?, ?, ?, ?)", (self.table, self.table, *(extent or (None,) * 4), self.srid))
        con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'POLYGON', ?, 0, 0)", (self.table, self.srid))
        plain = [[x if x is None or isinstance(x, (int, float, str, bytes)) else str(x) for x in (row[k] for k in keep)] for row in rows]
        blobs = [b and box_blob(*b, self.srid) for b in boxes]
        con.executemany(f"INSERT INTO {table} VALUES (NULL, ?{', ?' * len(keep)})", [(g, *v) for g, v in zip(blobs, plain, strict=True)])
        con.commit()
        name = f"part-{uuid.uuid4().hex}.gpkg"
        store, place = open_store(self.path)
        store.create_dir(place, recursive=True)
        with store.open_output_stream(f"{place}/{name}", compression=None) as out:
            out.write(con.serialize())
        con.close()
        return name, len(rows), extent

    def commit(self, messages: list[Files | None]) -> None:
        store, place = open_store(self.path)
        store.create_dir(place, recursive=True)
        before = [] if self.overwrite else _manifest(self.path)["files"]
        files = before + [{"path": p, "rows": n, "extent": e} for m in messages if m for p, n, e in m.found]
        part = f"{place}/_manifest-{uuid.uuid4().hex}"
        with store.open_output_stream(part, compression=None) as out:
            out.write(json.dumps({"table": self.table, "srid": self.srid, "files": files}).encode())
        store.move(part, f"{place}/_manifest.json")

    def abort(self, messages: list[Files | None]) -> None:
        store, place = open_store(self.path)
        for path in (p for m in messages if m for p, _, _ in m.found):
            try:
                store.delete_file(f"{place}/{path}")
            except FileNotFoundError:
                pass


def _manifest(path: str) -> dict:
    store, place = open_store(path)
    try:
        with store.open_input_stream(f"{place}/_manifest.json", compression=None) as f:
            return json.loads(f.read())
    except FileNotFoundError:
        return {"table": "layer", "srid": 2056, "files": []}


class LayerReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.names = options["path"], [f.name for f in schema.fields]

    def partitions(self) -> list[InputPartition]:
        told = _manifest(self.path)
        return [InputPartition((told["table"], f["path"])) for f in told["files"]] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        table, name = partition.value
        store, place = open_store(self.path)
        with store.open_input_stream(f"{place}/{name}", compression=None) as f:
            data = f.read()
        con = sqlite3.connect(":memory:")
        con.deserialize(data)
        yield from con.execute(f"SELECT {', '.join(map(_quoted, self.names))} FROM {_quoted(table)}")
        con.close()


class Geopackage(DataSource):
    """df.write.format("geopackage").option("path", ...): rows with the edges of a box
    (xmin, ymin, xmax, ymax) and attributes. Options table, srid. Reading needs a
    schema of attributes and geom binary."""

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def reader(self, schema: StructType) -> LayerReader:
        return LayerReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> LayerWriter:
        return LayerWriter(dict(self.options), schema, overwrite)


def write_layer(boxes: DataFrame, path: str, table: str = "detections", srid: int = 2056) -> None:
    """Replaces the layer at ``path``. Columns that the format has no kind for are stored
    as text; a null edge makes a null geometry."""
    boxes.sparkSession.dataSource.register(Geopackage)
    boxes.write.format("geopackage").mode("overwrite").option("path", path).option("table", table).option("srid", str(srid)).save()


def read_layer(spark: SparkSession, path: str, attributes: str) -> DataFrame:
    """The attributes (a schema text) and the geometry (geom, binary) of a layer."""
    spark.dataSource.register(Geopackage)
    return spark.read.format("geopackage").schema(f"{attributes}, geom binary").option("path", path).load()
