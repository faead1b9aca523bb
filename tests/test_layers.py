"""Layers as GeoPackage files."""

from __future__ import annotations

import json
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from tilewright.sources.layers import Geopackage, Files, LayerWriter, box_blob, read_layer, write_layer

SCHEMA = "name string, score double, xmin double, ymin double, xmax double, ymax double, n int"


def some(spark, n=40):
    rows = [(f"r{k}", None if k == 3 else k / 7, *((None,) * 4 if k == 5 else (float(k), 1.0, k + 2.5, 4.0)), k) for k in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_rows_come_back_with_their_boxes(spark, tmp_path):
    rows, df = some(spark)
    path = f"file://{tmp_path}/layer"
    write_layer(df, path)
    got = sorted(tuple(r) for r in read_layer(spark, path, "name string, n int, score double").collect())
    assert got == sorted((r[0], r[6], r[1], None if r[2] is None else bytearray(box_blob(*r[2:6], 2056))) for r in rows)
    told = json.loads((tmp_path / "layer" / "_manifest.json").read_text())
    assert sum(f["rows"] for f in told["files"]) == 40 and {f["path"] for f in told["files"]} == {p.name for p in (tmp_path / "layer").glob("*.gpkg")}
    # files that any reader of the format opens
    con = sqlite3.connect(tmp_path / "layer" / told["files"][0]["path"])
    assert con.execute("pragma application_id").fetchone()[0] == int.from_bytes(b"GPKG", "big")
    assert con.execute("select table_name, data_type, srs_id, min_x <= max_x from gpkg_contents").fetchall() == [("detections", "features", 2056, 1)]
    assert con.execute("select column_name, geometry_type_name from gpkg_geometry_columns").fetchall() == [("geom", "POLYGON")]
    # writing again replaces the layer; appending adds to it
    write_layer(df.where("n < 10"), path)
    assert read_layer(spark, path, "n int").count() == 10
    df.where("n = 11").write.format("geopackage").mode("append").option("path", path).option("table", "detections").save()
    assert sorted(r.n for r in read_layer(spark, path, "n int").collect()) == [*range(10), 11]


def test_the_blob_is_that_of_the_format():
    blob = box_blob(1.0, 2.0, 3.0, 5.0, 2056)
    assert blob[:2] == b"GP" and struct.unpack("<i", blob[4:8])[0] == 2056 and struct.unpack("<4d", blob[8:40]) == (1.0, 3.0, 2.0, 5.0)
    assert struct.unpack("<BIII", blob[40:53]) == (1, 3, 1, 5) and struct.unpack("<10d", blob[53:]) == (3.0, 2.0, 3.0, 5.0, 1.0, 5.0, 1.0, 2.0, 3.0, 2.0)


def test_a_failed_task_leaves_no_row(spark, tmp_path):
    _, df = some(spark)
    path = f"file://{tmp_path}/layer"
    write_layer(df, path)
    broken = df.withColumn("score", F.when(F.col("n") == 17, F.raise_error(F.lit("broken off"))).otherwise(F.col("score")))
    with pytest.raises(Exception, match="broken off"):
        write_layer(broken, path)
    assert read_layer(spark, path, "n int").count() == 40


def test_abort_deletes_what_was_told(spark, tmp_path):
    _, df = some(spark, 3)
    w = LayerWriter({"path": f"file://{tmp_path}/layer"}, df.schema, True)
    done = w.write(iter(df.collect()))
    assert len(list((tmp_path / "layer").glob("*.gpkg"))) == 1 and isinstance(done, Files)
    w.abort([done, None])
    assert list((tmp_path / "layer").glob("*.gpkg")) == []


def test_empty_layers_and_clashing_names(spark, tmp_path):
    _, df = some(spark)
    path = f"file://{tmp_path}/layer"
    write_layer(df.where("n < 0"), path)
    assert read_layer(spark, path, "n int").collect() == []
    for wrong in (df.drop("xmax"), df.withColumnRenamed("name", "geom")):
        with pytest.raises(Exception, match="layer"):
            write_layer(wrong, path)
    assert Geopackage.name() == "geopackage"
