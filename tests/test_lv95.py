"""Swiss coordinates against a published control point and formulas of another kind."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tilewright.functions.lv95 import ALPHA, K, RADIUS, to_bessel, to_wgs84


def test_constants_of_the_published_formulas():
    assert abs(RADIUS - 6378815.90365) < 1e-4 and abs(ALPHA - 1.00072913843038) < 1e-13 and abs(K - 0.0030667323772751) < 1e-12


def test_published_points(spark):
    # the centre of the projection, and the Rigi as the national survey publishes it, both on the Bessel ellipsoid
    df = spark.createDataFrame([(2_600_000.0, 1_200_000.0), (2_679_520.05, 1_212_273.44)], "e double, n double")
    phi, lam = to_bessel(F.col("e"), F.col("n"))
    centre, rigi = df.orderBy("e").select(F.degrees(phi).alias("lat"), F.degrees(lam).alias("lon")).collect()
    assert abs(centre.lat - (46 + 57 / 60 + 8.66 / 3600)) < 1e-11 and abs(centre.lon - (7 + 26 / 60 + 22.5 / 3600)) < 1e-11
    assert abs(rigi.lon - (8 + 29 / 60 + 11.11127154 / 3600)) < 1e-10 and abs(rigi.lat - (47 + 3 / 60 + 28.95659233 / 3600)) < 1e-10


def test_a_height_moves_the_place_a_little(spark):
    e, n = F.lit(2_600_000.0), F.lit(1_200_000.0)
    (west, south), (lon, lat) = to_wgs84(e, n), to_wgs84(e, n, F.lit(3000.0))
    r = spark.range(1).select((lon - west).alias("x"), (lat - south).alias("y"), west.alias("lon"), south.alias("lat")).first()
    assert 0 < abs(r.x) + abs(r.y) < 5e-6
    # published to a tenth of a second for the old observatory of Bern
    assert abs(r.lon - 7.438632) < 3e-5 and abs(r.lat - 46.951083) < 3e-5


def test_near_the_approximate_series(spark):
    places = [(2_485_000.0 + 29_000 * k, 1_080_000.0 + 21_000 * j) for k in range(12) for j in range(10)]
    lon, lat = to_wgs84(F.col("e"), F.col("n"))
    for r in spark.createDataFrame(places, "e double, n double").select("e", "n", lon.alias("lon"), lat.alias("lat")).collect():
        y, x = (r.e - 2_600_000) / 1e6, (r.n - 1_200_000) / 1e6
        about = 2.6779094 + 4.728982 * y + 0.791484 * y * x + 0.1306 * y * x * x - 0.0436 * y**3
        north = 16.9023892 + 3.238272 * x - 0.270978 * y * y - 0.002528 * x * x - 0.0447 * y * y * x - 0.0140 * x**3
        assert abs(r.lon - about * 100 / 36) < 5e-5 and abs(r.lat - north * 100 / 36) < 5e-5


def test_the_queries_hold_latitudes_as_their_sql_does(spark):
    from tilewright.plans.files_catalogue import SOUGHT
    from tilewright.run import box_around_coords

    tiles = spark.createDataFrame([(2500, 1100), (2599, 2385)], "x_km int, y_km int")
    # from the SQL in DuckDB over these two tiles; the run itself goes on to the true latitude
    held, free = (box_around_coords(tiles, between=b).first().bbox for b in (SOUGHT, None))
    assert held == "5.7802,46.0350,7.4549,54.9977" and float(free.split(",")[3]) > 57.5 and free.split(",")[1] == held.split(",")[1]
