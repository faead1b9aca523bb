"""Views over the general tables that have the shapes of this engine's tables.

Each is one SELECT, written once for Spark SQL; ``duck`` turns it into the
oracle's dialect. Columns that an oracle needs exactly are integers, or doubles
on a lattice where sums and squares are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilewright.functions.storage import written

VIEWS: dict[str, str] = {}

VIEWS["det_raw"] = """
select *, row_number() over (partition by tile_id order by confidence desc, k1, k2, k3, k4, k5) as rk from (
select l_orderkey k1, l_linenumber k2, l_partkey k3, l_suppkey k4, l_extendedprice k5,
 concat(cast(2500 + ((l_partkey div 10) % 100) as string),'_',cast(1100 + ((l_partkey div 10) div 100) as string)) tile_id,
 (2500 + ((l_partkey div 10) % 100))*1000 + 1.5D*((l_orderkey*7919 + l_suppkey*104729 + l_partkey*613 + l_linenumber*31) % 666) easting,
 (1100 + ((l_partkey div 10) div 100))*1000 + 1.5D*((l_orderkey*6271 + l_suppkey*15485862 + l_partkey*1009 + l_linenumber*58) % 666) northing,
 (cast(round(l_extendedprice*100) as bigint) % 9000 + 1000)/10000.0D confidence
from lineitem) t
"""

# the grid of det_raw, which o_custkey div 7 covers, and a field west of it, ten rows high at first, that
# has no detections; there every third tile has no elevation
VIEWS["stac_items"] = """
select seq, layer, concat('item', case when seq % 11 = 0 then '_' else concat('_', cast(yr as string), '_') end,
  cast(case when west then 2499 - (k div 10) % 100 else 2500 + k % 100 end as string), '-', cast(1100 + case when west then k % 10 + 10 * (k div 1000) else k div 100 end as string)) as item_id,
 case when seq % 7 = 0 or (west and layer = 'dsm' and k % 3 = 1) then null else concat('tile_', cast(seq as string), '.tif') end as href
from (select o_orderkey as seq, case when o_orderkey % 2 = 0 then 'rgb' else 'dsm' end as layer, year(o_orderdate) as yr, o_custkey div 7 as k, o_custkey % 7 = 6 as west from orders) t
"""

# every order is a line of the log; its keys are the tiles of even columns only, so that tiles stay undone
VIEWS["done_log"] = """
select concat(cast(2500 + (2 * (o_custkey div 14)) % 100 as string), '_', cast(1100 + (2 * (o_custkey div 14)) div 100 as string)) as tile_id,
 cast(o_orderkey % 40 as int) as n_detections, case when o_orderkey % 5 = 0 then 'low_elevation' end as skip_reason,
 o_orderdate as processed_at, o_orderkey as seq from orders
"""

VIEWS["patch_boxes"] = """
select idx, xmin, ymin, xmin + 320 as xmax, ymin + 320 as ymax from (
select p_partkey as idx,
 (p_partkey div 16)*cast(3000 as double) + (p_partkey % 4)*(case when (p_partkey div 16) % 5 = 0 then cast(320 as double) else cast(215 as double) end) as xmin,
 ((p_partkey % 16) div 4)*(case when (p_partkey div 16) % 5 = 0 then cast(320 as double) else cast(215 as double) end) as ymin
from part) t
"""

VIEWS["preds"] = "select cast(user_id as string) img, event_id seq, round(value*100) as cents from events"

# besides the users, images that have no predictions
VIEWS["images"] = "select distinct cast(user_id as string) img from events union select distinct concat('empty_', cast(user_id div 4 as string)) from events"

VIEWS["files"] = "select event_id as file_id, ts as mtime, cast(1 + round(value*100) as bigint) as size from events"

VIEWS["dsm_grid"] = "select vec_id, transform(embedding, v -> 1500 + cast(round(cast(v as double)*100) as int)) as z from embeddings"

VIEWS["rgb_grid"] = """
select vec_id, transform(z, v -> (v*3) % 256) as red, transform(z, v -> (v*5) % 256) as green, transform(z, v -> (v*7) % 256) as blue, transform(z, v -> (v*11) % 256) as shade
from dsm_grid
"""

VIEWS["annotations"] = """
select concat('patch_', cast(l_partkey as string), '.tif') as file_name, l_orderkey*10000000 + l_suppkey*100 + l_linenumber as seq,
 ((l_orderkey*7919 + l_suppkey*31) % 10000)/10000.0D as cx, ((l_orderkey*104729 + l_linenumber*613) % 10000)/10000.0D as cy
from lineitem
"""

# besides the parts, patches that have no annotations
VIEWS["patch_files"] = "select concat('patch_', cast(p_partkey as string), '.tif') as file_name from part union select concat('empty_', cast(p_partkey div 2 as string), '.tif') from part"

VIEWS["iou_boxes"] = """
select tile_id, rk, k1, k2, k3, k4, k5, easting - 6*k2 as xmin, northing - 6*k2 as ymin, easting + 6*k2 as xmax, northing + 6*k2 as ymax from det_raw
"""

# the centres of det_raw with sides from 6 m to 20 km, and in every tile one box over the whole map
VIEWS["any_boxes"] = """
select tile_id, rk, case when rk % 97 = 3 then 2400000 else easting - half end as xmin, case when rk % 97 = 3 then 1000000 else northing - half end as ymin,
 case when rk % 97 = 3 then 2700000 else easting + half end as xmax, case when rk % 97 = 3 then 1400000 else northing + half end as ymax
from (select *, 3 * k2 * power(cast(2 as double), k1 % 10) as half from det_raw) t
"""

VIEWS["any_preds"] = "select tile_id as img, rk as p_id, cast(rk % 2 as int) as cls, xmin, ymin, xmax, ymax from any_boxes"

# every third truth is another size, so that it is matched with a prediction of another level or with none
VIEWS["any_truths"] = """
select tile_id as img, rk as t_id, cast((rk div 2) % 2 as int) as cls, xmin, ymin, xmin + (xmax - xmin) * far as xmax, ymin + (ymax - ymin) * far as ymax
from (select *, case when rk % 3 = 0 then cast(1.25 as double) when rk % 3 = 1 then cast(1 as double) else cast(2 as double) end as far from any_boxes) t
"""

VIEWS["any_patches"] = """
select idx, case when idx = 1 then -1000000 else xmin end as xmin, case when idx = 1 then -1000000 else ymin end as ymin, case when idx = 1 then 9000000 else xmin + side end as xmax, case when idx = 1 then 9000000 else ymin + side end as ymax
from (select *, 20 * power(cast(2 as double), idx % 9) as side from patch_boxes) t
"""

VIEWS["match_preds"] = """
select tile_id as img, rk as p_id, cast(k1 % 2 as int) as cls, easting - 8 as xmin, northing - 8 as ymin, easting + 8 as xmax, northing + 8 as ymax from det_raw
"""

# every other pair of truths lies 60 m east of its prediction, so that both are left over
VIEWS["match_truths"] = """
select img, t_id, cls, xmin + away as xmin, ymin, xmax + away as xmax, ymax from (
select tile_id as img, rk as t_id, cast((k1 div 2) % 2 as int) as cls, easting - 6.5 as xmin, northing - 8 as ymin, easting + 9.5 as xmax, northing + 8 as ymax, case when rk % 4 >= 2 then 60 else 0 end as away from det_raw) t
"""

VIEWS["user_coords"] = "select c_custkey as pos, concat(cast(2500 + c_custkey % 40 as string), '-', cast(1100 + c_custkey % 3 as string)) as coord from customer"

VIEWS["detections"] = """
select tile_id, concat(tile_id, '_0_0') as patch_id, easting, northing, cast(confidence as float) as confidence, cast(k2 as float) as bbox_w_m, cast(k2 + 1 as float) as bbox_h_m,
 cast(0 as smallint) as class_id, 'rgb' as rgb_source, 'dsm' as dsm_source, k2 from det_raw
"""

VIEWS["shares"] = """
select cast(user_id as string) as img, event_id as seq, cast(event_id % 3 as int) as cls, (event_id*7919 % 10000)/10000.0D as cx, (event_id*613 % 10000)/10000.0D as cy,
 (1 + event_id % 500)/10000.0D as w, (1 + event_id % 700)/10000.0D as h, (event_id*31 % 10000)/10000.0D as conf from events
"""

# besides the grids, colour patches that have no shade
VIEWS["colour_files"] = "select concat('patch_', cast(vec_id as string), '.tif') as file_name, vec_id from embeddings union select concat('bare_', cast(vec_id div 4 as string), '.tif'), vec_id div 4 from embeddings"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages")


def view(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """A view or table. Views may build on each other. given: views that are there already."""
    if given and name in given:
        return given[name]
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    source, used = VIEWS[name], {}
    for t in (*TABLES, *VIEWS):
        if t != name and f"from {t}" in source:
            source = source.replace(f"from {t}", f"from {{{t}}}")
            used[t] = view(spark, sf_dir, t, given)
    return spark.sql(source, **used)


def ranked(spark: SparkSession, sf_dir: str, *more: str) -> dict[str, DataFrame]:
    """det_raw with the columns that most views need and ``more``, ranked once and written, for
    queries that read it more than once."""
    return {"det_raw": written(view(spark, sf_dir, "det_raw").select("tile_id", "rk", "k1", "k2", "easting", "northing", "confidence", *more), "ranked")}


def duck(*names: str) -> str:
    """The views as the WITH entries of a DuckDB query."""
    needed: list[str] = []

    def need(name: str) -> None:
        for t in VIEWS:
            if t != name and f"from {t}" in VIEWS[name]:
                need(t)
        if name not in needed:
            needed.append(name)

    for n in names:
        need(n)
    return ", ".join(f"{n} as ({_dialect(VIEWS[n])})" for n in needed)


def _dialect(sql: str) -> str:
    out = sql.replace(" div ", " // ").replace("as string", "as varchar").replace("1.5D", "1.5::double").replace("10000.0D", "10000.0::double")
    for var in ("v",):
        out = out.replace(f"{var} -> ", f"lambda {var}: ")
    return out.replace("transform(", "list_transform(")
