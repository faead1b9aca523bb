"""All registered queries of the detection engine, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.geo import box_around, tile_id, to_map, to_xywh, x_km, y_km
from tilewright.functions.storage import fresh_path, written
from tilewright.operators import datasets, dedup, raster, tiles
from tilewright.plans.fixtures import duck, ranked, view
from tilewright.streaming.tiles import counts_by_key, to_memory

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# --- tiles

NEWEST = """newest as (select layer, coord, href, yr from (select *, row_number() over (partition by layer, coord order by yr desc, seq) rn from (
 select *, regexp_extract(item_id, '(\\d{4}-\\d{4})', 1) coord, case when regexp_extract(item_id, '_(\\d{4})_', 1) = '' then 0 else cast(regexp_extract(item_id, '_(\\d{4})_', 1) as int) end yr
 from stac_items where href is not null) a) b where rn = 1)"""
TILES = f"""{duck("stac_items")}, {NEWEST}, tiles as (select r.coord, cast(substr(r.coord, 1, 4) as int) x_km, cast(substr(r.coord, 6, 4) as int) y_km, r.href rgb_url, d.href dsm_url
 from newest r join newest d on r.coord = d.coord and r.layer = 'rgb' and d.layer = 'dsm')"""
DONE = """done as (select tile_id, n_detections, skip_reason, processed_at from (select *, row_number() over (partition by tile_id order by processed_at desc, seq desc) rn from done_log) x where rn = 1)"""


def newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.newest_per_coord(view(spark, sf_dir, "stac_items"))


def all_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.rgb_dsm_pairs(newest(spark, sf_dir))


@query(f"""with {duck("stac_items")} select seq, regexp_extract(item_id, '(\\d{{4}}-\\d{{4}})', 1) as coord, cast(regexp_extract(item_id, '(\\d{{4}})-\\d{{4}}', 1) as int) as x_km,
 cast(regexp_extract(item_id, '\\d{{4}}-(\\d{{4}})', 1) as int) as y_km, replace(regexp_extract(item_id, '(\\d{{4}}-\\d{{4}})', 1), '-', '_') as tile_id,
 coalesce(try_cast(nullif(regexp_extract(item_id, '_(\\d{{4}})_', 1), '') as int), 0) as yr from stac_items""")
def tile_key_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, c = tiles.keyed_items(view(spark, sf_dir, "stac_items")), F.col("coord")
    return items.select("seq", "coord", x_km(c).alias("x_km"), y_km(c).alias("y_km"), tile_id(c).alias("tile_id"), "yr")


@query(f"with {duck('stac_items')}, {NEWEST} select * from newest")
def newest_per_coord(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(spark, sf_dir)


@query(f"with {duck('stac_items')}, {NEWEST.replace('where href is not null', 'where href is not null and year_of = 1995').replace('from stac_items', 'from (select *, regexp_extract(item_id, ' + chr(39) + '_(\\d{4})_' + chr(39) + ', 1) = ' + chr(39) + '1995' + chr(39) + ' as is_year from stac_items) s').replace('year_of = 1995', 'is_year')} select * from newest")
def newest_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.newest_per_coord(view(spark, sf_dir, "stac_items"), target_year=1995)


@query(f"with {TILES} select * from tiles")
def rgb_dsm_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_tiles(spark, sf_dir)


@query(f"""with {duck("stac_items")}, u as (select seq, layer, href || '_' || regexp_extract(item_id, '(\\d{{4}}-\\d{{4}})', 1) as url, regexp_extract(item_id, '(\\d{{4}}-\\d{{4}})', 1) as coord from stac_items where href is not null),
 l as (select layer, coord, max_by(url, seq) as url from u group by 1, 2) select r.coord, r.url as rgb_url, d.url as dsm_url from l r join l d on r.coord = d.coord and r.layer = 'rgb' and d.layer = 'dsm'""")
def url_list_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = tiles.keyed_items(view(spark, sf_dir, "stac_items")).where("href is not null")
    urls = items.select("layer", F.col("seq").alias("line"), F.concat_ws("_", "href", "coord").alias("url"))
    return tiles.url_list_pairs(urls.where("layer = 'rgb'"), urls.where("layer = 'dsm'"))


@query(f"""with {TILES} select t.coord, r.rgb_url as right_rgb, r.dsm_url as right_dsm, b.rgb_url as bottom_rgb, b.dsm_url as bottom_dsm, c.rgb_url as corner_rgb, c.dsm_url as corner_dsm from tiles t
 left join tiles r on r.x_km = t.x_km + 1 and r.y_km = t.y_km left join tiles b on b.x_km = t.x_km and b.y_km = t.y_km - 1 left join tiles c on c.x_km = t.x_km + 1 and c.y_km = t.y_km - 1""")
def neighbour_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = written(all_tiles(spark, sf_dir), "tiles")
    sides = [F.col(f"{n}.{layer}_url").alias(f"{n}_{layer}") for n, _, _ in tiles.NEIGHBOURS for layer in ("rgb", "dsm")]
    return tiles.attach_neighbours(found, found).select("coord", *sides)


@query(f"with {TILES}, {duck('done_log')} select replace(coord, '-', '_') as tile_id, coord, rgb_url from tiles t where not exists (select 1 from done_log d where d.tile_id = replace(t.coord, '-', '_'))")
def resume_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.remaining(all_tiles(spark, sf_dir), view(spark, sf_dir, "done_log")).select("tile_id", "coord", "rgb_url")


@query(f"with {duck('dsm_grid')} select vec_id, list_max(z) as max_z, case when list_max(z) < 1530 then 'low_elevation' end as skip_reason from dsm_grid")
def low_elevation_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.elevation_outcome(view(spark, sf_dir, "dsm_grid"), 1530).select("vec_id", "max_z", "skip_reason")


@query(f"with {duck('done_log')}, {DONE} select * from done")
def checkpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.latest_by_key(view(spark, sf_dir, "done_log"), "tile_id", ["processed_at", "seq"]).drop("seq")


@query(f"with {duck('done_log')}, {DONE} select case when skip_reason is not null then 'skipped' else 'ok' end as status, count(*) as n from done group by 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.status_counts(checkpoint_upsert(spark, sf_dir).withColumn("error", F.lit(None).cast("string")))


@query(f"with {duck('files')}, f as (select *, sum(size) over (order by mtime, file_id rows unbounded preceding) - size as freed, sum(size) over () as total from files) select file_id, mtime, size from f where total - freed > total // 4")
def lru_evict(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = view(spark, sf_dir, "files")
    total = files.agg(F.sum("size")).first()[0]
    return tiles.evict_oldest(files, total // 4, per_range=20_000)


@query(f"with {duck('files')}, f as (select *, sum(size) over (order by file_id rows unbounded preceding) - size as freed, sum(size) over () as total from files) select file_id, size from f where total - freed > total // 3")
def lru_evict_one_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files were used at one time, so that only their ids order them."""
    files = view(spark, sf_dir, "files").withColumn("mtime", F.lit("2020-01-01").cast("timestamp"))
    total = files.agg(F.sum("size")).first()[0]
    return tiles.evict_oldest(files, total // 3, per_range=20_000).select("file_id", "size")


# --- detections

DEDUP = """with recursive {views}, n as (select tile_id, max(rk) as n from det_raw group by 1), step(tile_id, i, kept) as (
 select tile_id, 0::bigint, []::struct(rk bigint, e double, n double)[] from n
 union all
 select s.tile_id, s.i + 1, case when len(list_filter(s.kept, lambda k: (k.e - d.easting) * (k.e - d.easting) + (k.n - d.northing) * (k.n - d.northing) < 56.25)) > 0 then s.kept
  else list_append(s.kept, {{'rk': d.rk, 'e': d.easting, 'n': d.northing}}) end
 from step s join det_raw d on d.tile_id = s.tile_id and d.rk = s.i + 1
), kept as (select s.tile_id, unnest(s.kept).rk as rk from step s join n on n.tile_id = s.tile_id and n.n = s.i)
""".replace("{views}", duck("det_raw")).replace("{{", "{").replace("}}", "}")


@query(DEDUP + "select d.tile_id, d.rk, d.easting, d.northing, d.confidence from kept join det_raw d on d.tile_id = kept.tile_id and d.rk = kept.rk")
def dedup_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    # what the rule needs and no more goes through the shuffle to Python
    return dedup.dedup_per_tile(view(spark, sf_dir, "det_raw").select("tile_id", "rk", "easting", "northing", "confidence"))


@query(ORACLE_SQL["dedup_kept"])
def dedup_by_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = written(view(spark, sf_dir, "det_raw").select("tile_id", "rk", "easting", "northing", "confidence"), "ranked")
    return dedup.dedup_by_rounds(ranked)


@query(DEDUP + "select r.tile_id, r.n_raw, k.n_kept from (select tile_id, count(*) as n_raw from det_raw group by 1) r join (select tile_id, count(*) as n_kept from kept group by 1) k on k.tile_id = r.tile_id")
def dedup_counts_by_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "det_raw").groupBy("tile_id").agg(F.count("*").alias("n_raw"))
    return raw.join(dedup_kept(spark, sf_dir).groupBy("tile_id").agg(F.count("*").alias("n_kept")), "tile_id")


@query(f"""with {TILES}, {duck("det_raw")}, c as (select tile_id, count(*) as n from det_raw group by 1),
 ids as (select replace(coord, '-', '_') as tile_id from tiles) select ids.tile_id, coalesce(c.n, 0) as n_detections from ids left join c on c.tile_id = ids.tile_id""")
def tile_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = all_tiles(spark, sf_dir).select(tile_id(F.col("coord")).alias("tile_id"))
    return tiles.tile_outcomes(ids, view(spark, sf_dir, "det_raw"))


@query(f"""with {duck("det_raw")} select tile_id, rk, easting - k2::float::double / 2 as xmin, northing - (k2 + 1)::float::double / 2 as ymin, easting + k2::float::double / 2 as xmax, northing + (k2 + 1)::float::double / 2 as ymax from det_raw""")
def detection_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "det_raw")
    return raw.select("tile_id", "rk", *box_around(F.col("easting"), F.col("northing"), F.col("k2").cast("float"), (F.col("k2") + 1).cast("float")))


@query(f"""with {duck("det_raw")} select tile_id, rk, 2500000.0::double + 0.5::double * (((k2 * 64)::double / 640) * 640) as easting, 1200000.0::double + -0.5::double * (((k2 * 32)::double / 640) * 640) as northing,
 (k2 * 0.5::double)::float as bbox_w_m, (k2 * 0.5::double)::float as bbox_h_m from det_raw""")
def pixel_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, one = F.col("k2").cast("double"), F.lit
    columns = to_map(k * 64 / 640, k * 32 / 640, k, k, one(0.5), one(2500000.0), one(-0.5), one(1200000.0))
    return view(spark, sf_dir, "det_raw").select("tile_id", "rk", *columns)


NMS = """with recursive {views}, n as (select tile_id, max(rk) as n from iou_boxes group by 1), step(tile_id, i, kept) as (
 select tile_id, 0::bigint, []::struct(rk bigint, a double, b double, c double, d double)[] from n
 union all
 select s.tile_id, s.i + 1, case when len(list_filter(s.kept, lambda k:
   greatest(0, least(k.c, d.xmax) - greatest(k.a, d.xmin)) * greatest(0, least(k.d, d.ymax) - greatest(k.b, d.ymin)) * 10
   > 3 * ((k.c - k.a) * (k.d - k.b) + (d.xmax - d.xmin) * (d.ymax - d.ymin) - greatest(0, least(k.c, d.xmax) - greatest(k.a, d.xmin)) * greatest(0, least(k.d, d.ymax) - greatest(k.b, d.ymin))))) > 0 then s.kept
  else list_append(s.kept, {'rk': d.rk, 'a': d.xmin, 'b': d.ymin, 'c': d.xmax, 'd': d.ymax}) end
 from step s join iou_boxes d on d.tile_id = s.tile_id and d.rk = s.i + 1
), kept as (select s.tile_id, unnest(s.kept).rk as rk from step s join n on n.tile_id = s.tile_id and n.n = s.i)
select tile_id, rk from kept""".replace("{views}", duck("iou_boxes"))


@query(NMS)
def iou_nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = view(spark, sf_dir, "iou_boxes").select("tile_id", "rk", "xmin", "ymin", "xmax", "ymax")
    return dedup.nms(boxes, 0.3).select("tile_id", "rk")


# --- patches and datasets


@query(f"""with {TILES} select coord, r.range::int as row, c.range::int as col, 0.5::double as a, x_km * 1000.0::double + c.range * 215.0::double as c, -0.5::double as e, (y_km + 1) * 1000.0::double - r.range * 215.0::double as f
 from tiles, range(5) r, range(5) c""")
def patch_grid_25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.patch_grid(all_tiles(spark, sf_dir)).select("coord", "row", "col", "a", "c", "e", "f")


PAIRS = f"{duck('patch_boxes')}, pairs as (select a.idx as i, b.idx as j from patch_boxes a join patch_boxes b on a.idx < b.idx and a.xmax > b.xmin and b.xmax > a.xmin and a.ymax > b.ymin and b.ymax > a.ymin)"
GROUPS = f"""with recursive {PAIRS}, ends as (select i, j from pairs union all select j, i from pairs), reach(idx, o) as (select idx, idx from patch_boxes union select r.idx, b.j from reach r join ends b on b.i = r.o),
 groups as (select idx, min(o) as grp, count(*) as n from reach group by 1)"""


def pairs_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    boxes = view(spark, sf_dir, "patch_boxes")
    return boxes, datasets.overlap_pairs(boxes, 320)


@query(f"with {PAIRS} select * from pairs")
def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_of(spark, sf_dir)[1]


@query(GROUPS + " select * from groups")
def overlap_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.overlap_groups(*pairs_of(spark, sf_dir))


@query(GROUPS + """, g as (select distinct grp from groups where n > 1), r as (select grp, row_number() over (order by md5(grp::varchar || ':42'), grp) - 1 as k, count(*) over () as m from g)
 select o.idx, case when k < trunc(m * 0.1::double) then 'val' when k < 2 * trunc(m * 0.1::double) then 'test' else 'train' end as split from groups o join r on r.grp = o.grp""")
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.group_split(written(overlap_components(spark, sf_dir), "groups"))


@query(f"""with {duck("annotations", "patch_files")}, l as (select file_name, string_agg(printf('%d %.6f %.6f %.6f %.6f', 0, cx, cy, 0.025, 0.025), chr(10) order by seq, cx, cy) as label from annotations group by 1)
 select p.file_name, coalesce(l.label, '') as label from patch_files p left join l on l.file_name = p.file_name""")
def yolo_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = view(spark, sf_dir, "annotations").withColumn("seq", F.struct("seq", "cx", "cy"))
    return datasets.yolo_labels(notes, view(spark, sf_dir, "patch_files"), box_px=16)


MEANS = f"{duck('preds', 'images')}, m as (select i.img, coalesce(sum(cents) / count(cents), 0.0) as mean_conf from images i left join preds p on p.img = i.img group by 1)"


def means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.mean_confidence(view(spark, sf_dir, "images"), view(spark, sf_dir, "preds").select("img", F.col("cents").alias("conf")))


@query(f"with {MEANS} select img, mean_conf from m")
def mean_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return means(spark, sf_dir)


@query(f"with {MEANS} select img, mean_conf from m order by mean_conf desc, img limit 20")
def topn_pseudo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datasets.most_confident(means(spark, sf_dir), 20)


@query(f"with {MEANS} select img from m where img not in (select img from m order by mean_conf desc, img limit 20)")
def pool_after_pseudo(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = means(spark, sf_dir)
    return scored.select("img").join(datasets.most_confident(scored, 20).select("img"), "img", "left_anti")


@query(f"with {duck('iou_boxes')} select tile_id, rk, ((xmin - 2500000) + (xmax - 2500000)) / 2 / 640 as cx, ((ymin - 1100000) + (ymax - 1100000)) / 2 / 640 as cy, ((xmax - 2500000) - (xmin - 2500000)) / 640 as w, ((ymax - 1100000) - (ymin - 1100000)) / 640 as h from iou_boxes")
def normalised_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = (lambda c: F.col(c) - 2500000), (lambda c: F.col(c) - 1100000)
    return view(spark, sf_dir, "iou_boxes").select("tile_id", "rk", *to_xywh(x("xmin"), y("ymin"), x("xmax"), y("ymax"), 640))


def matrix_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ranked(spark, sf_dir)
    p, t = view(spark, sf_dir, "match_preds", raw), view(spark, sf_dir, "match_truths", raw)
    return datasets.confusion(dedup.matched(p, t, 0.5), p, t, background=2)


@query()
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix_of(spark, sf_dir)


@query(f"""with {duck("det_raw")}, m as (select (k1 % 3)::int as pred_cls, (k3 % 3)::int as true_cls, count(*) as n from det_raw group by 1, 2),
 s as (select sum(n) filter (pred_cls = true_cls and pred_cls <> 2) as tp, sum(n) filter (pred_cls <> true_cls and pred_cls <> 2) as fp, sum(n) filter (pred_cls <> true_cls and true_cls <> 2) as fn from m),
 r as (select tp::bigint as tp, fp::bigint as fp, fn::bigint as fn, tp / (tp + fp + 1e-16::double) as p, tp / (tp + fn + 1e-16::double) as r from s)
 select tp, fp, fn, round(p, 9) as precision, round(r, 9) as recall, round(2 * p * r / (p + r + 1e-16), 9) as f1, round(5 * p * r / (4 * p + r + 1e-16), 9) as f2 from r""")
def prf_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "det_raw")
    matrix = raw.groupBy((F.col("k1") % 3).cast("int").alias("pred_cls"), (F.col("k3") % 3).cast("int").alias("true_cls")).agg(F.count("*").alias("n"))
    found = datasets.scores(matrix, background=2)
    return found.select("tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "f2")])


@query("select l_linenumber as iteration, round(sum(cast(round(l_tax * 100) as bigint)) / count(*), 9) as per_batch, round(sum(cast(round(l_tax * 100) as bigint)) / sum(cast(l_quantity as bigint)), 9) as per_item from lineitem group by 1")
def loss_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = view(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("iteration"), F.round(F.col("l_tax") * 100).cast("long").alias("loss"), F.col("l_quantity").cast("long").alias("batch_size"))
    found = datasets.loss_averages(log)
    return found.select("iteration", F.round("per_batch", 9).alias("per_batch"), F.round("per_item", 9).alias("per_item"))


# --- rasters


def duck_cell(dr: int, dc: int) -> str:
    return f"z[greatest(0, least(7, i // 8 + {dr})) * 8 + greatest(0, least(7, i % 8 + {dc})) + 1]::double"


def duck_slope(ahead: tuple, behind: tuple) -> str:
    side = [" + ".join((duck_cell(*s[0]), f"2 * {duck_cell(*s[1])}", duck_cell(*s[2]))) for s in (ahead, behind)]
    return f"((({side[0]}) - ({side[1]})) / 8)"


EAST, WEST = ((-1, 1), (0, 1), (1, 1)), ((-1, -1), (0, -1), (1, -1))
SOUTH, NORTH = ((1, -1), (1, 0), (1, 1)), ((-1, -1), (-1, 0), (-1, 1))


@query(f"""with {duck("dsm_grid")} select vec_id, list_transform(range(64), lambda i: round(255 / sqrt(1 + pow({duck_slope(EAST, WEST)}, 2) + pow({duck_slope(SOUTH, NORTH)}, 2)) * 1000)::bigint) as shade from dsm_grid""")
def hillshade_overhead(spark: SparkSession, sf_dir: str) -> DataFrame:
    shade = raster.overhead_shade(F.col("z"), 8, 8, 1.0)
    return view(spark, sf_dir, "dsm_grid").select("vec_id", F.transform(shade, lambda v: F.round(v * 1000).cast("long")).alias("shade"))


def fused(name: str, sql: str, **settings) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        grids = view(spark, sf_dir, "rgb_grid")
        return grids.select("vec_id", raster.FUSIONS[name](F.col("green"), F.col("shade"), **settings).alias("fused"))

    run.__name__ = f"fuse_{name}"
    query(f"with {duck('rgb_grid')} select vec_id, {sql} as fused from rgb_grid")(run)


fused("replace", "shade")
fused("blend", "list_transform(range(1, 65), lambda i: trunc(green[i] * 0.75::double + shade[i] * 0.25::double)::int)", alpha=0.75)
fused("blackout", "list_transform(range(1, 65), lambda i: case when shade[i] < 90 then 0 else green[i] end)", threshold=90)
fused("multiply", "list_transform(range(1, 65), lambda i: trunc(((green[i]::float / 255::float) * (shade[i]::float / 255::float)) * 255::float)::int)")


@query(f"with {duck('rgb_grid')} select vec_id, [red, shade, blue] as bands from rgb_grid")
def channel_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return view(spark, sf_dir, "rgb_grid").select("vec_id", raster.replace_channel(c("red"), c("green"), c("blue"), c("shade"), 1).alias("bands"))


@query(f"""with {duck("dsm_grid")} select g.vec_id, list_transform(range(100), lambda i: coalesce(case
 when i // 10 < 8 and i % 10 < 8 then g.z[(i // 10) * 8 + i % 10 + 1] when i // 10 < 8 then r.z[(i // 10) * 8 + i % 10 - 8 + 1]
 when i % 10 < 8 then b.z[(i // 10 - 8) * 8 + i % 10 + 1] else c.z[(i // 10 - 8) * 8 + i % 10 - 8 + 1] end, 0)) as mosaic
 from dsm_grid g left join dsm_grid r on r.vec_id = g.vec_id + 1 and g.vec_id % 10 < 9 left join dsm_grid b on b.vec_id = g.vec_id - 10 left join dsm_grid c on c.vec_id = g.vec_id - 9 and g.vec_id % 10 < 9""")
def mosaic_zero_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of grids, ten wide; north is where ids grow by ten."""
    grids = view(spark, sf_dir, "dsm_grid")
    lends = F.explode(F.expr("filter(array(named_struct('side', 'right', 'to', vec_id - 1, 'ok', vec_id % 10 > 0), named_struct('side', 'bottom', 'to', vec_id + 10, 'ok', true), named_struct('side', 'corner', 'to', vec_id + 9, 'ok', vec_id % 10 > 0)), s -> s.ok)")).alias("s")
    sent = grids.select("z", lends).groupBy(F.col("s.to").alias("to")).agg(*[F.first(F.when(F.col("s.side") == n, F.col("z")), ignorenulls=True).alias(n) for n in ("right", "bottom", "corner")])
    near = grids.join(sent, grids["vec_id"] == sent["to"], "left")
    return near.select("vec_id", raster.mosaic_grid(*[F.col(c) for c in ("z", "right", "bottom", "corner")], side=8, strip=2).alias("mosaic"))


# --- streams


@query("select event_type, count(*) as n from events group by 1")
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a stream over the table, once all of it has come."""
    schema = view(spark, sf_dir, "events").select("event_id", "event_type").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet" if _is_folder(spark, sf_dir) else f"{sf_dir}/event[s].parquet")
    at = fresh_path(spark, "stream")
    return to_memory(counts_by_key(stream, "event_type"), "counts_" + at[-32:], at)


def _is_folder(spark: SparkSession, sf_dir: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


from tilewright.plans import files_catalogue, raster_catalogue, store_catalogue, stream_catalogue  # noqa: E402, F401  they register their queries here
