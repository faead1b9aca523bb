"""Registered queries over streams that keep state, with a stop in between."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.storage import fresh_path
from tilewright.plans.catalogue import DONE, NEWEST, TILES, query
from tilewright.plans.fixtures import duck, view
from tilewright.sources.files import write_files
from tilewright.sources.pages import ITEMS, pages, pages_stream, with_pushdown
from tilewright.streaming.state import EVENTS, fold_events, item_events, newest_items, open_tiles, outcome_events, tile_states


def folded(spark: SparkSession, *events: DataFrame) -> DataFrame:
    """The states after all events have come: a half of them in two batches, and after
    a stop the other half, with some of the first half again. As many tasks write
    events as read the tables; a batch takes half of the files that have come."""
    source, root, checkpoint = (fresh_path(spark, n) for n in ("events", "states", "stream"))
    every = reduce(DataFrame.unionByName, events)
    half = F.pmod(F.xxhash64("kind", "seq"), F.lit(8))
    before = 0
    for rows in (half < 4, half >= 3):
        for part in (half % 2 == 0, half % 2 == 1):
            every.where(rows & part).write.mode("append").parquet(source)
        files = len(spark.read.schema(EVENTS).parquet(source).inputFiles())
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", max(1, -(-(files - before) // 2))).parquet(source)
        fold_events(stream, root, checkpoint).awaitTermination()
        before = files
    return tile_states(spark, root)


@query(f"with {duck('stac_items')}, {NEWEST} select * from newest")
def newest_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_items(folded(spark, item_events(view(spark, sf_dir, "stac_items"))))


@query(f"""with {TILES}, {duck("done_log")}, {DONE} select t.coord, t.rgb_url, t.dsm_url, d.n_detections,
 case when d.tile_id is null then 'todo' when d.skip_reason is not null then 'skipped' else 'ok' end as status from tiles t left join done d on d.tile_id = replace(t.coord, '-', '_')""")
def tile_states_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = folded(spark, item_events(view(spark, sf_dir, "stac_items")), outcome_events(view(spark, sf_dir, "done_log")))
    return open_tiles(states)


# --- pages, as a source with filters pushed down and as a stream

EDGES = """x as (select *, try_cast(regexp_extract(item_id, '(\\d{4})-\\d{4}', 1) as double) as west, try_cast(regexp_extract(item_id, '\\d{4}-(\\d{4})', 1) as double) as south from stac_items)"""


def paged(items: DataFrame, root: str) -> None:
    """Items (layer, seq, item_id, href) as pages of a hundred, in order of seq; orders of
    the two layers alternate, so their pages have no gaps. Each has a box."""
    c = F.col
    edge = [F.try_element_at(F.split(F.regexp_extract("item_id", r"(\d{4}-\d{4})", 1), "-"), F.lit(k)).try_cast("double") for k in (1, 2)]
    box = F.array(edge[0], edge[1], edge[0] + 1, edge[1] + 1)
    assets = F.struct(F.struct("href").alias("image"))
    feature = F.struct("seq", c("item_id").alias("id"), F.when(edge[0].isNotNull(), box).alias("bbox"), assets.alias("assets"))
    placed = items.select("layer", F.floor(c("seq") / 200).alias("page"), feature.alias("f"))
    around = [g(c("f.bbox")[k]) for k, g in enumerate((F.min, F.min, F.max, F.max))]
    page = placed.groupBy("layer", "page").agg(F.array_sort(F.collect_list("f")).alias("features"), F.array(*around).alias("bbox"))
    text = page.select(F.concat_ws("/", "layer", F.concat(c("page").cast("string"), F.lit(".json"))).alias("file_path"), F.to_json(F.struct("features", "bbox")).alias("content"))
    write_files(text, root).write.format("noop").mode("overwrite").save()


@query(f"with {duck('stac_items')}, {EDGES} select layer, item_id, href, west, south, west + 1 as east, south + 1 as north from x where layer = 'rgb' and west >= 2490 and west + 1 < 2530 and south <= 1104")
def pages_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of one layer in a box, from pages of both layers and of the whole map."""
    root = fresh_path(spark, "pages")
    paged(view(spark, sf_dir, "stac_items"), root)
    near = pages(spark, root).where("layer = 'rgb' and west >= 2490 and east < 2530 and south <= 1104")
    return with_pushdown(near.select("layer", "item_id", "href", "west", "south", "east", "north"), "near")


@query(f"with {duck('stac_items')} select layer, item_id, href, seq >= (select max(seq) // 400 * 200 from stac_items) as late from stac_items")
def pages_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items of a stream of pages that stops after the first half and goes on with what
    has come since; late are those that another stream gives, which begins at the
    offset of the stop."""
    root, out, checkpoint = (fresh_path(spark, n) for n in ("pages", "items", "stream"))
    items = view(spark, sf_dir, "stac_items")
    half = items.agg(F.max("seq")).first()[0] // 400 * 200

    def take(stream: DataFrame, name: str) -> None:
        stream.writeStream.format("parquet").option("path", f"{out}/{name}").option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start().awaitTermination()

    for part in (items.where(F.col("seq") < half), items.where(F.col("seq") >= half)):
        paged(part, root)
        take(pages_stream(spark, root), "all")
    take(pages_stream(spark, root, since={"rgb": half // 200, "dsm": half // 200}), "late")
    every, late = (spark.read.schema(ITEMS).parquet(f"{out}/{n}") for n in ("all", "late"))
    place = ["layer", "page", "pos"]
    found = every.join(late.select(*place, F.lit(True).alias("late")), place, "left")
    return found.select("layer", "item_id", "href", F.coalesce("late", F.lit(False)).alias("late"))
