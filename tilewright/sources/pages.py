"""Saved catalogue pages as a data source: a batch read with filters pushed down, and
a stream whose offsets are page numbers.

Pages lie in the shared store as ``{root}/{layer}/{n}.json``, numbered from 0 without
gaps; each has ``features`` and may have a ``bbox`` around them. A stream's offset
says how many pages of each layer have been taken, so it can be replayed from
anywhere. How many there are is found by doubling and halving: a few look-ups, and
no listing that grows with the pages.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from tilewright.functions.storage import fresh_path, open_store

ITEMS = "layer string, page long, pos int, item_id string, href string, west double, south double, east double, north double"
#: Pages that a task reads at least, and tasks that read the pages of one layer at most.
PAGES_PER_TASK, MOST_TASKS = 16, 96
EDGES = ("west", "south", "east", "north")
_TESTS = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}


class Pushed:
    """What a scan was asked to keep: layers, and bounds on the edges of items."""

    def __init__(self, layers: list[str]):
        self.layers = layers
        self.bounds: list[tuple[int, type, float]] = []

    def take(self, f: Filter) -> bool:
        """Takes over a filter, if the pages can answer it whole."""
        name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        if isinstance(f, IsNotNull):
            if name in EDGES:
                self.bounds.append((EDGES.index(name), GreaterThanOrEqual, float("-inf")))
            return name == "layer" or name in EDGES
        if name == "layer" and isinstance(f, (EqualTo, In)):
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.layers = [x for x in self.layers if x in wanted]
            return True
        if name in EDGES and type(f) in _TESTS:
            self.bounds.append((EDGES.index(name), type(f), float(f.value)))
            return True
        return False

    def keeps(self, box: list | None) -> bool:
        """Whether an item of this box is asked for. A bound on a missing box fails."""
        return not self.bounds or box is not None and all(_TESTS[op](box[k], v) for k, op, v in self.bounds)

    def skips_page(self, box: list | None) -> bool:
        """Whether no item inside this box can be asked for: the page goes unread. An
        item's edge lies between the least and the greatest of its page's."""
        if box is None:
            return False
        low, high = (box[0], box[1], box[0], box[1]), (box[2], box[3], box[2], box[3])
        for k, op, v in self.bounds:
            if op is EqualTo and not low[k] <= v <= high[k]:
                return True
            if op in (GreaterThan, GreaterThanOrEqual) and not _TESTS[op](high[k], v):
                return True
            if op in (LessThan, LessThanOrEqual) and not _TESTS[op](low[k], v):
                return True
        return False


def _there(store, path: str) -> bool:
    from pyarrow import fs

    return store.get_file_info(path).type == fs.FileType.File


def count_pages(root: str, layer: str, known: int = 0) -> int:
    """How many pages of a layer there are, if the first ``known`` are there."""
    store, place = open_store(root)
    step = 1
    while _there(store, f"{place}/{layer}/{known + step - 1}.json"):
        step *= 2
    low, high = known + step // 2, known + step - 1
    while low < high:
        middle = (low + high) // 2
        if _there(store, f"{place}/{layer}/{middle}.json"):
            low = middle + 1
        else:
            high = middle
    return low


def _ranges(layer: str, start: int, end: int) -> list[InputPartition]:
    step = max(PAGES_PER_TASK, -(-(end - start) // MOST_TASKS))
    return [InputPartition((layer, k, min(k + step, end))) for k in range(start, end, step)]


def read_range(root: str, layer: str, start: int, end: int, pushed: Pushed) -> Iterator[tuple]:
    store, place = open_store(root)
    for n in range(start, end):
        with store.open_input_stream(f"{place}/{layer}/{n}.json", compression=None) as f:
            page = json.loads(f.read())
        if pushed.skips_page(page.get("bbox")):
            continue
        for pos, item in enumerate(page.get("features") or []):
            box = item.get("bbox")
            if pushed.keeps(box):
                href = next((a.get("href") for a in (item.get("assets") or {}).values() if (a.get("href") or "").endswith(".tif")), None)
                yield layer, n, pos, item.get("id"), href, *(map(float, box) if box else (None,) * 4)


def _layers(options: dict) -> list[str]:
    return [x for x in options["layers"].split(",") if x]


class PagesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.pushed = options["root"], Pushed(_layers(options))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self.pushed.take(f):
                yield f

    def partitions(self) -> list[InputPartition]:
        return [p for layer in self.pushed.layers for p in _ranges(layer, 0, count_pages(self.root, layer))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return read_range(self.root, *partition.value, self.pushed) if partition.value else iter(())


class PagesStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.root, self.layers = options["root"], _layers(options)
        given = json.loads(options.get("from") or "{}")
        self.first = {x: int(given.get(x, 0)) for x in self.layers}
        self.known = dict.fromkeys(self.layers, 0)

    def initialOffset(self) -> dict:
        return self.first

    def latestOffset(self) -> dict:
        self.known = {x: count_pages(self.root, x, n) for x, n in self.known.items()}
        return {x: max(n, self.first[x]) for x, n in self.known.items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [p for x in self.layers for p in _ranges(x, start.get(x, 0), end[x])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return read_range(self.root, *partition.value, Pushed(self.layers))


class SavedPages(DataSource):
    """spark.read.format("saved_pages") or spark.readStream, with the options root,
    layers ("rgb,dsm") and, for a stream, from: the pages of each layer to leave out, as
    JSON, such as {"rgb": 100}."""

    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def schema(self) -> str:
        return ITEMS

    def reader(self, schema) -> PagesReader:
        return PagesReader(dict(self.options))

    def streamReader(self, schema) -> PagesStream:
        return PagesStream(dict(self.options))


def pages(spark: SparkSession, root: str, layers: str = "rgb,dsm") -> DataFrame:
    """The items of saved pages. Filters on the layer and on the edges of items reach
    the source: other layers are not looked at, pages outside are not parsed further
    than their box. A session needs spark.sql.python.filterPushdown.enabled for that."""
    spark.dataSource.register(SavedPages)
    return spark.read.format("saved_pages").option("root", root).option("layers", layers).load()


def pages_stream(spark: SparkSession, root: str, layers: str = "rgb,dsm", since: dict[str, int] | None = None) -> DataFrame:
    spark.dataSource.register(SavedPages)
    return spark.readStream.format("saved_pages").option("root", root).option("layers", layers).option("from", json.dumps(since or {})).load()


def with_pushdown(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder with filters pushed into Python sources; the
    session's setting is as before afterwards."""
    spark, key = df.sparkSession, "spark.sql.python.filterPushdown.enabled"
    before, path = spark.conf.get(key), fresh_path(spark, name)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)
