"""Catalogue items: saved pages, live collections, URL lists."""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tilewright.operators.tiles import first_tif

ITEM = "id string, assets map<string, struct<href: string>>"


def read_saved_pages(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """Saved catalogue pages (JSON with features[]) as seq, layer, item_id, href.
    seq follows the file name and the place in the page: the first seen is least."""
    pages = spark.read.schema("features array<struct<id: string, assets: map<string, struct<href: string>>>>").json(path, multiLine=True)
    items = pages.select(F.input_file_name().alias("file"), F.posexplode("features").alias("pos", "item"))
    return items.select(F.struct("file", "pos").alias("seq"), F.lit(layer).alias("layer"), F.col("item.id").alias("item_id"), first_tif(F.col("item.assets")).alias("href"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """A list of URLs, one a line, as (line, url); blank lines go. The file is one
    text, so lines keep their order."""
    text = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "url"))
    return text.where(F.trim("url") != "")


def open_with_retries(url: str, timeout: float, tries: int = 3, pause: float = 2.0) -> bytes:
    """The bytes at a URL; an empty answer is an error. Waits longer each time."""
    for attempt in range(1, tries + 1):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as answer:
                if data := answer.read():
                    return data
            raise OSError(f"{url} gave nothing")
        except OSError:
            if attempt == tries:
                raise
            time.sleep(pause * attempt)
    raise AssertionError


class StacReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        # each collection and box is a chain of pages; chains run side by side
        boxes = self.options.get("bbox", "").split(";")
        return [InputPartition((c, b)) for c in self.options["collections"].split(",") for b in boxes]

    def read(self, partition) -> Iterator[tuple]:
        collection, box = partition.value
        query = urllib.parse.urlencode({"limit": self.options.get("limit", "100"), **({"bbox": box} if box else {})})
        url, seq = f"{self.options['root'].rstrip('/')}/collections/{collection}/items?{query}", 0
        while url:
            page = json.loads(open_with_retries(url, float(self.options.get("timeout", "30"))))
            for item in page.get("features", []):
                href = next((a.get("href") for a in item.get("assets", {}).values() if (a.get("href") or "").endswith(".tif")), None)
                yield collection, seq, item.get("id"), href
                seq += 1
            url = next((x.get("href") for x in page.get("links", []) if x.get("rel") == "next"), None)


class StacSource(DataSource):
    """spark.dataSource.register(StacSource); spark.read.format("stac")
    .option("root", ...).option("collections", "a,b").option("bbox", "w,s,e,n;...")"""

    @classmethod
    def name(cls) -> str:
        return "stac"

    def schema(self) -> str:
        return "layer string, seq long, item_id string, href string"

    def reader(self, schema) -> StacReader:
        return StacReader(self.options)
