"""URL rules: a blocked Bloom filter in front of an exact hash join.

A rule is a host and a path; it fits that host and its subdomains where the path
starts with the rule's. A listed URL is a rule for one host and path alone. Both
become one canonical key each, and a URL is judged by the keys that could fit it:
every suffix of its host with every prefix of its path of a length that rules
have. A blocked Bloom filter of the listed keys (one 512-bit block per key) lets
the few possible hits through, and an exact hash join on the keys removes what
is there by chance.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.joins import spread_join

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Bits for each key, bits set for each, and the largest filter that is broadcast.
KEY_BITS, PROBES, MAX_BYTES = 16, 8, 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url):
    """(host, path) columns. Host: after the first "://" up to "/", "?", "#" or the
    end, A to Z lower-cased; path: on up to "?" or "#". Both are empty without "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def bloom_words(keys: DataFrame, n_keys: int, max_bytes: int = MAX_BYTES) -> np.ndarray:
    """The filter as (blocks, 8) words of 64 bits. Bits are set where the keys are
    and joined by a bitwise or; the driver gets the filter, whose size is bounded
    by ``max_bytes`` whatever the number of keys (beyond that, more keys pass)."""
    blocks = max(1, min(max_bytes // 64, -(-n_keys * KEY_BITS // 512)))
    h = keys.select(F.xxhash64("key").alias("h"), F.xxhash64(F.lit("bits"), "key").alias("g"))
    bit = F.explode(F.array(*[F.shiftright("g", 7 * i).bitwiseAND(511).cast("int") for i in range(PROBES)])).alias("bit")
    put = h.select(F.pmod("h", F.lit(blocks)).alias("block"), bit).select("block", F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, bit & 63)").alias("mask"))
    words = np.zeros((blocks, 8), np.uint64)
    for r in put.groupBy("block", "word").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
        words[r.block, r.word] = np.uint64(r.mask & (2**64 - 1))
    return words


def _probe(words):
    """A pandas UDF (key hash, bits hash) -> whether the key may be listed."""
    spread = np.arange(PROBES, dtype=np.int64) * 7

    @F.pandas_udf("boolean")
    def may_be_listed(h: pd.Series, g: pd.Series) -> pd.Series:
        table = words.value
        bits = (g.to_numpy()[:, None] >> spread) & 511
        block = np.mod(h.to_numpy(), len(table))
        found = table[block[:, None], bits >> 6] >> (bits & 63).astype(np.uint64)
        return pd.Series((found & np.uint64(1)).all(axis=1))

    return may_be_listed


def filter_urls(pages: DataFrame, rules: DataFrame | None = None, listed: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and verdict.

    rules (host, path, verdict): the longest that fits wins (host and path taken
    together, then the longer host; of equal ones the first verdict in order of
    the alphabet). listed (url): a URL with the host and path of one of these,
    when no rule fits it, is blocked; any other has the verdict ``default``.
    rule is host and path of the rule, else null. Null URLs and URLs without
    "://" have an empty host and path and fit no rule. Every row of ``pages`` has
    one row in the result, repeated ones and null page_ids too; other columns are
    dropped. A rule with a null or empty host, or a null verdict, fits nothing.
    """
    spark = pages.sparkSession
    rules = rules if rules is not None else rule_table(spark, RULES)
    host, path = url_parts(F.col("url"))
    own = F.concat(F.lit("="), "host", F.lit("\n"), "path")
    rules = rules.where("host <> '' and verdict is not null").select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    keys = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict")).select(F.concat("host", F.lit("\n"), "path").alias("key"), F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"), "verdict")
    if listed is not None:
        exact = listed.where("url is not null").select(*[c.alias(n) for c, n in zip(url_parts(F.col("url")), ("host", "path"), strict=True)])
        keys = keys.union(exact.where("host <> ''").select(own).distinct().select("*", F.lit(None), F.lit(-1), F.lit("block")))
    n_keys, lengths = keys.count(), [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    # no rule has more labels than this, so longer suffixes of a host fit none
    most_labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    words = spark.sparkContext.broadcast(bloom_words(keys, n_keys))

    # each host and path once, however many pages have it
    seen = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row"))
    places = seen.where("host <> ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    ends = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most_labels))) if most_labels else F.array().cast("array<int>")
    suffixes = F.transform(ends, lambda n: F.array_join(F.slice(labels, -n, n), "."))
    starts = F.filter(F.array(*[F.when(F.length("path") >= n, F.substr("path", F.lit(1), F.lit(n))) for n in lengths] or [F.lit(None).cast("string")]), lambda p: p.isNotNull())
    could = F.flatten(F.transform(suffixes, lambda h: F.transform(starts, lambda p: F.concat(h, F.lit("\n"), p))))
    could = F.array_append(could, own) if listed is not None else could
    asked = places.withColumn("key", F.explode(could))
    passed = asked.where(_probe(words)(F.xxhash64("key"), F.xxhash64(F.lit("bits"), "key")))
    best = (
        passed.join(keys, "key")
        .groupBy("host", "path")
        .agg(F.max(F.struct((F.length("rule")).alias("n"), "host_length", "rule", "verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    # rows without a host fit nothing; those of one URL are dealt to many tasks
    fitted = spread_join(seen.where("host <> ''"), best, ["host", "path"], by=["row"])
    bare = seen.where("host = ''").select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    return fitted.select("page_id", "host", "path", "rule", "verdict").unionByName(bare).withColumn("verdict", F.coalesce("verdict", F.lit(default)))
