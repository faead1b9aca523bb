"""N-gram Jaccard join: which texts share at least a given part of their word
n-grams.

Method: MinHash banding. Every text becomes the set of its word n-grams; texts
that agree on all rows of a band meet in that band's bucket; the pairs that meet
are verified on their full n-gram sets. Band and row counts follow from the
recall that is asked for.

Shapes that hurt at scale, and what is done about them:

* exact copies are folded into one *class* first (a partial aggregation), so a
  text with a million copies costs one row from there on;
* buckets are not expanded into pairs. Each gives edges from its members to its
  least member, and the connected components of these edges are the *candidate
  clusters*: whatever pair shares a bucket lies in one cluster. A cluster of
  bounded weight is one task's work, and each n-gram set travels once;
* a passage that many texts share chains texts that are not alike into one large
  cluster. Large clusters are taken apart before anything is verified, exactly, by
  prefixes: sets of similarity s share an n-gram among the rarest (1 - s) of each,
  and a frequent passage is not among these. How frequent an n-gram is, comes from
  a table of FREQUENCIES counters, whatever the corpus;
* what is still large then (many different texts that are alike) is verified in
  blocks of bounded weight, each pair of blocks being one task's work, as one
  product of 0/1 matrices. Blocks give counts and a spanning forest, never pairs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.joins import spread_join
from tilewright.operators.graph import connected_components

from .shared import forget, quoted, row_hash, slices, written, written_slim

WORD = re.compile(r"\w+")
#: Weight (n-grams, plus a charge for each text) of a block that one task holds.
BLOCK_WEIGHT = 400_000
TEXT_WEIGHT = 400
#: Counters of n-grams by which large clusters are taken apart.
FREQUENCIES = 1 << 18


def bands_for(similarity: float, recall: float, rows: int = 5) -> int:
    """Least number of bands of ``rows`` rows at which a pair of just this
    similarity meets with the probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse; those of the last
    length are kept."""
    base = 0x9E3779B97F4A7C15
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(parts: list[str], n: int) -> np.ndarray:
    """The distinct word n-grams as sorted 64-bit fingerprints. A text of fewer
    words than n counts as one n-gram; one without words has none."""
    if not parts:
        return np.empty(0, np.uint64)
    raw = np.frombuffer((" ".join(parts) + " ").encode(), np.uint8)
    ends = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = min(n, len(ends))
    up, down = _powers(1 << max(12, len(raw).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], dtype=np.uint64)))
    first, last = starts[: len(ends) - n + 1], ends[n - 1 :]
    return np.unique(_mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)))


def band_keys(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of the MinHash signature."""
    rng = np.random.default_rng(20_240_229)
    a = rng.integers(0, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
    x = (grams >> np.uint64(32)).astype(np.uint32)
    low = np.full(bands * rows, 2**32 - 1, np.uint32)
    for k in range(0, len(x), 2048):
        np.minimum(low, (a[:, None] * x[None, k : k + 2048] + b[:, None]).min(axis=1), out=low)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in low.reshape(bands, rows).T:
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch], n: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        digest, size, keys = [], [], []
        for text in batch.column(1).to_pylist():
            parts = words(text)
            grams = ngrams(parts, n)
            digest.append(_digest(parts))
            size.append(len(grams))
            keys.append(band_keys(grams, bands, rows) if parts else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digest, pa.binary()), pa.array(size, pa.int32()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "digest", "n_grams", "bands"])


def _digest(parts: list[str]) -> bytes | None:
    return blake2b(" ".join(parts).encode(), digest_size=16).digest() if parts else None


def _grams(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [words(t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([_digest(t) for t in texts], pa.binary()), pa.array([ngrams(t, n).view(np.int64) for t in texts], pa.list_(pa.int64()))], ["digest", "grams"])


def _prefixes(batches: Iterator[pa.RecordBatch], frequency, similarity: float) -> Iterator[pa.RecordBatch]:
    """Of each set the rarest n-grams, so many that sets of this similarity have
    one of them in common."""
    counts, s = frequency.value, round(similarity * 1_000_000)
    for batch in slices(batches):
        found = []
        for grams in batch.column(2).to_pylist():
            grams = np.array(grams, np.int64)
            keep = len(grams) + s * len(grams) // -1_000_000 + 1
            found.append(grams[np.lexsort((grams, counts[grams % FREQUENCIES]))[:keep]])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], ["cluster", "key", "prefix"])


def _taken_apart(large: DataFrame, similarity: float) -> DataFrame:
    """(key, cluster): members of large clusters (cluster, key, grams) in smaller
    clusters, which still hold every pair of this similarity. Members that can
    have no such partner are left out."""
    sc = large.sparkSession.sparkContext
    counts = np.zeros(FREQUENCIES, np.int64)
    # one row for each counter at most
    for r in large.select(F.explode("grams").alias("g")).groupBy(F.pmod("g", F.lit(FREQUENCIES)).alias("at")).count().toLocalIterator():
        counts[r["at"]] = r["count"]
    frequency = sc.broadcast(counts)
    rare = large.select("cluster", "key", "grams").mapInArrow(lambda it: _prefixes(it, frequency, similarity), "cluster long, key long, prefix array<long>")
    met = written(rare.select("cluster", "key", F.explode("prefix").alias("gram")), "ngram-prefixes")
    frequency.destroy()
    heads = met.groupBy("cluster", "gram").agg(F.min("key").alias("head"), F.count("*").alias("met")).where("met > 1").drop("met")
    apart = connected_components(spread_join(met, heads, ["cluster", "gram"], by=["key"], how="inner").where("key <> head").select(F.col("key").alias("a"), F.col("head").alias("b")))
    forget(met)
    return apart.toDF("key", "cluster")


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members (cluster, key, n_grams, ...) with the blocks of their cluster."""
    weight = members.groupBy("cluster").agg(F.sum(F.col("n_grams") + TEXT_WEIGHT).alias("weight")).withColumn("n_blocks", F.ceil(F.col("weight") / BLOCK_WEIGHT).cast("int"))
    return spread_join(members, weight, ["cluster"], by=["key"], how="inner")


def _verify_bin(pdf: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """The clusters of one bin, or one pair of blocks of a large cluster."""
    order = np.argsort(pdf["cluster"].to_numpy(), kind="stable")
    pdf = pdf.iloc[order].reset_index(drop=True)
    cuts = np.flatnonzero(np.diff(pdf["cluster"].to_numpy(), prepend=-1, append=-1))
    return pd.concat([_verify(pdf.iloc[a:b], similarity) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])


def _verify(pdf: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """All pairs of one pair of blocks: for each text its links to other texts and
    to their copies, and edges that hold linked texts together.

    A block against itself counts both ends of a pair; block i against j > i too.
    """
    sets = list(pdf["grams"])
    ids, copies = pdf["key"].to_numpy(), pdf["n_copies"].to_numpy()
    side, sizes = pdf["side"].to_numpy(), np.array([len(s) for s in sets])
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    shared = _common(sets, left, right)
    # n(a and b) >= s * n(a or b), in whole numbers of 1/10^6
    s = round(similarity * 1_000_000)
    linked = shared * (1_000_000 + s) >= s * (sizes[left][:, None] + sizes[right][None, :])
    linked &= ids[left][:, None] != ids[right][None, :]
    n, nd = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    n[left] += linked.sum(1)
    nd[left] += linked @ copies[right]
    if not (side == 2).any():
        n[right] += linked.sum(0)
        nd[right] += copies[left] @ linked
    return pd.DataFrame({"key": ids, "peer": _forest(linked, left, right, ids), "whole": pdf["n_blocks"].to_numpy() == 1, "n_links": n, "n_docs": nd})


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections, through the n-grams that several sets hold."""
    gram, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keep = count[inverse] > 1
    gram, owner = inverse[keep], owner[keep]
    out = np.zeros((len(left), len(right)), np.float32)
    if len(gram) == 0:
        return out.astype(np.int64)
    gram = np.unique(gram, return_inverse=True)[1]
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], owner[order]
    width = min(int(gram[-1]) + 1, max(1, 4_000_000 // len(sets)))
    cuts = np.searchsorted(gram, np.arange(0, gram[-1] + 1 + width, width))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        tile = np.zeros((len(sets), width), np.float32)
        tile[owner[a:b], gram[a:b] - k * width] = 1
        out += tile[left] @ tile[right].T
    return out.astype(np.int64)


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each text one that it hangs together with: the least id that it
    reaches inside these blocks."""
    reach = ids.copy()
    while True:
        before = reach.copy()
        big = np.iinfo(np.int64).max
        np.minimum.at(reach, left, np.where(linked, reach[right][None, :], big).min(1, initial=big))
        np.minimum.at(reach, right, np.where(linked, reach[left][:, None], big).min(0, initial=big))
        if (before == reach).all():
            return reach


def ngram_jaccard_join(docs: DataFrame, n: int = 5, similarity: float = 0.8, recall: float = 0.99999, rows: int = 5) -> DataFrame:
    """Links between the texts of ``docs`` (doc_id, text).

    Returns one row for each row of ``docs``:
    doc_id; class_id, the least doc_id of all that hang together by links and
    copies; text_class, the least doc_id with the same words; n_copies, the
    documents with the same words, this one included; n_links, the other texts
    (classes) of at least this similarity; n_doc_links, the other documents.

    Texts are compared by their lower-case words (runs of word characters).
    Null, empty and wordless texts have no n-grams: each is a class of its own,
    with its own doc_id and no links. A text of fewer than n words is one
    n-gram. Each row is compared, so a repeated doc_id gives several rows: equal
    ones are copies, others texts like any. A row with a null doc_id is compared
    too; if its whole class has none, class_id is null. Other columns are ignored.
    """
    bands = bands_for(similarity, recall, rows)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written_slim(
        slim.mapInArrow(lambda it: _signatures(it, n, bands, rows), "doc_id long, digest binary, n_grams int, bands array<long>").withColumn("row", F.monotonically_increasing_id()),
        "ngram-signatures",
    )

    # a class is named by the first of its rows; bands are a function of the digest, so any copy's will do
    classes = written(
        signed.where("digest is not null").groupBy("digest").agg(F.min("row").alias("key"), F.min("doc_id").alias("text_class"), F.count("*").alias("n_copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands")),
        "ngram-classes",
    )

    met = classes.select("key", F.posexplode("bands").alias("band", "hash"))
    heads = met.groupBy("band", "hash").agg(F.min("key").alias("head"), F.count("*").alias("met")).where("met > 1").select("band", "hash", "head")
    edges = spread_join(met, heads, ["band", "hash"], by=["key"], how="inner").where("key <> head").select(F.col("key").alias("a"), F.col("head").alias("b"))
    clusters = connected_components(edges).toDF("key", "cluster")

    # n-gram sets of the members alone, from their whole texts
    member = written(clusters.join(classes.drop("bands"), "key"), "ngram-members")
    ids = member.select(F.col("text_class").alias("doc_id")).distinct().alias("m")
    sets = slim.join(ids, slim["doc_id"].eqNullSafe(F.col("m.doc_id")), "left_semi").select("text").mapInArrow(lambda it: _grams(it, n), "digest binary, grams array<long>")
    held = written_slim(_in_blocks(member).join(sets.dropDuplicates(["digest"]), "digest").select("cluster", "key", "n_copies", "n_grams", "weight", "n_blocks", "grams"), "ngram-sets")

    # small clusters share bins of bounded weight; large ones are taken apart and then cut into blocks
    small, large = held.where("n_blocks = 1"), held.where("n_blocks > 1")
    if not large.isEmpty():
        apart = _in_blocks(large.drop("cluster", "weight", "n_blocks", "grams").join(_taken_apart(large, similarity), "key"))
        apart = written(apart.join(large.select("key", "grams"), "key"), "ngram-apart")
        small, large = small.unionByName(apart.where("n_blocks = 1")), apart.where("n_blocks > 1")
    else:
        apart = None
    light = small.agg(F.sum(F.col("n_grams") + TEXT_WEIGHT)).first()[0] or 0
    n_bins = max(1, math.ceil(light / BLOCK_WEIGHT))
    columns = ["cluster", "n_blocks", "key", "n_copies", "grams"]
    binned = small.select(*columns, F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(2).alias("side"), F.pmod(F.xxhash64("cluster"), F.lit(n_bins)).alias("bin"))
    block = large.withColumn("block", F.pmod(F.xxhash64("key"), F.col("n_blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    blocks = block.select(*columns, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), side.alias("side"), (-1 - F.col("cluster")).alias("bin"))
    found = written(binned.unionByName(blocks).groupBy("bin", "i", "j").applyInPandas(lambda pdf: _verify_bin(pdf, similarity), "key long, peer long, whole boolean, n_links long, n_docs long"), "ngram-links")

    across = connected_components(found.where("not whole").select(F.col("key").alias("a"), F.col("peer").alias("b"))).toDF("key", "far")
    links = found.groupBy("key").agg(F.sum("n_links").alias("n_links"), F.sum("n_docs").alias("n_docs"), F.min(F.when(F.col("whole"), F.col("peer"))).alias("near")).join(across, "key", "left")
    named = written(classes.drop("bands", "n_grams").join(links, "key", "left").withColumn("group", F.coalesce("far", "near", "key")), "ngram-named")
    least = named.groupBy("group").agg(F.min("text_class").alias("class_id"))
    by_class = spread_join(named, least, ["group"], by=["key"], how="inner").select("digest", "text_class", "class_id", "n_copies", "n_links", "n_docs")
    bare = signed.where("digest is null").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("text_class"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_doc_links"))
    wordy = spread_join(signed.where("digest is not null").select("doc_id", "digest", "row"), by_class, ["digest"], by=["row"], how="inner")
    result = written(
        wordy.select(
            "doc_id",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("text_class", "doc_id").alias("text_class"),
            "n_copies",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            (F.coalesce("n_docs", F.lit(0)) + F.col("n_copies") - 1).cast("long").alias("n_doc_links"),
        ).unionByName(bare),
        "ngram-join",
    )
    forget(signed, classes, member, held, found, named, *([apart] if apart else []))
    return result


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one document of each group that :func:`ngram_jaccard_join`
    finds: the one with the least doc_id, in all its columns. Repeated rows of
    that document are folded too, before they are shuffled, so that a row that
    comes very often is no one task's work; of rows with one doc_id and other
    columns that differ, the one with the least hash of all columns stays. Rows
    with a null doc_id stay, all of them. Other columns may have any name and kind.
    """
    found = ngram_jaccard_join(docs, **settings).where("doc_id = class_id").select("doc_id").distinct()
    row = F.struct(*(F.col(quoted(c)) for c in docs.columns))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row.alias("row"), row_hash(docs).alias("tie"))
    one = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min_by("row", "tie").alias("row"))
    kept = one.join(found, "doc_id", "left_semi").select("row").unionByName(rows.where("doc_id is null").select("row"))
    return kept.select(*(F.col(f"row.{quoted(c)}").alias(c) for c in docs.columns))
