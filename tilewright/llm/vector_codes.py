"""Compression of vectors to short codes, one codebook for each part of the vector.

Vectors become whole numbers and are cut into equal parts. Equal parts of one
position are folded into one weighted row, so that a vector with many copies is
assigned once a round; Lloyd's rounds run over these rows alone. At the end the
different parts, with their codes and errors, are joined back to the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.joins import spread_join

from .lloyd import digest, matrix, moved, nearest, whole_vectors
from .shared import forget, written

RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def distinct_parts(vectors: DataFrame, parts: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(one row for each part of each vector: the columns of vectors but v, pos, v;
    the different parts of each position: pos, v, n). Copies are counted before
    the shuffle, so a part that many vectors share is no task's burden."""
    cut = [F.struct(F.lit(p).alias("pos"), F.slice("v", p * width + 1, width).alias("v")) for p in range(parts)]
    cells = vectors.withColumn("cell", F.explode(F.array(*cut))).select(*[c for c in vectors.columns if c != "v"], "cell.pos", "cell.v")
    return cells, cells.groupBy("pos", "v").agg(F.count("*").alias("n"))


def compress_vectors(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """One row for each kept row of ``vectors`` (vec_id, embedding, label): vec_id,
    code (index of each part's entry in hex digits, two at least), error (squared
    distance to the entries, summed over the parts), label_error (error summed over
    rows of one label, nulls together) and codebooks_sha256 (of all entries).

    Components x become floor(scale * x). Each position's codebook starts as that
    part of the first ``entries`` rows by vec_id (null ids last, equal ids by
    vector), fewer if there are fewer. Each round assigns every part to the nearest
    entry, ties to the lesser index, and moves the entries to the floor of their
    means; unused ones stay. Then all parts are assigned again.

    Null and empty vectors and those with null or non-finite components go. Equal
    parts need one length, that of the first row by vec_id among those whose length
    the parts divide; vectors of other lengths go too. Repeated rows are as many
    rows, and weigh as much. Labels are told apart by their text; other columns are
    ignored. No rows give none back. A component of 2^27 or more after scaling is an
    error.
    """
    spark = vectors.sparkSession
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("label")
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label, "embedding").where(f"size(embedding) > 0 and size(embedding) % {parts} = 0")
    # the row's number is stored with it, so that it is the same whenever it is read
    kept = written(whole_vectors(slim, scale, "vec_id", "label").withColumn("row", F.monotonically_increasing_id()), "code-vectors")
    first_rows = (F.col("vec_id").asc_nulls_last(), "v")
    first = kept.orderBy(*first_rows).select(F.size("v").alias("dim")).first()
    if first is None:
        return spark.createDataFrame([], RESULT)
    width, fine = first.dim // parts, kept.where(F.size("v") == first.dim)
    seeds = np.array([r.v for r in fine.orderBy(*first_rows).select("v").limit(entries).collect()], np.int64)
    books = [seeds[:, p * width : (p + 1) * width] for p in range(parts)]
    cells, different = distinct_parts(fine, parts, width)
    different = written(different, "code-parts")
    for _ in range(rounds):
        books = moved(different, books, lambda pos, m, now=books: nearest(m, now[pos]))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, m = batch.column(0).to_numpy(), matrix(batch.column(1), width)
            entry, error = np.zeros((2, len(where)), np.int64)
            for pos in np.unique(where).tolist():
                at = where == pos
                entry[at], error[at] = nearest(m[at], books[pos])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(entry, pa.int64()), pa.array(error, pa.int64())], ["pos", "v", "entry", "error"])

    coded = different.select("pos", "v").mapInArrow(assigned, "pos int, v array<long>, entry long, error long")
    joined = spread_join(cells, coded, ["pos", "v"], by=["row"], how="inner")
    digits = max(2, len(f"{entries - 1:x}"))
    code = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("pos") == p, F.col("entry"))))), digits, "0") for p in range(parts)]
    rows = written(joined.groupBy("row", "vec_id", "label").agg(F.concat(*code).alias("code"), F.sum("error").alias("error")), "codes")
    forget(different, kept)
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    out = spread_join(rows, by_label, ["label"], by=["row"])
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(*books)).alias("codebooks_sha256"))
