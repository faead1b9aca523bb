"""A corpus pipeline over ``documents``: each stage takes (spark, docs, sf_dir),
works on all that the stage before it kept, and returns the columns of
``documents`` (the last one returns the packed pieces)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilewright.llm.mixing import mix_sources
from tilewright.llm.ngram_join import one_of_each
from tilewright.llm.packing import pack_documents
from tilewright.llm.shared import BATCH_BYTES, fresh_path, quoted, table
from tilewright.llm.toxicity import drop_toxic


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; the labels of the corpus teach what
    that is. Whole texts pass through Python from here on, in small Arrow batches;
    :func:`run` puts the session's own size back at its end."""
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word n-grams, similarity 0.8 or more), the
    document with the least doc_id stays."""
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rarer sources are repeated, up to one and a half times; no document goes."""
    return mix_sources(docs, max_epochs=1.5).select(*map(quoted, docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048 tokens."""
    return pack_documents(docs)


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

STAGES = [
    ("toxicity", reject_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: Learnt scores and a tokenizer are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), spark.conf.get(BATCH_SETTING)
    try:
        for _, stage in STAGES:
            path = fresh_path(spark, "stage")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    finally:
        spark.conf.set(BATCH_SETTING, before)
    return docs
