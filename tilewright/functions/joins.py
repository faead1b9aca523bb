"""Joins that no hot key slows down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts into which the rows of one key are dealt.
WAYS = 64


def spread_join(left: DataFrame, right: DataFrame, key: list[str], by: list[Column | str], how: str = "left", ways: int = WAYS) -> DataFrame:
    """``left`` joined with ``right``, which has at most one row for each key.

    The left rows of a key are dealt to ``ways`` parts by a hash of ``by``, and
    each part that occurs gets a copy of the right row, so that no task holds all
    rows of a key that many rows share. Costs one more shuffle, of the keys alone.
    Null keys match nothing and are dealt out too.
    """
    dealt = left.withColumn("__part", F.pmod(F.xxhash64(*by), F.lit(ways)).cast("int"))
    parts = dealt.select(*key, "__part").distinct()
    return dealt.join(parts.join(right, key), [*key, "__part"], how).drop("__part")
