"""Pseudo-labels in rounds: the most confident images leave the pool, and their
predictions join the labels of the rounds before. Models are the caller's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.storage import forget, written
from tilewright.operators.datasets import mean_confidence, most_confident


def pseudo_label_rounds(pool: DataFrame, predict: Callable[[DataFrame, int], DataFrame], rounds: int, n: int, learn: Callable[[DataFrame, int], None] | None = None) -> tuple[DataFrame, DataFrame]:
    """(labels of all rounds with their round, images left in the pool).

    pool: (img). predict(pool, round) gives (img, conf, ...) of the images that have
    predictions; learn(labels so far, round) may train on them. Each round takes the
    n images of the highest mean confidence, fewer if the pool has fewer; images
    without predictions count as 0 and give no labels. State is a written table for
    each round, so a round does not go back to those before it.
    """
    labels, left = None, written(pool.select("img"), "pool")
    for k in range(rounds):
        found = predict(left, k)
        top = written(most_confident(mean_confidence(left, found.select("img", "conf")), n).select("img"), "pseudo-top")
        new = written(found.join(top, "img", "left_semi").withColumn("round", F.lit(k)), "pseudo-labels")
        labels = new if labels is None else labels.unionByName(new)
        old, left = left, written(left.join(top, "img", "left_anti"), "pool")
        forget(old)
        if learn:
            learn(labels, k)
    return labels, left
