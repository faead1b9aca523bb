"""Labelled data: overlapping patches, splits without leaks, label files,
pseudo-labels and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.geo import overlaps, to_xywh
from tilewright.functions.storage import written
from tilewright.operators.boxes import self_pairs
from tilewright.operators.dedup import matched, nms_of_any_size
from tilewright.operators.graph import connected_components

#: In the denominators of precision, recall and F scores.
EPSILON = 1e-16


def overlap_pairs(boxes: DataFrame, side: float | None = None) -> DataFrame:
    """(i, j), i < j, of overlapping boxes (idx, xmin, ymin, xmax, ymax) that are at
    most ``side`` wide and high; None: of any size, by levels of cells.

    With a side, each box goes to the cells of that size that it touches, four at most; boxes
    meet in a cell, and a pair counts in the one cell that holds the lower left
    corner of its intersection, so no distinct is needed.
    """

    if side is None:
        return self_pairs(boxes.withColumn("map", F.lit(0)), "map", "idx").select(F.col("first").alias("i"), F.col("second").alias("j"))

    def cells(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) / side), F.floor(F.col(high) / side))

    dealt = boxes.select("*", F.explode(cells("xmin", "xmax")).alias("ci")).select("*", F.explode(cells("ymin", "ymax")).alias("cj"))
    a, b = dealt.alias("a"), dealt.alias("b")
    same = (F.col("a.ci") == F.col("b.ci")) & (F.col("a.cj") == F.col("b.cj")) & (F.col("a.idx") < F.col("b.idx"))
    once = (F.floor(F.greatest("a.xmin", "b.xmin") / side) == F.col("a.ci")) & (F.floor(F.greatest("a.ymin", "b.ymin") / side) == F.col("a.cj"))
    # never broadcast: Spark takes the dealt boxes for as small as the boxes themselves
    return a.join(b.hint("merge"), same & overlaps("a", "b") & once).select(F.col("a.idx").alias("i"), F.col("b.idx").alias("j"))


def overlap_groups(boxes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(idx, grp, n): the overlap group of each box, named by its least idx, and
    its size. A box without a partner is a group of one."""
    groups = connected_components(pairs.select(F.col("i").alias("a"), F.col("j").alias("b")))
    named = boxes.select("idx").join(groups, F.col("idx") == F.col("node"), "left").select("idx", F.coalesce("component", "idx").alias("grp"))
    return named.join(named.groupBy("grp").agg(F.count("*").alias("n")), "grp").select("idx", "grp", "n")


def group_split(groups: DataFrame, val: float = 0.1, test: float = 0.1, seed: int = 42) -> DataFrame:
    """(idx, split): whole groups of two or more go to val, test or train; groups
    of one go nowhere. Counts are int(share * groups); groups come in the order of
    a hash of their name and the seed, ranked in buckets of that hash."""
    names = groups.where("n > 1").select("grp").distinct().withColumn("h", F.md5(F.concat_ws(":", F.col("grp").cast("string"), F.lit(str(seed)))))
    names = written(names.withColumn("bucket", F.substring("h", 1, 3)), "split-groups")
    n = names.count()
    sizes = names.groupBy("bucket").count()  # 4096 rows at most
    before = sizes.select("bucket", (F.sum("count").over(Window.orderBy("bucket")) - F.col("count")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("h", "grp")) - 1
    rank = F.col("inside") + F.col("before")
    n_val, n_test = int(n * val), int(n * test)
    split = F.when(rank < n_val, "val").when(rank < n_val + n_test, "test").otherwise("train")
    chosen = names.withColumn("inside", inside).join(F.broadcast(before), "bucket").select("grp", split.alias("split"))
    return groups.where("n > 1").join(chosen, "grp").select("idx", "split")


def yolo_labels(annotations: DataFrame, images: DataFrame, box_px: int, image_px: int = 640, cls: int = 0) -> DataFrame:
    """(file_name, label): a text of one line for each point annotation (file_name,
    seq, cx, cy in shares of the patch), "" for an image without any."""
    share = F.lit(box_px / image_px)
    line = F.format_string("%d %.6f %.6f %.6f %.6f", F.lit(cls), "cx", "cy", share, share)
    text = annotations.groupBy("file_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))), lambda s: s["line"]), "\n").alias("label"))
    return images.join(text, "file_name", "left").select("file_name", F.coalesce("label", F.lit("")).alias("label"))


def mean_confidence(images: DataFrame, predictions: DataFrame) -> DataFrame:
    """Mean confidence of each image, 0.0 without predictions."""
    mean = predictions.groupBy("img").agg(F.avg("conf").alias("mean_conf"))
    return images.join(mean, "img", "left").withColumn("mean_conf", F.coalesce("mean_conf", F.lit(0.0)))


def most_confident(scored: DataFrame, n: int) -> DataFrame:
    """The n images of the highest mean confidence; ties go to the lesser path."""
    return scored.orderBy(F.desc("mean_conf"), "img").limit(n)


def select_pseudo_labels(images: DataFrame, predictions: DataFrame, n: int, image_px: float = 640) -> tuple[DataFrame, DataFrame]:
    """(pseudo labels of the n most confident images: img, cls, cx, cy, w, h; the
    images that stay in the pool)."""
    top = most_confident(mean_confidence(images, predictions), n)
    labels = predictions.join(top.select("img"), "img", "left_semi").select("img", "cls", *to_xywh(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), image_px))
    return labels, images.join(top.select("img"), "img", "left_anti")


def confusion(matches: DataFrame, predictions: DataFrame, truths: DataFrame, background: int) -> DataFrame:
    """(pred_cls, true_cls, n): matched pairs, and what is left on either side
    against the class ``background``."""
    # matches use each box once at most, so what is left over of a class is its count less its matches:
    # one pass over each table, and no ids go through a join
    c, bg, one = F.col, F.lit(background), F.lit(1)
    sides = F.explode(F.array(*[F.struct(p.alias("pred_cls"), t.alias("true_cls"), n.alias("k")) for p, t, n in ((c("p_cls"), c("t_cls"), one), (bg, c("t_cls"), -one), (c("p_cls"), bg, -one))])).alias("s")
    hit = matches.select(sides).select("s.*")
    missed = truths.select(bg.alias("pred_cls"), c("cls").alias("true_cls"), one.alias("k"))
    false = predictions.select(c("cls").alias("pred_cls"), bg.alias("true_cls"), one.alias("k"))
    return hit.union(missed).union(false).groupBy("pred_cls", "true_cls").agg(F.sum("k").alias("n")).where("n <> 0")


def scores(matrix: DataFrame, background: int) -> DataFrame:
    """tp, fp, fn summed over the classes, and precision, recall, f1, f2."""
    p, t, n = F.col("pred_cls"), F.col("true_cls"), F.col("n")
    sums = matrix.agg(
        F.coalesce(F.sum(F.when((p == t) & (p != background), n)), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when((p != t) & (p != background), n)), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when((p != t) & (t != background), n)), F.lit(0)).alias("fn"),
    )
    precision, recall = F.col("tp") / (F.col("tp") + F.col("fp") + EPSILON), F.col("tp") / (F.col("tp") + F.col("fn") + EPSILON)
    with_rates = sums.withColumn("precision", precision).withColumn("recall", recall)
    return with_rates.withColumn("f1", f_score(1, EPSILON)).withColumn("f2", f_score(2, EPSILON))


def scores_by_class(matrix: DataFrame, background: int) -> DataFrame:
    """(cls, precision, recall, f2) of each class but the background; null for 0/0."""
    p, t, n = F.col("pred_cls"), F.col("true_cls"), F.col("n")
    sides = matrix.select(F.explode(F.array_distinct(F.array(p, t))).alias("cls"), p, t, n).where(F.col("cls") != background)
    part = [F.coalesce(F.sum(F.when(c, n)), F.lit(0)) for c in (p == t, (p == F.col("cls")) & (p != t), (t == F.col("cls")) & (p != t))]
    sums = sides.groupBy("cls").agg(*[c.alias(k) for c, k in zip(part, ("tp", "fp", "fn"), strict=True)])
    rated = sums.select("cls", F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"), F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"))
    return rated.withColumn("f2", f_score(2))


def validate(predictions: DataFrame, truths: DataFrame, background: int, conf: float = 0.25, iou: float = 0.6, suppress: float | None = None) -> DataFrame:
    """One row of tp, fp, fn, precision, recall, f1, f2 for predictions (img, p_id, cls,
    conf, xmin..ymax) against truths (img, t_id, cls, xmin..ymax): least confidence,
    suppression of overlaps above ``suppress`` in order of confidence, matching by
    overlap above ``iou``, the confusion matrix and its scores."""
    found = predictions.where(F.col("conf") >= conf)
    if suppress is not None:
        # the order itself is the rank, so no image is sorted in one task
        order = F.struct((-F.col("conf")).alias("c"), "p_id")
        found = written(nms_of_any_size(found.withColumn("tile_id", F.col("img")).withColumn("rk", order), suppress).drop("tile_id", "rk"), "validated")
    return scores(confusion(matched(found, truths, iou), found, truths, background), background)


def metric_line(columns: list[str]) -> Column:
    """Numbers to four places, with a comma and a space between them."""
    return F.format_string(", ".join(["%.4f"] * len(columns)), *columns)


def f_score(beta: float, epsilon: float = 0.0) -> Column:
    """F score of the columns precision and recall; null for 0/0."""
    p, r = F.col("precision"), F.col("recall")
    return F.try_divide((1 + beta**2) * p * r, beta**2 * p + r + epsilon)


def loss_averages(log: DataFrame) -> DataFrame:
    """Per iteration: average loss by batch and by item from a log of batches
    (iteration, loss, batch_size)."""
    return log.groupBy("iteration").agg((F.sum("loss") / F.count("*")).alias("per_batch"), (F.sum("loss") / F.sum("batch_size")).alias("per_item"))
