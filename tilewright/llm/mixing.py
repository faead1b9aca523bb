"""Mixing sources to target weights by temperature.

The share of a source is its part of all tokens. Raised to an exponent between 0
(all sources alike) and 1 (as they are) and normalised again, the shares become
weights. The exponent is found by bisection, so that the weights have a wanted
entropy, or so that no source is repeated more often than a limit allows. The
weights are then realised as budgets of tokens: a source passes as a whole as
often as its budget holds it, and the rest of the budget is filled from a fresh
permutation of its blocks of documents.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import forget, quoted, row_hash, written

#: Documents of a block, on average; blocks that one task puts in order.
BLOCK_DOCS, RUN_BLOCKS = 256, 4096
STEPS = 60
#: Sources that are weighed at most.
MOST_SOURCES = 10_000
ADDED = ("mix_epoch", "mix_tokens", "mix_exponent", "mix_weight")


def tempered(shares: dict, exponent: float) -> dict:
    raised = {s: p**exponent for s, p in shares.items()}
    total = sum(raised.values())
    return {s: x / total for s, x in raised.items()}


def entropy(weights: dict) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def epochs_of(shares: dict, weights: dict) -> dict:
    """Passes over each source at the smallest budget that holds every source once."""
    ratio = {s: weights[s] / shares[s] for s in shares}
    least = min(ratio.values())
    return {s: r / least for s, r in ratio.items()}


def bisected(shares: dict, target_entropy: float | None = None, max_epochs: float | None = None) -> float:
    """The exponent at which the weights have ``target_entropy``, or the least at
    which no source passes more than ``max_epochs`` times. Targets out of reach
    give the nearest end, 0 or 1."""
    if (target_entropy is None) == (max_epochs is None):
        raise ValueError("give either target_entropy or max_epochs")

    def flat(exponent: float) -> bool:
        w = tempered(shares, exponent)
        return entropy(w) >= target_entropy if max_epochs is None else max(epochs_of(shares, w).values()) > max_epochs

    low, high = 0.0, 1.0
    # entropy and repetition both fall as the exponent rises
    if max_epochs is not None and not flat(low):
        return low
    if target_entropy is not None and not flat(low):
        return low
    if flat(high):
        return high
    for _ in range(STEPS):
        mid = (low + high) / 2
        low, high = (mid, high) if flat(mid) else (low, mid)
    return high


def mix_sources(docs: DataFrame, target_entropy: float | None = None, max_epochs: float | None = 1.5, budget: int | None = None, seed: int = 17) -> DataFrame:
    """Occurrences of the rows of ``docs`` (doc_id, text, source) in the mix: all
    their columns, and mix_epoch (from 0), mix_tokens, mix_exponent, mix_weight.

    Tokens are runs of characters that are not white space, and one more for the
    end of the document. Without ``budget`` (tokens in all) the mix is the
    smallest that holds every source once, so nothing is dropped and the rarer
    sources are repeated. A source's budget is cut to the document that passes it
    last: whole passes have every row once; in the last, blocks of documents
    follow in the order of a hash of (seed, pass, block), and their documents in
    that of a hash of (seed, pass, row), until the budget is filled.

    A null source is one like any other; a null text has one token. Repeated rows
    pass as often as they come. An empty table gives an empty mix. Columns of the
    names that are added must not be there already; any others may be, of any kind. Sources are
    weighed on the driver: at most MOST_SOURCES, more are an error.
    """
    names = docs.columns
    if clash := sorted({c.lower() for c in names} & set(ADDED)):
        raise ValueError(f"columns are there already: {clash}")
    spark = docs.sparkSession
    tokens = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)) + 1
    # the user's columns stay in a struct of their own, so no name can clash
    sized = docs.select(F.struct(*[F.col(quoted(c)) for c in names]).alias("row"), F.col("source").alias("src"), tokens.cast("long").alias("mix_tokens"), row_hash(docs).alias("row_hash"))
    slim = written(sized.select("src", "mix_tokens", "row_hash"), "mix-sizes")
    found = slim.groupBy("src").agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    if not found:
        return docs.select(*[F.col(quoted(c)) for c in names], F.lit(0).alias("mix_epoch"), F.lit(0).cast("long").alias("mix_tokens"), F.lit(1.0).alias("mix_exponent"), F.lit(1.0).alias("mix_weight"))
    totals = {r.src: r.tokens for r in found}
    whole = sum(totals.values())
    shares = {s: t / whole for s, t in totals.items()}
    exponent = bisected(shares, target_entropy, max_epochs)
    weights = tempered(shares, exponent)
    if budget is None:
        passes = {s: min(e, max_epochs) if max_epochs else e for s, e in epochs_of(shares, weights).items()}
    else:
        passes = {s: budget * weights[s] / totals[s] for s in totals}
    # whole passes, the tokens of the last, partial one, and the blocks of the source
    plan = [(r.src, int(passes[r.src]), round(passes[r.src] % 1 * r.tokens), -(-r.n // BLOCK_DOCS), weights[r.src]) for r in found]
    kind = f"mix_source {dict(docs.dtypes)['source']}, full int, rest long, n_blocks long, mix_weight double"
    plan = F.broadcast(spark.createDataFrame(plan, kind))  # MOST_SOURCES rows at most

    def planned(df: DataFrame) -> DataFrame:
        """The block of each row, and its turn in the permutation of its source:
        first by run, then by turn."""
        placed = df.join(plan, F.col("src").eqNullSafe(F.col("mix_source"))).withColumn("place", F.xxhash64("row_hash", F.lit(seed), "full"))
        placed = placed.withColumn("block", F.pmod(F.xxhash64("place", F.lit("block")), F.col("n_blocks"))).withColumn("turn", F.xxhash64("block", F.lit(seed)))
        runs = F.greatest(F.lit(1), F.ceil(F.col("n_blocks") / RUN_BLOCKS))
        return placed.withColumn("run", F.floor((F.shiftright("turn", 33) + F.lit(1 << 30)) * runs / F.lit(1 << 31)))

    # tokens of each block, and of the blocks before it in the permutation: sums over
    # runs of RUN_BLOCKS blocks first, so that no task ranks all blocks of a source
    blocks = written(planned(slim).groupBy("mix_source", "run", "turn", "block").agg(F.sum("mix_tokens").alias("size"), F.first("rest").alias("rest")), "mix-blocks")
    sums = blocks.groupBy("mix_source", "run").agg(F.sum("size").alias("total"))
    earlier = sums.select("mix_source", "run", (F.sum("total").over(Window.partitionBy("mix_source").orderBy("run")) - F.col("total")).alias("earlier"))
    same_run = F.col("b.run").eqNullSafe(F.col("e.run")) & F.col("b.mix_source").eqNullSafe(F.col("e.mix_source"))
    inside = F.sum("size").over(Window.partitionBy("mix_source", "run").orderBy("turn", "block")) - F.col("size")
    before = F.col("inside") + F.col("earlier")
    # the block in which the budget of each source ends
    ends = blocks.withColumn("inside", inside).alias("b").join(earlier.alias("e"), same_run).where((before < F.col("rest")) & (before + F.col("size") >= F.col("rest")))
    ends = written(ends.select(F.col("b.mix_source").alias("end_source"), F.struct("b.run", "turn", "block").alias("end"), before.alias("before")), "mix-ends")

    # blocks before that one pass once more than the others; so what a row does follows
    # from the row and a table of the sources
    rows = planned(sized).join(F.broadcast(ends), F.col("mix_source").eqNullSafe(F.col("end_source")), "left").withColumn("at", F.struct("run", "turn", "block"))
    out = [*[F.col(f"row.{quoted(c)}").alias(c) for c in names], "mix_epoch", "mix_tokens", F.lit(exponent).alias("mix_exponent"), "mix_weight"]
    times = F.col("full") + F.when(F.col("at") < F.col("end"), 1).otherwise(0)
    passed = rows.where(times > 0).withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), times - 1)))
    so_far = Window.partitionBy("mix_source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    cut = rows.where(F.col("at") == F.col("end")).withColumn("mix_epoch", F.col("full"))
    cut = cut.withColumn("so_far", F.sum("mix_tokens").over(so_far) - F.col("mix_tokens")).where("before + so_far < rest")
    forget(slim, blocks)
    return passed.select(*out).unionByName(cut.select(*out))
