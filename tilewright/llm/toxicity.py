"""Toxicity scores from the nearest labelled examples.

A text is a TF-IDF vector; its nearest labelled examples by exact cosine vote,
weighted by their nearness. The examples lie in an inverted index whose postings
come in blocks of examples with the largest weight of each term in each block: a
text visits blocks in order of the most that they can reach and stops when that
is no more than its k-th best.

The terms are words and the beginnings of words. Of those of the examples, the
ones count whose presence goes with the label (by a likelihood-ratio test and the
ratio of their rates), so a long harmless text does not hide a few telling words.
One more term says how many different telling words a text has, so a text with
one by chance is nearest to others with one. Document frequencies are counted
over all documents.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, slices, written, written_slim

WORD = re.compile(r"\w+")
#: Letters of the beginnings of words that are terms of their own.
STEMS = range(3, 9)
#: The bounded sample that is learnt from: labelled documents of each class.
EXAMPLES = 2000
#: Terms with a likelihood ratio of at least LEAST_RATIO, and in one class so many
#: times as frequent as in the other. All such terms count; the examples bound them.
LEAST_RATIO, LEAST_RISK = 30.0, 10.0
#: Numbers of different telling words that have a term each, the last one for more
#: too; the count of that term.
MOST_WORDS, WORDS_COUNT = 6, 2
NEIGHBOURS = 15
#: Weight of the base rate beside the votes.
PRIOR_WEIGHT = 0.05
BLOCK = 64
#: Scores from which a text counts as toxic.
TOXIC = 0.5
#: Texts that one task scores.
ROWS_PER_TASK = 5000


def terms(words: Counter) -> set[str]:
    """The words, and the beginnings of longer ones (as "abc*")."""
    return {*words, *(w[:n] + "*" for w in words for n in STEMS if len(w) >= n)}


def words_of(text: str | None) -> Counter:
    return Counter(WORD.findall(text.lower())) if text else Counter()


class TermFinder:
    """The telling terms of a text, with their counts, as places in ``names``."""

    def __init__(self, names: list[str]):
        self.names = [*names, *(f"#{k}" for k in range(1, MOST_WORDS + 1))]
        self.place = {t: k for k, t in enumerate(self.names)}
        # most words differ from all terms in their first letters
        self.heads = {t.removesuffix("*")[: STEMS[0]] for t in names}

    def __call__(self, words: Counter) -> dict[int, int]:
        found: dict[int, int] = {}
        telling = 0
        for w, n in words.items():
            if w[: STEMS[0]] not in self.heads:
                continue
            at = [self.place.get(w), *(self.place.get(w[:k] + "*") for k in STEMS if len(w) >= k)]
            at = [k for k in at if k is not None]
            telling += bool(at)
            for k in at:
                found[k] = found.get(k, 0) + n
        if telling:
            found[self.place[f"#{min(telling, MOST_WORDS)}"]] = WORDS_COUNT
        return dict(sorted(found.items()))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, n): how many texts of a batch have the term."""
    for batch in slices(batches):
        found = [Counter(), Counter()]
        for toxic, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            found[toxic].update(terms(words_of(text)))
        for toxic, by in enumerate(found):
            yield pa.RecordBatch.from_arrays([pa.array(list(by), pa.string()), pa.array([toxic] * len(by), pa.int32()), pa.array(list(by.values()), pa.int64())], ["term", "toxic", "n"])


def telling_terms(examples: DataFrame, n0: int, n1: int) -> list[str]:
    """The terms of the examples (toxic, text) whose presence goes with the label,
    by the ratio G squared. n0, n1: examples of each class."""
    seen = examples.select("toxic", "text").mapInArrow(_terms, "term string, toxic int, n long")
    count = [F.coalesce(F.sum(F.when(F.col("toxic") == y, F.col("n"))), F.lit(0)).cast("double") for y in (0, 1)]
    by = seen.groupBy("term").agg(count[1].alias("a"), count[0].alias("b"))
    a, b, p = F.col("a"), F.col("b"), (F.col("a") + F.col("b")) / max(1, n0 + n1)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (part(a, n1 * p) + part(b, n0 * p) + part(n1 - a, n1 * (1 - p)) + part(n0 - b, n0 * (1 - p)))
    risk = (a + 0.5) / (n1 + 1) / ((b + 0.5) / (n0 + 1))
    fit = by.select("term", F.round(ratio, 6).alias("ratio"), F.greatest(risk, 1 / risk).alias("risk")).where((F.col("ratio") >= LEAST_RATIO) & (F.col("risk") >= LEAST_RISK))
    return sorted(r.term for r in fit.select("term").collect())


class BlockMaxIndex:
    """Unit TF-IDF vectors of the examples, as postings in blocks."""

    def __init__(self, labelled: list[dict[int, int]], toxic: np.ndarray, ids: list, idf: np.ndarray, weights: tuple[float, float]):
        self.idf = idf
        self.toxic, self.ids = toxic.astype(float), ids
        self.votes = np.where(toxic == 1, weights[1], weights[0])
        rows = [self.vector(list(c.items())) for c in labelled]
        self.blank = np.array([len(r[0]) == 0 for r in rows])
        blocks = max(1, -(-len(rows) // BLOCK))
        lists: list[dict[int, list[tuple[int, float]]]] = [{} for _ in idf]
        self.top = np.zeros((len(idf), blocks))
        for e, (where, weight) in enumerate(rows):
            for t, w in zip(where.tolist(), weight.tolist(), strict=True):
                lists[t].setdefault(e // BLOCK, []).append((e % BLOCK, w))
                self.top[t, e // BLOCK] = max(self.top[t, e // BLOCK], w)
        self.postings = [{b: (np.array([x for x, _ in p]), np.array([w for _, w in p])) for b, p in by.items()} for by in lists]
        total = self.votes.sum()
        self.base = float((self.votes * self.toxic).sum() / total) if total else 0.0
        blank = (self.votes * self.blank).sum()
        self.blank_rate = float(((self.votes * self.toxic * self.blank).sum() + PRIOR_WEIGHT * self.base) / (blank + PRIOR_WEIGHT))

    def vector(self, counts: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        where = np.array([t for t, _ in counts], np.int64)
        weight = np.array([1 + np.log(n) for _, n in counts]) * self.idf[where] if counts else np.empty(0)
        length = np.sqrt((weight**2).sum())
        return where, weight / length if length else weight

    def nearest(self, where: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """The k examples of the largest positive cosine, best first; ties go to
        the lesser place."""
        reach = weight @ self.top[where]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-reach, kind="stable"):
            if reach[b] <= 0 or len(best) == k and reach[b] < best[0][0] - 1e-12:
                break
            scores = np.zeros(BLOCK)
            for t, w in zip(where.tolist(), weight, strict=True):
                if found := self.postings[t].get(int(b)):
                    scores[found[0]] += w * found[1]
            for e in np.flatnonzero(scores):
                item = (scores[e], -int(b * BLOCK + e))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, -e) for s, e in sorted(best, reverse=True)]

    def score(self, counts: list[tuple[int, int]]) -> tuple[float, list]:
        """(score, ids of the three nearest examples)."""
        where, weight = self.vector(counts)
        if not len(where):
            return self.blank_rate, []
        near = self.nearest(where, weight)
        at = [e for _, e in near]
        vote = np.array([s for s, _ in near]) * self.votes[at]
        score = (float((vote * self.toxic[at]).sum()) + PRIOR_WEIGHT * self.base) / (float(vote.sum()) + PRIOR_WEIGHT)
        return min(1.0, max(0.0, score)), [self.ids[e] for e in at[:3]]


def labelled_examples(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES) -> tuple[DataFrame, dict[int, int]]:
    """A bounded sample of the different labelled texts outside the held-out fold
    (doc_id, toxic, text), at most ``per_class`` of each class, and how many there
    are of each class. A hash of the text picks them."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0
    known = labels.where("doc_id is not null and toxic is not null").where(fold).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.where("text is not null").withColumn("pick", F.xxhash64("text"))
    picked = written(texts.select("doc_id", "pick").join(known, "doc_id").groupBy("toxic", "pick").agg(F.min("doc_id").alias("doc_id")), "toxic-known")
    sizes = {r.toxic: r["count"] for r in picked.groupBy("toxic").count().collect()}
    few = [picked.where(F.col("toxic") == y).orderBy("pick").limit(per_class) for y in (0, 1)]
    # at most twice per_class rows
    chosen = F.broadcast(few[0].union(few[1]))
    examples = written(texts.join(chosen, ["doc_id", "pick"]).groupBy("doc_id", "pick", "toxic").agg(F.min("text").alias("text")).select("doc_id", "toxic", "text"), "toxic-examples")
    forget(picked)
    return examples, sizes


def _hits(batches: Iterator[pa.RecordBatch], finder) -> Iterator[pa.RecordBatch]:
    find = finder.value
    for batch in slices(batches):
        found = [find(words_of(text)) for text in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([*columns, *batch.columns[2:]], ["doc_id", "terms", "counts", *batch.schema.names[2:]])


class _Memory:
    """Scores of what was seen lately: most texts have few telling terms."""

    def __init__(self, index: BlockMaxIndex, most: int = 20_000):
        self.index, self.most, self.known = index, most, {}

    def __call__(self, where: list[int], count: list[int]) -> tuple[float, list]:
        key = (*where, -1, *count)
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= self.most:
                self.known.clear()
            found = self.known[key] = self.index.score(list(zip(where, count, strict=True)))
        return found


def _scores(batches: Iterator[pa.RecordBatch], index) -> Iterator[pa.RecordBatch]:
    score = _Memory(index.value)
    for batch in batches:
        found = [score(*c) for c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])


def _harmless(batches: Iterator[pa.RecordBatch], finder, index) -> Iterator[pa.RecordBatch]:
    """The rows that are not predicted toxic."""
    find, score = finder.value, _Memory(index.value)
    for batch in slices(batches):
        keep = []
        for text in batch["text"].to_pylist():
            found = find(words_of(None if text is None else str(text)))
            keep.append(score([*found], [*found.values()])[0] < TOXIC)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _fitted(slim: DataFrame, labels: DataFrame, per_class: int) -> tuple:
    """(term finder, index, both as broadcasts, and the terms of every text)."""
    sc = slim.sparkSession.sparkContext
    examples, sizes = labelled_examples(slim, labels, per_class)
    n = {r.toxic: r["count"] for r in examples.groupBy("toxic").count().collect()}
    find = TermFinder(telling_terms(examples, n.get(0, 0), n.get(1, 0)))
    finder = sc.broadcast(find)
    hit = "doc_id long, terms array<int>, counts array<int>"
    # at most twice per_class rows
    picked = examples.select("doc_id", "text", "toxic", F.xxhash64("text").alias("pick"))
    sample = picked.mapInArrow(lambda it: _hits(it, finder), f"{hit}, toxic int, pick long").collect()
    # of examples that are equally near, a hash of the text says which vote: a doc_id is no part of a score
    sample.sort(key=lambda r: (r.pick, r.toxic, r.terms, r.counts))
    hits = written_slim(slim.mapInArrow(lambda it: _hits(it, finder), hit), "toxic-hits")
    frequency = np.zeros(len(find.names))
    for r in hits.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[r.term] = r["count"]
    idf = np.log((1 + hits.count()) / (1 + frequency)) + 1
    weights = tuple(sizes.get(y, 0) / max(1, n.get(y, 0)) for y in (0, 1))
    index = BlockMaxIndex([dict(zip(r.terms, r.counts, strict=True)) for r in sample], np.array([r.toxic for r in sample], np.int64), [r.doc_id for r in sample], idf, weights)
    forget(examples)
    return finder, sc.broadcast(index), hits


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, held_out (crc32 of
    the doc_id as text is divisible by 5), score (0 to 1, higher: likelier toxic),
    predicted (1 if score >= 0.5), evidence (doc_ids of the nearest examples).

    labels (doc_id, toxic): rows outside the held-out fold are learnt from, at most
    ``per_class`` different texts of each class; a doc_id with several labels is toxic if any says
    so. Votes are weighted by what a sampled document of its class stands for.
    Texts without a telling term (null and empty ones too) have the rate of such
    examples. Without labels of both classes every score is the rate of the one
    there is, or 0. A null doc_id has held_out false. Other columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    finder, index, hits = _fitted(slim, labels, per_class)
    # the table of terms is small, so its splits are few; work is dealt by rows
    dealt = hits.repartition(max(1, -(-hits.count() // ROWS_PER_TASK)))
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    scored = dealt.mapInArrow(lambda it: _scores(it, index), "doc_id long, score double, evidence array<long>")
    out = written(scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), "evidence"), "toxic-scores")
    forget(hits)
    finder.destroy()
    index.destroy()
    return out


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES) -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic, by the scores of
    :func:`score_toxicity`, those with a null doc_id too. Texts are scored where they
    are read, so none is shuffled."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    finder, index, hits = _fitted(slim, labels, per_class)
    forget(hits)
    return docs.mapInArrow(lambda it: _harmless(it, finder, index), docs.schema)
