"""A doc_id decides the fold and nothing else."""

from __future__ import annotations

import random
import zlib

from tilewright.llm.toxicity import drop_toxic, score_toxicity


def corpus():
    rng = random.Random(2)
    plain, bad = [f"word{k}" for k in range(40)], ["awful", "stupid", "idiot", "trash", "moron", "filth"]
    docs, labels = [], []
    learnt = [k for k in range(900) if zlib.crc32(str(k).encode()) % 5]
    for k in range(900):
        toxic = rng.random() < 0.4
        words = rng.choices(plain, k=12) + (rng.choices(bad, k=rng.choice([1, 1, 2, 6])) if toxic or rng.random() < 0.03 else [])
        docs.append((k, " ".join(rng.sample(words, len(words)))))
        labels.append((k, int(toxic)))
    return docs, labels, learnt


def test_exchanged_ids_leave_scores_alone(spark):
    docs, labels, learnt = corpus()
    other = learnt[:]
    random.Random(9).shuffle(other)
    to = dict(zip(learnt, other, strict=True))

    def scores(move):
        d = spark.createDataFrame([(move.get(k, k), t) for k, t in docs], "doc_id long, text string").repartition(3)
        y = spark.createDataFrame([(move.get(k, k), v) for k, v in labels], "doc_id long, toxic int")
        return {r.doc_id: r.score for r in score_toxicity(d, y).collect()}

    before, after = scores({}), scores(to)
    assert len(set(before.values())) > 5
    assert all(before[k] == after[to.get(k, k)] for k, _ in docs)


def test_a_null_id_saves_no_toxic_row(spark):
    docs, labels, _ = corpus()
    rows = [*docs, (None, "awful stupid idiot trash moron filth"), (None, "word1 word2 word3")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    kept = drop_toxic(d, spark.createDataFrame(labels, "doc_id long, toxic int")).where("doc_id is null").collect()
    assert [r.text for r in kept] == ["word1 word2 word3"]
