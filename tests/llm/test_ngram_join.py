from __future__ import annotations

import random
import re

import pytest

from tilewright.llm.ngram_join import bands_for, ngram_jaccard_join, ngrams, one_of_each, words
from tilewright.operators.graph import connected_components

SCHEMA = "doc_id long, text string, class_id string"


def grams_of(text, n=5):
    w = re.findall(r"\w+", (text or "").lower())
    if not w:
        return frozenset()
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def brute(rows, similarity=0.8):
    """doc_id -> (class_id, text_class, n_copies, n_links, n_doc_links) for unique doc_ids."""
    words_of = {d: tuple(re.findall(r"\w+", (t or "").lower())) for d, t, *_ in rows}
    sets = {d: grams_of(t) for d, t, *_ in rows}
    linked = {d: {e for e in sets if e != d and sets[d] and sets[e] and len(sets[d] & sets[e]) >= similarity * len(sets[d] | sets[e]) - 1e-9} for d in sets}
    out = {}
    for d in sets:
        seen, todo = {d}, [d]
        while todo:
            for e in linked[todo.pop()] - seen:
                seen.add(e)
                todo.append(e)
        copies = {e for e in sets if words_of[e] == words_of[d] and words_of[d]} | {d}
        others = linked[d] - copies
        out[d] = (min(seen), min(copies), len(copies), len({words_of[e] for e in others}), len(linked[d] | copies) - 1)
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)] + ["éàü", "naïve"]
    rows, k = [], 0
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice((3, 6, 30, 80, 200)))]
        rows.append((k, " ".join(base), "x"))
        k += 1
        for _ in range(rng.randrange(6)):
            edited = list(base)
            for _ in range(rng.randrange(4)):
                edited[rng.randrange(len(edited))] = rng.choice(vocab)
            rows.append((k, "  ".join(edited).upper() if k % 3 else ", ".join(edited) + ".", None))
            k += 1
    return rows


def result(df):
    return {r.doc_id: (r.class_id, r.text_class, r.n_copies, r.n_links, r.n_doc_links) for r in df.collect()}


def test_against_all_pairs(spark):
    rows = [*corpus(), (900, None, None), (901, "", None), (902, "?! ..", None), (903, "", None), (904, "word " * 5000, None), (905, "word " * 5001, None)]
    found = result(ngram_jaccard_join(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert found == brute(rows)
    assert found[902] == (902, 902, 1, 0, 0)


def test_large_cluster_in_several_blocks(spark, monkeypatch):
    import tilewright.llm.ngram_join as m

    monkeypatch.setattr(m, "BLOCK_WEIGHT", 6000)
    rng = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for k in range(60):
        edited = list(base)
        for _ in range(rng.randrange(5)):
            edited[rng.randrange(120)] = f"e{k}"
        rows.append((k, " ".join(edited), None))
    assert result(ngram_jaccard_join(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f g", None), (1, "a b c d e f g", None), (None, "a b c d e f g", None), (2, "q r s t u v", None), (None, "alone in the whole wide world", None)]
    found = sorted(ngram_jaccard_join(spark.createDataFrame(rows, SCHEMA)).collect(), key=str)
    of_one = [r for r in found if r.text_class == 1]
    assert len(of_one) == 3 and {r.n_copies for r in of_one} == {3} and {r.n_doc_links for r in of_one} == {2}
    assert len(found) == 5


def test_empty_table(spark):
    assert ngram_jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0
    assert one_of_each(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_of_each_keeps_columns(spark):
    rows = [(5, "a b c d e f g", "k"), (4, "A b, c d e f g", "l"), (4, "A b, c d e f g", "l"), (9, "z", "m"), (None, "n", None)]
    kept = one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.class_id) for r in kept if r.doc_id) == [(4, "l"), (9, "m")]
    assert [r.text for r in kept if r.doc_id is None] == ["n"]


def test_one_of_each_with_any_columns(spark):
    rows = [(k, f"a b c d e f {'x' if k < 3 else k}", k) for k in range(6)]
    table = spark.createDataFrame(rows, "doc_id int, text string, k int").selectExpr("*", "k as `a.b`", "k as __rank", "k as row", "k as tie", "map('k', k) as m", "array(map(k, 'v')) as n")
    kept = one_of_each(table)
    assert kept.columns == table.columns and kept.schema["doc_id"].dataType == table.schema["doc_id"].dataType
    found = kept.collect()
    assert sorted(r.doc_id for r in found) == [0, 3, 4, 5] and all(r["a.b"] == r.row == r.m["k"] == r.doc_id for r in found)


def test_one_row_many_times_is_folded_before_the_shuffle(spark):
    table = spark.range(200_000).selectExpr("7L as doc_id", "'one two three four five six' as text", "'s' as source").repartition(4)
    kept = one_of_each(table)
    assert [tuple(r) for r in kept.collect()] == [(7, "one two three four five six", "s")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_fingerprints_tell_n_grams_apart():
    rng = random.Random(1)
    for _ in range(50):
        parts = [rng.choice(("a", "aa", "b", "é", "ab")) for _ in range(rng.randrange(40))]
        assert len(ngrams(parts, 5)) == len(grams_of(" ".join(parts)))
    assert words(None) == []


def test_bands_reach_the_recall():
    assert 1 - (1 - 0.8**5) ** bands_for(0.8, 0.999, 5) >= 0.999


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_search(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)] + [(None, 3)]
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    expected = {}
    for n in near:
        seen, todo = {n}, [n]
        while todo:
            for e in near[todo.pop()] - seen:
                seen.add(e)
                todo.append(e)
        expected[n] = min(seen)
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == len(expected) and {r.node: r.component for r in found} == expected
