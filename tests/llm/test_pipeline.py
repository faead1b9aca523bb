"""The pipeline and its stages against plain Python, and the SQL beside the queries."""

from __future__ import annotations

import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_ngram_join import brute
from test_rest import plain_scores
from test_tokens import check_packed
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tilewright.llm import queries
from tilewright.llm.packing import cut
from tilewright.llm.tokenise import default_tokenizer

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    rows, labels = [], {}
    for k in range(360):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(8, 120))]
        if k % 5 == 1:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["nasty", "vilesta", "rotten"]))
        rows.append((k, " ".join(words), rng.choice(["big", "big", "big", "small", None])))
        labels[k] = int(k % 5 == 1)
    for k in range(360, 440):  # exact and near copies of clean documents
        base = rows[rng.randrange(72) * 5][1].split()
        rows.append((k, " ".join(base if k % 2 else [*base, "zz"]), "big"))
    rows += [(500, None, "small"), (501, "", None), (502, "clean " * 6000, "small")]
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], COLUMNS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(d, 1, y) for d, y in labels.items()], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, rows, labels


def kept_by_toxicity(rows, labels):
    scores = plain_scores(rows, labels)
    return [r for r in rows if scores[r[0]] < 0.5]


def one_of_each(rows):
    least = {d: c[0] for d, c in brute(rows).items()}
    return [r for r in rows if least[r[0]] == r[0]]


def check_mixed(before, after):
    """after: (doc_id, source) of the occurrences."""
    times = Counter(d for d, _ in after)
    assert set(times) == {d for d, *_ in before} and set(times.values()) <= {1, 2}
    tokens = {d: len((t or "").split()) + 1 for d, t, _ in before}
    total, got = Counter(), Counter()
    for d, _, s in before:
        total[s] += tokens[d]
    for d, s in after:
        got[s] += tokens[d]
    assert all(total[s] <= got[s] <= 1.5 * total[s] + max(tokens.values()) for s in total) and got[max(total, key=total.get)] == total[max(total, key=total.get)]


def check_pieces(docs, found):
    library = Tokenizer.from_file(default_tokenizer())
    expected = []
    for doc_id, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected += [(doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), 2048))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(expected)
    assert check_packed(found, 2048) <= -(-sum(r.length for r in found) // 2048) * 1.03 + 1


def test_each_stage_on_its_own_input(spark, corpus):
    at, rows, labels = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert [*stage] == ["toxicity", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]

    def given(part):
        ids = {r[0] for r in part}
        return docs.where(docs.doc_id.isin(list(ids)))

    clean = kept_by_toxicity(rows, labels)
    assert 0 < len(clean) < len(rows)
    out = stage["toxicity"](spark, docs, at)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == sorted(r[0] for r in clean)

    single = one_of_each(clean)
    assert len(single) < len(clean)
    out = stage["n-gram Jaccard join"](spark, given(clean), at)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == sorted(r[0] for r in single)

    out = stage["mixing sources to target weights"](spark, given(single), at)
    assert out.columns == docs.columns
    check_mixed(single, [(r.doc_id, r.source) for r in out.collect()])

    check_pieces([(d, t) for d, t, _ in single], stage["best-fit packing"](spark, given(single), at).collect())


def test_the_whole_run(spark, corpus):
    at, rows, labels = corpus
    before = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    found = __spark_entry__.queries()["pipeline"](spark, at).collect()
    assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == before
    single = one_of_each(kept_by_toxicity(rows, labels))
    texts, source = {d: t for d, t, _ in single}, {d: s for d, _, s in single}
    times = Counter(r.doc_id for r in found if r.piece == 0)
    check_mixed(single, [(d, source[d]) for d in times.elements()])
    check_pieces([(d, texts[d]) for d in times.elements()], found)


def test_empty_documents(spark, corpus, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{corpus[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.skipif(not os.path.isdir(SF), reason="the general tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    found = queries.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    oracle = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in oracle.description]
    assert sorted(names) == columns
    expected = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in oracle.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in found.collect()), key=str) == expected
