from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from tilewright.llm.packing import crossings, cut, pack_documents, pack_pieces, sequences_needed, sweep
from tilewright.llm.token_blocks import pack_block, read_token_blocks, unpack_block, write_token_blocks
from tilewright.llm.tokenise import TextEncoder, default_tokenizer

SCHEMA = "doc_id long, text string, start string, length int"
TEXTS = [
    "", None, "plain words here", " leading", "trailing ", "two  spaces", "a\n b", "a \n b", "\n \n", "  x", " \n x", "tab\t and  odd 　space", "don't we'll I'd",
    "<|endoftext|> in text<|endoftext|>", "Émile çà  et là\n\n\n  fin ", "x" * 5000, "word " * 3000, "1234 5.6 ---", "日本語 テキスト", " ", "  ", "a ", "a  ", "a\n ", "   ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_units_give_the_ids_of_the_whole(library):
    rng = random.Random(2)
    pool = ["a", "Bc", " ", "  ", "\n", "\t", ".", "'s", "é", "12", " ", "—", " x", "y "]
    texts = TEXTS + ["".join(rng.choice(pool) for _ in range(rng.randrange(30))) for _ in range(3000)]
    for remember in (500_000, 5):
        encoder = TextEncoder(default_tokenizer(), remember)
        for at in range(0, len(texts), 700):
            part = texts[at : at + 700]
            for text, got in zip(part, encoder.encode(part), strict=True):
                assert np.frombuffer(got, "<u4").tolist() == ids_of(library, text), repr(text)


@pytest.mark.parametrize("seed", range(6))
def test_block_round_trip(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 1025))
    ids = rng.integers(0, [1, 2, 300, 50_257, 2**32][seed % 5], n, dtype=np.uint32)
    ids[rng.integers(0, n, n // 40)] = 2**32 - 1
    assert (unpack_block(pack_block(ids)) == ids).all()


def test_files_round_trip(spark, library):
    rows = [(k * 7 % 50, t, None, 0) for k, t in enumerate(TEXTS)] + [(3, "again", None, 0), (3, "again", None, 0)]
    folder = write_token_blocks(spark.createDataFrame(rows, SCHEMA).repartition(3))
    found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in read_token_blocks(spark, folder).collect())
    # rows of one doc_id follow in the order of a hash of the text
    by_hash = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "xxhash64(text) as h").collect()
    in_order = [(r.doc_id, r.text) for r in sorted(by_hash, key=lambda r: (r.doc_id, r.h))]
    expected, at = [], 0
    for doc_id, text, *_ in in_order:
        ids = np.array([*ids_of(library, text), 2], "<u4")
        expected.append((at, doc_id, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert found == expected


def test_empty_and_null_ids(spark):
    assert read_token_blocks(spark, write_token_blocks(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = read_token_blocks(spark, write_token_blocks(spark.createDataFrame([(None, "a", None, 0), (1, "b", None, 0)], SCHEMA))).collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in sorted(rows, key=lambda r: r.start)] == [(None, 0, 2), (1, 2, 2)]


def test_least_id_is_not_null(spark):
    rows = [(-(2**63), "a", None, 0), (None, "b c", None, 0), (0, "d", None, 0)]
    found = read_token_blocks(spark, write_token_blocks(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [r.doc_id for r in sorted(found, key=lambda r: r.start)] == [None, -(2**63), 0]


def test_order_of_equal_ids_does_not_hang_on_the_input(spark):
    rows = [(k % 3, "the same first letters " + "and on " * (k % 7) + str(k % 5), None, 0) for k in range(60)]
    found = [
        sorted((r.start, r.doc_id, r.ids_crc32) for r in read_token_blocks(spark, write_token_blocks(spark.createDataFrame(given, SCHEMA).repartition(n))).collect())
        for given, n in ((rows, 1), (rows[::-1], 3))
    ]
    assert found[0] == found[1]


def test_cut():
    assert cut(5, 2048) == [(0, 5)] and cut(2048, 2048) == [(0, 2048)]
    assert cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)] and cut(4096, 2048) == [(0, 2048), (2048, 2048)]


def slow_best_fit(sizes, capacity):
    gaps = []
    for s in sizes:
        fits = [(g, k) for k, g in enumerate(gaps) if g >= s]
        if fits:
            gaps[min(fits)[1]] -= s
        else:
            gaps.append(capacity - s)
    return len(gaps)


@pytest.mark.parametrize("seed", range(4))
def test_sweeps_of_ranges_are_one_sweep(seed):
    """Sweeps of ranges and crossings against a plain search, piece by piece."""
    rng = np.random.default_rng(seed)
    pieces, gaps = rng.integers(1, 65, 200).tolist(), rng.integers(1, 65, 150).tolist()
    events = sorted([(g, None, k, g) for k, g in enumerate(gaps)] + [(s, k, None, None) for k, s in enumerate(pieces)], key=lambda e: (-e[0], e[1] is not None))
    taken, left = [], []
    for part in range(0, len(events), 40):
        left.append(sweep(events[part : part + 40], taken))
    for part, first, end, other, shift in crossings([(k, len(w), len(f)) for k, (w, f) in enumerate(left)]):
        taken += [(*left[part][0][i], *left[other][1][i + shift]) for i in range(first, end)]
    assert len({t[0] for t in taken}) == len({t[2] for t in taken}) == len(taken)
    free, expected = sorted(gaps), []
    for s in sorted(pieces, reverse=True):
        fit = next((g for g in free if g >= s), None)
        if fit is not None:
            free.remove(fit)
            expected.append((s, fit))
    assert sorted((size, gap) for _, size, _, gap in taken) == sorted(expected)


def test_no_more_sequences_are_opened_than_needed():
    count = lambda *sizes: np.bincount(sizes, minlength=65)
    assert sequences_needed(count(40, 40, 40), count(), 20, 64) == 3
    assert sequences_needed(count(30, 30, 30), count(29, 29), 20, 64) == 2
    assert sequences_needed(count(30, 30, 30), count(60), 20, 64) == 1
    assert sequences_needed(count(30, 20), count(64), 10, 64) == 0
    rng = np.random.default_rng(3)
    for _ in range(50):
        sizes = sorted(rng.integers(9, 65, 40).tolist(), reverse=True)
        assert sequences_needed(count(*sizes), count(), 8, 64) <= slow_best_fit(sizes, 64)


def check_packed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in by.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark, library):
    rng = random.Random(4)
    rows = [(k, t, None, 0) for k, t in enumerate(TEXTS)] + [(100 + k, "word " * rng.randrange(1, 2500), "s", k) for k in range(150)] + [(7, "same", None, 1)] * 3
    found = pack_documents(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert found[0].__fields__ == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    expected = []
    for doc_id, text, *_ in rows:
        ids = np.array([*ids_of(library, text), 0], "<u4")
        expected += [(doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), 2048))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(expected)
    used = check_packed(found, 2048)
    assert used <= -(-sum(r.length for r in found) // 2048) * 1.03 + 1


def test_several_supersteps(spark):
    rng = random.Random(8)
    rows = [(k, 0, rng.randrange(1, 65)) for k in range(4000)] + [(None, 0, 64), (None, 0, 3)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long")
    found = pack_pieces(pieces, capacity=64, shard_pieces=300).collect()
    assert sorted((str(r.doc_id), r.length) for r in found) == sorted((str(d), n) for d, _, n in rows)
    assert check_packed(found, 64) <= slow_best_fit(sorted((r[2] for r in rows), reverse=True), 64) * 1.01


def test_bad_lengths_and_empty(spark):
    pieces = spark.createDataFrame([(1, 0, 65)], "doc_id long, piece int, length long")
    with pytest.raises(ValueError):
        pack_pieces(pieces, capacity=64)
    with pytest.raises(ValueError):
        pack_pieces(pieces.withColumn("Offset", pieces.length))
    with pytest.raises(ValueError):
        pack_pieces(spark.createDataFrame([(1, None)], "doc_id long, length long"))
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_other_columns_stay_when_packed(spark):
    rows = [(k, 1 + k % 64, k, "x", None, 5, 6) for k in range(200)]
    found = pack_pieces(spark.createDataFrame(rows, "doc_id long, length int, row long, size string, seq string, gap int, part int"), capacity=64, shard_pieces=50).collect()
    assert sorted(tuple(r)[:7] for r in found) == rows and check_packed(found, 64) <= slow_best_fit(sorted((r[1] for r in rows), reverse=True), 64) + 1


def test_more_ranges_than_asked_for(spark, monkeypatch):
    frame = type(spark.range(0))
    by_range = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, n, *columns: by_range(self, max(n, 13), *columns))
    rows = [(k, 1 + k * k % 60) for k in range(400)]
    found = pack_pieces(spark.createDataFrame(rows, "doc_id long, length long"), capacity=64).collect()
    assert sorted((r.doc_id, r.length) for r in found) == rows
    assert check_packed(found, 64) <= slow_best_fit(sorted((r[1] for r in rows), reverse=True), 64) * 1.02 + 1


def test_packing_of_any_columns(spark):
    """Names with dots, names that look like the operator's own, and maps come back as they were; one table stays."""
    rows = [(i, 1 + i * 37 % 40, {"k": i % 3}, f"t{i}", i) for i in range(300)]
    given = spark.createDataFrame(rows, "doc_id long, length int, `a.b` map<string,int>, `row` string, __row long")
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = {p.name for p in Path(folder).iterdir() if p.name.startswith("pack-")}
    packed = pack_pieces(given, capacity=64, shard_pieces=40)
    assert packed.columns == ["doc_id", "length", "a.b", "row", "__row", "sequence_id", "offset"]
    got = packed.collect()
    assert sorted((r[0], r[1], r[2]["k"], r[3], r[4]) for r in got) == [(i, n, m["k"], t, j) for i, n, m, t, j in rows]
    assert check_packed(got, 64) <= slow_best_fit(sorted((r[1] for r in rows), reverse=True), 64) + 1
    left = {p.name for p in Path(folder).iterdir() if p.name.startswith("pack-")} - before
    assert len(left) == 1 and next(iter(left)).startswith("pack-packed")
