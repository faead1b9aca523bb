from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tilewright.llm.mixing import bisected, entropy, epochs_of, mix_sources, tempered
from tilewright.llm.sharding import Ring, even_capacities, shard_documents
from tilewright.llm.toxicity import BlockMaxIndex, TermFinder, drop_toxic, score_toxicity, words_of
from tilewright.llm.url_filter import bloom_words, filter_urls, rule_table
from tilewright.llm.warc import look_up, parse_record, record, reversed_host_key, round_trip, write_archive

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, rank int"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, 0, 1, 1) for d, t, s in rows], DOCS)


# --- sharding


def insert_one_by_one(ring, keys, room):
    """keys: (priority, row, arc) in order."""
    room, out = list(room), {}
    for _, row, arc in sorted(keys):
        s = next(s for s in ring.order[arc] if room[s] > 0)
        room[s] -= 1
        out[row] = int(s)
    return out


def test_shards_are_those_of_one_by_one_insertion(spark, monkeypatch):
    import tilewright.llm.sharding as m

    monkeypatch.setattr(m, "FEW_ROWS", 40)
    made = []
    monkeypatch.setattr(m, "written", lambda df, name, f=m.written: made.append(f(df, name)) or made[-1])
    rows = [(k, f"text {k % 900}", "s") for k in range(1500)] + [(None, None, None)] * 3 + [(7, "text 7", "s")] * 5
    found = shard_documents(docs(spark, rows)).collect()
    stored = made[0].collect()
    ring = Ring(8)
    expected = insert_one_by_one(ring, [(r.priority, r.row, r.arc) for r in stored], even_capacities(len(rows), 8))
    rank = {r.row: (r.doc_id, r.text_crc32) for r in stored}
    assert Counter((rank[row], s) for row, s in expected.items()) == Counter(((r.doc_id, r.text_crc32), r.shard) for r in found)
    counts = Counter(r.shard for r in found)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))
    one = next(r for r in found if r.doc_id == 3)
    assert (one.size, one.text_crc32) == (len("text 3") + 1, zlib.crc32(b"text 3"))
    assert {(r.size, r.text_crc32) for r in found if r.doc_id is None} == {(1, 0)}


def test_full_shards_are_found_in_few_jobs(spark):
    """A bucket in which a shard fills up takes one job, however many partitions its sort would have."""
    rows = docs(spark, [(k, f"text {k}", "s") for k in range(300)])
    before, name = spark.conf.get("spark.sql.shuffle.partitions"), "shards-in-few-jobs"
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup(name, name)
    try:
        shard_documents(rows)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)) < 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_more_shard_moves_few(spark):
    rows = [(k, f"t{k}", "s") for k in range(2000)]
    before = {r.doc_id: r.shard for r in shard_documents(docs(spark, rows), 8, capacities=[320] * 8).collect()}
    after = {r.doc_id: r.shard for r in shard_documents(docs(spark, rows), 9, capacities=[320] * 9).collect()}
    assert sum(before[d] != after[d] for d in before) < 0.4 * len(rows)


def test_many_repeated_rows_and_a_long_text(spark, monkeypatch):
    import tilewright.llm.sharding as m

    monkeypatch.setattr(m, "FEW_ROWS", 40)
    long = "long é " * 50_000
    rows = [(1, "same", "s")] * 900 + [(k, f"t{k}", "s") for k in range(100)] + [(5000, long, "s")]
    found = shard_documents(docs(spark, rows).repartition(5)).collect()
    counts = Counter(r.shard for r in found)
    assert len(found) == len(rows) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(n)) for s, n in counts.items())
    assert [(r.size, r.text_crc32) for r in found if r.doc_id == 5000] == [(len(long.encode()) + 1, zlib.crc32(long.encode()))]


def test_movement_of_equal_counts(spark):
    """What one more shard moves under the law of the query (README)."""
    rows = [(k, f"t{k}", "s") for k in range(4000)]
    eight, nine = ({r.doc_id: r.shard for r in shard_documents(docs(spark, rows), n).collect()} for n in (8, 9))
    moved = sum(eight[d] != nine[d] for d in eight) / len(rows)
    assert 1 / 9 <= moved < 0.5


def test_no_rows_and_few_rows(spark):
    assert shard_documents(docs(spark, [])).count() == 0
    assert sorted(r.slot for r in shard_documents(docs(spark, [(1, "a", "s"), (2, "b", "s")])).collect()) == [0, 0]


# --- URL filter


def judged(url, rules, listed=()):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:at])
    path = rest[at:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    return host, path, None, "block" if host and (host, path) in listed else "allow"


def test_urls_against_plain_rules(spark):
    from tilewright.llm.url_filter import RULES

    hosts = ["example.com", "WWW.Example.com", "a.www.example.com", "other.net", "net", "com", "xcom", "example.com.", "É.com", ""]
    tails = ["", "/", "/en/", "/en", "/en/x?y#z", "/es/a", "/fr/", "?q", "#f", "/EN/", "//x"]
    urls = [f"http://{h}{t}" for h in hosts for t in tails] + [None, "", "no scheme", "a://b://c/", "://com/"]
    rows = [(k, u, k) for k, u in enumerate(urls)] + [(3, urls[3], 0), (None, "http://com/", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule int")
    listed = spark.createDataFrame([("http://other.net/x",), ("https://Other.net#f",), (None,)], "url string")
    for kept in (None, listed):
        known = {("other.net", "/x"), ("other.net", "")} if kept else ()
        found = filter_urls(pages, listed=kept).collect()
        assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found) == Counter((k, *judged(u, RULES, known)) for k, u, _ in rows)
    none = filter_urls(pages, rules=rule_table(spark, RULES).limit(0))
    assert {r.verdict for r in none.collect()} == {"allow"}
    assert filter_urls(pages.limit(0)).count() == 0


def test_bloom_filter_keeps_every_key(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) as key")
    assert np.bitwise_count(bloom_words(keys, 3000)).sum() > 3000
    many = spark.createDataFrame([("com", f"/{k}", "block") for k in range(1000)], "host string, path string, verdict string")
    pages = spark.range(1000).selectExpr("id as page_id", "concat('http://com/', id) as url")
    assert filter_urls(pages, rules=many).where("verdict = 'block'").count() == 1000


def test_hosts_of_many_labels(spark):
    urls = ["http://" + "a." * 100_000 + "example.com/en/x", "http://" + "b" * 200_000 + ".net/es/", "http://www.example.com/en/" + "p" * 300_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: (r.rule, r.verdict) for r in filter_urls(pages).collect()}
    assert found == {0: ("example.com/en/", "block"), 1: ("net/es/", "block"), 2: ("www.example.com/en/", "allow")}


# --- WARC


def test_one_response_of_repeated_rows(spark):
    """Equal rows that hold the largest page_id: one is the response, the others revisit it."""
    rows = [(9, "http://a.b/x", "y" * 2000)] * 4 + [(3, "http://a.b/x", "y" * 2000), (9, "http://a.a/", "y" * 2000), (1, "http://a.b/x", "small"), (1, "http://a.b/x", "small")]
    found = round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    big = [r for r in found if r.payload_bytes == 2000]
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in big) == {(9, "response", None): 1, (9, "revisit", 9): 4, (3, "revisit", 9): 1}
    assert Counter(r.record_type for r in found if r.payload_bytes == 5) == {"response": 2}


def test_record_round_trip():
    fields, body = parse_record(record("response", "3", "http://a/\r\nX: 1", "d", None, b"\r\n\r\nx"))
    assert body == b"\r\n\r\nx" and fields["WARC-Record-ID"] == "<urn:page:3>"
    assert parse_record(record("revisit", "3", "", "d", "9", b"xyz"))[1] == b""


def test_archive_round_trip(spark, monkeypatch):
    import tilewright.llm.warc as m

    monkeypatch.setattr(m, "BLOCK_LINES", 3)
    big, long = "é" * 600, "z" * 1000
    rows = [(k, f"http://Host{k % 4}.org/p{k % 9}", big if k % 3 else f"{k}" * 10, 0) for k in range(60)]
    rows += [(100, None, None, 0), (101, "", "", 0), (102, "no scheme", long, 0), (103, "http://a.b/?q", long[:999], 0), (104, "x", long[:999], 0), (None, "http://a.b", long, 0), (105, "http://host1.org/p1", "v" * 300_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key int")
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in round_trip(pages.repartition(4)).collect()}
    expected = {}
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        same = [p for p, _, h, _ in rows if (h or "") == (html or "") and p is not None]
        shown = max(same, default=None)
        revisit = len(data) >= 1000 and page_id != shown
        expected[page_id] = (len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", shown if revisit else None)
    assert found == expected
    folder = write_archive(pages)
    seen = look_up(spark, folder, spark.createDataFrame([("http://HOST1.org/p1",), ("http://nowhere.org/",)], "url string")).collect()
    assert sorted(r.page_id for r in seen) == sorted(k for k, u, *_ in rows if u and u.lower() == "http://host1.org/p1")
    assert round_trip(pages.limit(0)).count() == 0


def test_reversed_hosts(spark):
    urls = spark.createDataFrame([("http://www.Example.com/a?b",), (None,), ("plain",)], "url string")
    assert [r[0] for r in urls.select(reversed_host_key(urls.url)).collect()] == ["com,example,www)/a?b", "", "plain"]


# --- toxicity


def test_block_max_search_is_exact():
    rng = random.Random(6)
    labelled = [{rng.randrange(30): rng.randrange(1, 4) for _ in range(rng.randrange(6))} for _ in range(300)]
    toxic = np.array([rng.randrange(2) for _ in labelled])
    index = BlockMaxIndex(labelled, toxic, list(range(300)), np.linspace(1, 5, 30), (1.0, 2.0))

    def unit(c):
        v = np.zeros(30)
        where, weight = index.vector(list(c.items()))
        v[where] = weight
        return v

    matrix = np.array([unit(c) for c in labelled])
    for c in labelled[:60]:
        where, weight = index.vector(list(c.items()))
        if not len(where):
            continue
        cosines = matrix @ unit(c)
        found = index.nearest(where, weight, 7)
        expected = sorted((-round(s, 9), e) for e, s in enumerate(cosines) if s > 0)[:7]
        assert [round(s, 9) for s, _ in found] == [-s for s, _ in expected]


def test_finder_counts_words_and_their_beginnings():
    find = TermFinder(["nasty", "vile*", "ab"])
    at = {find.names[k]: n for k, n in find(words_of("Nasty vilest VILER vile ab abc nasty")).items()}
    assert at == {"nasty": 2, "vile*": 3, "ab": 1, "#5": 2}
    assert find(words_of(None)) == {}


def toxic_corpus(n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(5, 200))]
        bad = k % 5 == 1 or k % 35 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["nasty", "vilest" + rng.choice("abc"), "rotten"]))
        rows.append((k, " ".join(words), "s"))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = toxic_corpus()
    rows += [(1000, None, None), (1001, "", None), (None, "nasty nasty", None), (2, rows[2][1], "s")]
    marks = spark.createDataFrame([*labels, (5, None, None), (None, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    found = score_toxicity(docs(spark, rows), marks).collect()
    assert len(found) == len(rows)
    truth = {d: y for d, _, y in labels}
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)
    assert {r.predicted for r in found if r.doc_id in (1000, 1001)} == {0}
    kept = drop_toxic(docs(spark, rows), marks)
    assert kept.columns == docs(spark, rows).columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if not r.predicted}


def test_no_labels_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in score_toxicity(docs(spark, [(1, "a", "s")]), none).collect()} == {0.0}
    assert score_toxicity(docs(spark, []), none).count() == 0


# --- mixing


def test_bisection():
    shares = {"a": 0.7, "b": 0.2, "c": 0.1}
    x = bisected(shares, max_epochs=2)
    assert abs(max(epochs_of(shares, tempered(shares, x)).values()) - 2) < 1e-6
    target = (entropy(shares) + math.log(3)) / 2
    assert abs(entropy(tempered(shares, bisected(shares, target_entropy=target))) - target) < 1e-6
    assert bisected(shares, max_epochs=100) == 0 and bisected(shares, max_epochs=1) == 1
    with pytest.raises(ValueError):
        bisected(shares)


def test_mix_meets_its_budgets(spark):
    rng = random.Random(3)
    rows = [(k, "w " * rng.randrange(1, 60), "big" if k % 3 else ("b" if k % 2 else None)) for k in range(3000)] + [(5000, None, "tiny"), (5001, "", "tiny")]
    table = docs(spark, rows)
    found = mix_sources(table.repartition(3), max_epochs=1.5).collect()
    tokens = {d: len((t or "").split()) + 1 for d, t, _ in rows}
    total, times = Counter(), Counter(r.doc_id for r in found)
    for d, _, s in rows:
        total[s] += tokens[d]
    assert set(times) == set(tokens) and set(times.values()) <= {1, 2}
    assert len({(r.doc_id, r.mix_epoch) for r in found}) == len(found)
    x = found[0].mix_exponent
    want = epochs_of({s: t / sum(total.values()) for s, t in total.items()}, tempered({s: t / sum(total.values()) for s, t in total.items()}, x))
    got = Counter()
    for r in found:
        got[r.source] += r.mix_tokens
    for s in total:
        assert 0 <= got[s] - want[s] * total[s] + 1 <= 62
    again = mix_sources(table.repartition(7), max_epochs=1.5).collect()
    assert Counter((r.doc_id, r.mix_epoch) for r in again) == Counter((r.doc_id, r.mix_epoch) for r in found)


def test_budget_below_one_pass_and_empty(spark):
    table = docs(spark, [(k, "a b c", "s" if k % 2 else "t") for k in range(1000)])
    found = mix_sources(table, target_entropy=math.log(2), max_epochs=None, budget=1000).collect()
    assert Counter(r.source for r in found) == {"s": 125, "t": 125} and len({r.doc_id for r in found}) == 250
    assert mix_sources(table.limit(0)).count() == 0


def plain_mix(rows, max_epochs, place_of, turn_of, runs_of, block_docs):
    """Occurrences (row index, epoch) by plain Python. place_of(row, full), turn_of(block): the operator's hashes."""
    tokens = [len((t or "").split()) + 1 for _, t, _ in rows]
    total, of = Counter(), {}
    for k, (_, _, s) in enumerate(rows):
        total[s] += tokens[k]
        of.setdefault(s, []).append(k)
    share = {s: n / sum(total.values()) for s, n in total.items()}

    def passes(x):
        raw = {s: p**x for s, p in share.items()}
        ratio = {s: raw[s] / share[s] for s in share}
        return {s: r / min(ratio.values()) for s, r in ratio.items()}

    low, high = 0.0, 1.0
    if max(passes(0.0).values()) <= max_epochs:
        high = 0.0
    for _ in range(60 if high else 0):
        mid = (low + high) / 2
        low, high = (mid, high) if max(passes(mid).values()) > max_epochs else (low, mid)
    out = []
    for s, ks in of.items():
        p = min(passes(high)[s], max_epochs)
        full, rest, n_blocks = int(p), round(p % 1 * total[s]), -(-len(ks) // block_docs)
        out += [(k, e) for k in ks for e in range(full)]
        blocks = {}
        for k in ks:
            place, block = place_of(k, full, n_blocks)
            blocks.setdefault((runs_of(block, n_blocks), turn_of(block), block), []).append((place, k))
        used = 0
        for at in sorted(blocks):
            for _, k in sorted(blocks[at]):
                if used < rest:
                    out.append((k, full))
                used += tokens[k]
    return Counter(out)


def test_mix_against_plain_python(spark, monkeypatch):
    import tilewright.llm.mixing as m
    from pyspark.sql import functions as F

    monkeypatch.setattr(m, "BLOCK_DOCS", 16)
    monkeypatch.setattr(m, "RUN_BLOCKS", 8)
    rng = random.Random(12)
    rows = [(k, "w " * rng.randrange(1, 60), "big" if k % 3 else ("b" if k % 2 else None)) for k in range(2500)] + [(9000 + k, "x y", "tiny") for k in range(40)]
    table = docs(spark, rows)

    hashes = {(r.doc_id, r.full): r.place for r in table.withColumn("h", F.xxhash64(*table.columns)).crossJoin(spark.range(1, 3).select(F.col("id").cast("int").alias("full"))).select("doc_id", "full", F.xxhash64("h", F.lit(17), "full").alias("place")).collect()}
    numbers = spark.createDataFrame([(p,) for p in sorted(set(hashes.values()))], "p long")
    spread = {r.p: r.h for r in numbers.select("p", F.xxhash64("p", F.lit("block")).alias("h")).collect()}
    turns = {r.id: r.t for r in spark.range(400).select("id", F.xxhash64("id", F.lit(17)).alias("t")).collect()}

    def place_of(k, full, n_blocks):
        place = hashes[rows[k][0], full]
        return place, spread[place] % n_blocks

    def runs_of(block, n_blocks):
        return ((turns[block] >> 33) + (1 << 30)) * max(1, -(-n_blocks // 8)) // (1 << 31)

    expected = plain_mix(rows, 1.5, place_of, turns.get, runs_of, 16)
    found = Counter((r.doc_id, r.mix_epoch) for r in mix_sources(table.repartition(3), max_epochs=1.5).collect())
    assert found == Counter({(rows[k][0], e): n for (k, e), n in expected.items()})


def test_mix_with_clashing_columns_repeats_and_long_texts(spark):
    names = "rest, full, n_blocks, before, b_source, block, turn, run, row, at, src, place, end, row_hash".split(", ")
    table = spark.createDataFrame([(k % 20, "a b " * (30_000 if k == 5 else 2), "s" if k % 4 else None, *[k] * 0) for k in range(200)], "doc_id long, text string, source string")
    wide = table.select("*", *[table.doc_id.alias(n) for n in names])
    found = mix_sources(wide, max_epochs=1.5)
    assert found.columns == [*wide.columns, "mix_epoch", "mix_tokens", "mix_exponent", "mix_weight"]
    rows = found.collect()
    assert sum(r.mix_epoch == 0 for r in rows) == 200 and max(r.mix_tokens for r in rows) == 60_001
    with pytest.raises(ValueError, match="mix_epoch"):
        mix_sources(table.withColumn("MIX_EPOCH", table.doc_id))
    assert mix_sources(wide.limit(0)).columns == found.columns


def test_mix_with_maps_and_dots(spark):
    table = spark.range(50).selectExpr("id as doc_id", "'a b' as text", "'s' as source", "map(id, 'x') as m", "id as `a.b`", "id as `t``k`")
    found = mix_sources(table, max_epochs=1.5)
    assert found.columns[:6] == table.columns and sorted(r["a.b"] for r in found.where("mix_epoch = 0").collect()) == list(range(50))


# --- toxicity against plain Python


def plain_scores(rows, labels, k=15):
    """doc_id -> score, from the words up: telling terms, TF-IDF, all cosines, votes. For unique doc_ids and texts."""
    import re

    fold = {d: zlib.crc32(str(d).encode()) % 5 for d, *_ in rows}
    words = {d: Counter(re.findall(r"\w+", (t or "").lower())) for d, t, *_ in rows}
    learnt = {d: y for d, y in labels.items() if fold[d]}

    def forms(w):
        return [w, *(w[:n] + "*" for n in range(3, 9) if len(w) >= n)]

    n1 = sum(learnt.values())
    n0 = len(learnt) - n1
    seen = {0: Counter(), 1: Counter()}
    for d, y in learnt.items():
        seen[y].update({f for w in words[d] for f in forms(w)})
    telling = set()
    for t in {*seen[0], *seen[1]}:
        a, b = seen[1][t], seen[0][t]
        p = (a + b) / (n0 + n1)
        cells = [(a, n1 * p), (b, n0 * p), (n1 - a, n1 * (1 - p)), (n0 - b, n0 * (1 - p))]
        ratio = 2 * sum(x * math.log(x / e) for x, e in cells if x > 0)
        risk = (a + 0.5) / (n1 + 1) / ((b + 0.5) / (n0 + 1))
        if round(ratio, 6) >= 30 and max(risk, 1 / risk) >= 10:
            telling.add(t)
    counts = {}
    for d, by in words.items():
        c, n = Counter(), 0
        for w, times in by.items():
            hit = [f for f in forms(w) if f in telling]
            n += bool(hit)
            c.update({f: times for f in hit})
        if n:
            c[f"#{min(n, 6)}"] = 2
        counts[d] = c
    frequency = Counter(t for c in counts.values() for t in c)

    def unit(c):
        v = {t: (1 + math.log(n)) * (math.log((1 + len(rows)) / (1 + frequency[t])) + 1) for t, n in c.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    units = {d: unit(c) for d, c in counts.items()}
    base = n1 / (n0 + n1)
    blank = [y for d, y in learnt.items() if not counts[d]]
    out = {}
    for d in units:
        if not units[d]:
            out[d] = (sum(blank) + 0.05 * base) / (len(blank) + 0.05)
            continue
        near = sorted(((sum(x * units[e].get(t, 0) for t, x in units[d].items()), e) for e in learnt), key=lambda x: (-round(x[0], 12), x[1]))[:k]
        near = [(s, e) for s, e in near if s > 0]
        out[d] = (sum(s * learnt[e] for s, e in near) + 0.05 * base) / (sum(s for s, _ in near) + 0.05)
    return out


def test_scores_against_plain_python(spark):
    rows, labels = toxic_corpus(400)
    rows += [(1000, None, None), (1001, "", None), (1002, "rotten " * 40_000, "s"), (1003, "nasty vilest rotten", None)]
    expected = plain_scores(rows, {d: y for d, _, y in labels})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    clash = docs(spark, rows).selectExpr("*", "doc_id as terms", "doc_id as score", "doc_id as toxic", "doc_id as pick")
    found = {r.doc_id: r.score for r in score_toxicity(clash, marks).collect()}
    assert found == pytest.approx(expected, abs=1e-6) and len({round(x, 6) for x in found.values()}) > 5
    kept = drop_toxic(clash, marks)
    assert kept.columns == clash.columns and {r.doc_id for r in kept.collect()} == {d for d, s in expected.items() if s < 0.5}
