"""Keyed tables: upserts, pruning, compaction beside writers."""

from __future__ import annotations

import pytest

from tilewright.sources.keyed import KeyedTable

SCHEMA = "k string, v int, at long"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, f"file://{tmp_path}", "t", SCHEMA, "k", ["at"], buckets=8)


def rows(spark, *found):
    return spark.createDataFrame(list(found), SCHEMA)


def held(table):
    return {r.k: (r.v, r.at) for r in table.read().collect()}


def test_the_last_row_of_a_key_counts(spark, table):
    assert held(table) == {} and table.lookup(["a"]).collect() == []
    table.append(rows(spark, ("a", 1, 1), ("b", 1, 5), ("a", 2, 2)), 1)
    table.append(rows(spark, ("b", 9, 4), ("c", 3, 1)), 2)
    expected = {"a": (2, 2), "b": (1, 5), "c": (3, 1)}
    assert held(table) == expected
    table.append(rows(spark, ("b", 9, 4), ("c", 3, 1)), 2)  # a batch again
    assert held(table) == expected and table.version()[1]["deltas"] == ["delta-1", "delta-2"]


def test_compaction_loses_nothing_of_what_comes_meanwhile(spark, table):
    table.append(rows(spark, ("a", 1, 1), ("b", 1, 1)), 1)
    table.append(rows(spark, ("a", 2, 2)), 2)
    before = table.read()
    table.compact(between=lambda: table.append(rows(spark, ("b", 7, 3), ("d", 1, 1)), 3))
    number, now = table.version()
    assert now["deltas"] == ["delta-3"] and now["base"].startswith("base-")
    assert held(table) == {"a": (2, 2), "b": (7, 3), "d": (1, 1)}
    # a reader keeps the version that it began with
    assert {r.k: r.v for r in before.collect()} == {"a": 2, "b": 1}
    # a batch that is repeated behind its compaction changes nothing
    table.append(rows(spark, ("a", 1, 1), ("b", 1, 1)), 1)
    assert held(table) == {"a": (2, 2), "b": (7, 3), "d": (1, 1)}
    table.compact()
    table.vacuum()
    assert held(table) == {"a": (2, 2), "b": (7, 3), "d": (1, 1)} and table.version()[0] > number


def test_two_compactions_do_not_mix(spark, table):
    table.append(rows(spark, ("a", 1, 1)), 1)
    with pytest.raises(RuntimeError, match="faster"):
        table.compact(between=table.compact)
    assert held(table) == {"a": (1, 1)}


def test_a_version_whose_writer_died_is_passed_over(spark, table, tmp_path):
    table.append(rows(spark, ("a", 1, 1)), 1)
    (tmp_path / "t" / "_versions" / "000000000002.json").write_text('{"base": null, "del')
    assert held(table) == {"a": (1, 1)}
    table.append(rows(spark, ("b", 1, 1)), 2)
    assert held(table) == {"a": (1, 1), "b": (1, 1)} and table.version()[0] == 3


def test_two_writers_both_get_in(spark, table):
    other = KeyedTable(spark, table.place.rsplit("/", 1)[0], "t", SCHEMA, "k", ["at"], buckets=8)
    seen = table.version
    calls = []

    def late():
        found = seen()
        if not calls:
            calls.append(1)
            other.append(rows(spark, ("b", 2, 1)), "other")
        return found

    table.version = late
    table.append(rows(spark, ("a", 1, 1)), "mine")
    assert held(other) == {"a": (1, 1), "b": (2, 1)}


def test_a_look_up_reads_its_buckets(spark, table, capfd):
    table.append(rows(spark, *[(f"k{j}", j, j) for j in range(200)]), 1)
    found = table.lookup(["k7", "k8"])
    assert sorted((r.k, r.v) for r in found.collect()) == [("k7", 7), ("k8", 8)]
    found.explain("formatted")
    told = capfd.readouterr().out
    assert "PartitionFilters: [isnotnull(bucket" in told or "PartitionFilters: [bucket" in told
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    files = {f.split("bucket=")[1].split("/")[0] for f in table.lookup(["k7"])._jdf.inputFiles()}
    assert len({f.split("bucket=")[1].split("/")[0] for f in table.read()._jdf.inputFiles()}) == 8 and files
