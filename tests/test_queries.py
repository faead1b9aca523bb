"""Every registered query of the engine against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tilewright.plans import catalogue
from tilewright.plans.fixtures import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the general tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    found = catalogue.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    oracle = con.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in oracle.description]
    assert sorted(names) == columns
    expected = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in oracle.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in found.collect()), key=str) == expected


def test_queries_without_sql(spark):
    split = catalogue.QUERIES["group_split"](spark, SF).collect()
    assert len({r.idx for r in split}) == len(split) and {r.split for r in split} <= {"train", "val", "test"}
    assert sum(r.n for r in catalogue.QUERIES["confusion_matrix"](spark, SF).collect()) > 0
