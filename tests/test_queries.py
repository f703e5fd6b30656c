"""Every core query against DuckDB on the smallest test data; queries without SQL must run."""

from __future__ import annotations

import math
import os

import pytest

from notarium.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return con


def plain(rows, columns):
    def one(v):
        if v is None or v != v:
            return "~"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return repr(round(float(v), 9))
        return str(v)

    return sorted(tuple(one(r[c]) for c in columns) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    rows = [r.asDict() for r in df.collect()]
    if name not in catalogue.SQL:
        return
    cur = duck.execute(catalogue.SQL[name])
    names = [x[0] for x in cur.description]
    want = [dict(zip(names, r, strict=True)) for r in cur.fetchall()]
    assert sorted(names) == sorted(df.columns)
    assert plain(rows, sorted(names)) == plain(want, sorted(names))


def test_names_do_not_clash():
    import re

    assert not [q for q in catalogue.QUERIES if re.match(r"p\d+_", q)]
    assert math.isfinite(len(catalogue.SQL))
