"""Every registered query against its checking SQL, on the smallest data set."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from erpspark.catalog import all_checks, all_queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES, CHECKS = all_queries(), all_checks()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return repr(v + 0.0) if isinstance(v, float) else str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, DATA)
    got = df.collect()
    cur = duck.execute(CHECKS[name])
    want = cur.fetchall()
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, got) == _rows(names, want)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "gross_profit" in df.columns
