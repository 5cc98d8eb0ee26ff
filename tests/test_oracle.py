"""Every query against its SQL on the same tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from changeloom.plans import queries as base

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_norm(row[i]) for i in order] for row in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(base.all_queries()))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = df.collect()
    assert name in entry.oracle_sql()
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want)
    assert len(want) > 0
    assert _rows(df.columns, got) == _rows(names, want)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
