"""Every registered query gives the rows of its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from sparkevents.plans import catalogue

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

QUERIES, ORACLES = catalogue.callables(), catalogue.oracles()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def by_text(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=by_text)
    if name not in ORACLES:
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=by_text)


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
