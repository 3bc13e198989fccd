"""Every query of the engine against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from terralot.plans import catalog, files, more

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, db, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    a = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    cur = db.execute(catalog.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    b = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=repr)
    assert a == b


def test_registered():
    assert {"csv_roundtrip", "sql_pip"} <= set(catalog.QUERIES) and {files.__name__, more.__name__} <= {f.__module__ for f in catalog.QUERIES.values()}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalog.SQL) <= set(entry.queries())
