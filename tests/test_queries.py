"""Every query that has an oracle, against DuckDB on the small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CORE = [n for n in entry.core.QUERIES]


def rows(found, columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in found)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    found = entry.queries()[name](spark, SF)
    columns = sorted(found.columns)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == columns
    assert rows(found.collect(), columns) == sorted(map(repr, want.select(*[f'"{c}"' for c in columns]).fetchall()))


def test_entry(spark):
    if os.path.isdir("/root/testdata/sf0.001"):
        assert entry.entry(spark).count() > 0
