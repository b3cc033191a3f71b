"""Every registered query with SQL gives the same values as DuckDB at the smallest scale."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry
import check

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def test_flagship_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(FOLDER))
    got = check.normal(df.columns, [tuple(check._plain(v) for v in r) for r in df.collect()])
    relation = duck.execute(entry.oracle_sql()[name])
    want = check.normal([d[0] for d in relation.description], relation.fetchall())
    assert got == want
