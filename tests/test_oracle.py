"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from shelfwise.plans import registry
from shelfwise.plans.bindings import TABLES
from tools.check_oracle import rows_of

SF = "/root/testdata/sf0.001"
registry.load_all()
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 1
    assert "total_productos" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.sql(E.oracle_sql()[name])
    want = rows_of(res.columns, res.fetchall())
    assert sorted(df.columns) == sorted(res.columns)
    assert got == want
