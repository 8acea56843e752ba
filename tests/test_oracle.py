"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
QUERIES = {k: f for k, f in entry.queries().items() if k in entry.QUERIES}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_orders" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(SQL[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
