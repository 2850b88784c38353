"""Every registered key against its SQL oracle (DuckDB) on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tools.check_oracles import TABLES, rows_key

from quayside.plans import registry

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_key_has_an_oracle():
    # Keys without SQL would only get a row-count check.
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, con, sf_small, key):
    df = QUERIES[key](spark, sf_small)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert rows_key(cols, rows) == rows_key(ocols, orows)
