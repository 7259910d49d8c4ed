"""Every registered query against its SQL oracle (DuckDB) on the driver tables; queries without
an oracle are checked for rows. Set LEDGERFLOW_TEST_SF to choose the scale (default sf0.001)."""

import os

import duckdb
import pytest

from ledgerflow.plans import catalog
from ledgerflow.sources.tables import DRIVER_TABLES
from tools.check import rows_of

SF = os.environ.get("LEDGERFLOW_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got is not None
        return
    res = duck.execute(sql)
    want_cols = [d[0] for d in res.description]
    assert sorted(got_cols) == sorted(want_cols)
    assert rows_of(got_cols, got) == rows_of(want_cols, res.fetchall())
