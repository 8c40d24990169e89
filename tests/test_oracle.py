"""Every registered query against its DuckDB oracle on sf0.001."""

import duckdb
import pytest

from quarry.plans.catalog import queries
from quarry.plans.oracle import oracle_sql
from tools.oracle_check import TABLES, rows


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_duckdb(spark, small_dir, con, name):
    got = rows(queries()[name](spark, small_dir).toPandas())
    want = rows(con.execute(oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
