"""The SQL of the operators whose other tests are brute-force versions."""

import duckdb
import pytest
from quarry.llm.queries import ORACLE_SQL, QUERIES

from tools.oracle_check import rows


def table(pdf):
    names, got = rows(pdf)
    return names, sorted(([None if v == "nan" or v != v or v is None else v for v in r] for r in got), key=repr)


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op12_merkle_manifest", "op13_warc_round_trip"])
def test_matches_duckdb(spark, small_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    got, want = table(QUERIES[name](spark, small_dir).toPandas()), table(con.execute(ORACLE_SQL[name]).df().astype(object))
    assert got[0] == want[0] and len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]
