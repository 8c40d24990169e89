"""Local correctness check: every registered query against its DuckDB oracle.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Compares column names, row counts and sorted rows (floats rounded).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from quarry.plans.catalog import queries  # noqa: E402
from quarry.plans.oracle import oracle_sql  # noqa: E402
from quarry.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "nan"  # pandas has nulls of numbers as NaN
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return int(v) if v.is_integer() else round(v, 6)  # a column of numbers with nulls is float in pandas
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(out, key=repr)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sp = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:32s} rows={len(sp)} (no oracle) {ts:.1f}s")
            continue
        t1 = time.time()
        try:
            dd = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        td = time.time() - t1
        c1, r1 = rows(sp)
        c2, r2 = rows(dd)
        t1 = {c: str(sp[c].dtype) for c in sp.columns}
        t2 = {c: str(dd[c].dtype) for c in dd.columns}
        if t1 != t2:
            print(f"{name:32s} dtype difference: spark {t1} duckdb {t2}")
        ok = c1 == c2 and r1 == r2
        if not ok:
            bad += 1
            diff = [r for r in r1 if r not in set(r2)][:3] if c1 == c2 else []
            print(f"{name:32s} MISMATCH cols {c1} vs {c2}; rows {len(r1)} vs {len(r2)}; e.g. {diff}")
            if c1 == c2:
                print("   oracle-only:", [r for r in r2 if r not in set(r1)][:3])
        else:
            print(f"{name:32s} ok rows={len(r1)} spark {ts:.1f}s duckdb {td:.1f}s")
    print("FAILED" if bad else "ALL OK", bad)
    spark.stop()


if __name__ == "__main__":
    main()
