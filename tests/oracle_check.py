"""Run registered queries in Spark and their DuckDB twins; compare results.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
Comparison: same column names, same row count, same multiset of rows after
sorting columns by name (floats compared at 1e-6).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, round(v, 6))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (1, v)


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(None if (isinstance(x, float) and math.isnan(x)) else x) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark_pdf, duck_pdf):
    c1, r1 = rows_of(spark_pdf)
    c2, r2 = rows_of(duck_pdf)
    if c1 != c2:
        return f"columns differ: {c1} vs {c2}"
    if len(r1) != len(r2):
        return f"row count differs: {len(r1)} vs {len(r2)}"
    bad = 0
    first = None
    for a, b in zip(r1, r2):
        for x, y in zip(a, b):
            if x == y:
                continue
            if isinstance(x[1], float) and isinstance(y[1], (float, int)) and abs(x[1] - y[1]) <= 1.5e-6:
                continue
            if isinstance(y[1], float) and isinstance(x[1], (float, int)) and abs(x[1] - y[1]) <= 1.5e-6:
                continue
            bad += 1
            first = first or (a, b)
            break
    return None if bad == 0 else f"{bad} rows differ, e.g. {first}"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from cohort_engine.session import local_session
    import __spark_entry__ as E
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    failed = []
    for name in names or list(qs):
        t = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            failed.append(name)
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            continue
        ts = time.time() - t
        if name not in sqls:
            print(f"rows {name}: {len(sp)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            dk = con.execute(sqls[name]).fetchdf()
        except Exception as e:  # noqa: BLE001
            failed.append(name)
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            continue
        msg = compare(sp, dk)
        if msg:
            failed.append(name)
            print(f"FAIL {name}: {msg}")
        else:
            print(f"ok   {name}: {len(sp)} rows ({ts:.1f}s)")
    print("FAILED:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
