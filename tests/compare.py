"""Run queries against their oracle SQL: ``python tests/compare.py [sf] [name...]``."""

import glob
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows(columns, records):
    """Sorted rows with columns by name; numbers compare by value."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if value is None or (isinstance(value, float) and pd.isna(value)):
            return None
        if isinstance(value, bool) or isinstance(value, str):
            return value
        return float(value)

    table = [tuple(cell(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(table, key=repr)


def compare(spark, con, query, sql, folder):
    df = query(spark, folder)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want = rows([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for g, w in zip(got[1], want[1]):
        if g != w:
            at = [i for i, (a, b) in enumerate(zip(g, w)) if a != b]
            show = lambda r: [str(x)[:150] for x in r]
            return f"first difference in {[got[0][i] for i in at]}:\n   got {show(g)}\n  want {show(w)}"
    return None


if __name__ == "__main__":
    from conftest import session

    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    folder = f"/root/testdata/sf{sf}"
    con, spark, oracles = connect(folder), session(), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, query, oracles[name], folder) if name in oracles else "no oracle"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
