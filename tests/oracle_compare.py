"""Run a registered query in Spark and its oracle SQL in DuckDB; compare results.

Row count, column names, column types and an order-insensitive multiset of
normalised rows must agree.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_SPARK_TO_DUCK = {
    "LongType()": "BIGINT", "IntegerType()": "INTEGER", "StringType()": "VARCHAR",
    "DateType()": "DATE", "DoubleType()": "DOUBLE", "BooleanType()": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _spark_type(dt_) -> str:
    s = repr(dt_)
    if s.startswith("DecimalType"):
        return f"DECIMAL({dt_.precision},{dt_.scale})"
    return _SPARK_TO_DUCK.get(s, s)


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return (type(v).__name__, v)


def _key(row) -> tuple:
    return tuple(_norm(v) for v in row)


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    import __spark_entry__ as E
    df = E.queries()[name](spark, sf_dir)
    sql = E.oracle_sql()[name]
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    s_cols = df.columns
    s_types = [_spark_type(f.dataType) for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    else:
        st = dict(zip(s_cols, s_types))
        dtps = dict(zip(d_cols, d_types))
        bad = {c: (st[c], dtps[c]) for c in s_cols if st[c] != dtps[c]}
        if bad:
            problems.append(f"types {bad}")
        if len(s_rows) != len(d_rows):
            problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        sk = sorted(_key([r[i] for i in si]) for r in s_rows)
        dk = sorted(_key([r[i] for i in di]) for r in d_rows)
        if sk != dk:
            diff = [(a, b) for a, b in zip(sk, dk) if a != b][:3]
            problems.append(f"values differ, first: {diff}")
    return (not problems, "; ".join(problems) or f"ok rows={len(s_rows)}")


if __name__ == "__main__":
    import time
    from martforge.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark()
    import __spark_entry__ as E
    con = duck(sf)
    bad = 0
    for n in names or list(E.queries()):
        t = time.time()
        try:
            ok, msg = compare(spark, n, sf, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {n} ({time.time() - t:.1f}s) {msg}", flush=True)
    print("failures:", bad)
