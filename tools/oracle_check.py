"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    import datetime as dt
    import decimal
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


# DuckDB result type -> Spark simple type string (anything else is a mismatch).
DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def compare(spark, con, name, build, sql, sf_dir):
    t0 = time.time()
    sdf = build(spark, sf_dir)
    s_rows = sdf.collect()
    t1 = time.time()
    s_cols = sdf.columns
    s_types = dict(sdf.dtypes)
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    status = "OK"
    detail = ""
    type_diff = [(c, s_types.get(c), d_types.get(c)) for c in d_cols
                 if DUCK_TO_SPARK.get(d_types.get(c)) != s_types.get(c)]
    if sorted(s_cols) != sorted(d_cols):
        status = "SCHEMA"
        detail = f"spark={sorted(s_cols)} duck={sorted(d_cols)}"
    elif type_diff:
        status = "TYPES"
        detail = f"{type_diff}"
    elif len(s_rows) != len(d_rows):
        status = "ROWS"
        detail = f"spark={len(s_rows)} duck={len(d_rows)}"
    else:
        a = rows_of(s_cols, [tuple(r) for r in s_rows])
        b = rows_of(d_cols, d_rows)
        if a != b:
            status = "VALUES"
            diffs = [(x, y) for x, y in zip(a, b) if x != y]
            detail = f"{len(diffs)} differing rows; first: spark={diffs[0][0]} duck={diffs[0][1]}"
    return status, len(s_rows), t1 - t0, t2 - t1, detail


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from gridmix.session import get_session
    from gridmix.plans.registry import oracle, queries
    spark = get_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = queries(), oracle()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:34s} NO-ORACLE")
            continue
        try:
            status, n, ts, td, detail = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            status, n, ts, td, detail = "ERROR", 0, 0, 0, repr(e)[:400]
        bad += status != "OK"
        print(f"{name:34s} {status:7s} rows={n:<7d} spark={ts:6.2f}s duck={td:6.2f}s {detail}")
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
