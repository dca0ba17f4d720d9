"""Compare registered Spark queries with their DuckDB oracles.

Usage: python tests/compare.py [sf_dir] [name-prefix ...]
Checks row count, column names and an order-insensitive multiset of exact
values (floats compared exactly, then reported with their largest relative
difference when they are not bit-equal).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _key(row):
    return tuple((v is None, str(type(v)), v if not isinstance(v, (list, dict)) else str(v))
                 for v in row)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return [cols[i] for i in order], out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    status = "MATCH"
    detail = ""
    if sc != dc:
        status, detail = "COLS", f"spark={sc} duck={dc}"
    elif len(sr) != len(dr):
        status, detail = "ROWS", f"spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        worst = 0.0
        exact = True
        for a, b in zip(sr, dr):
            for x, y in zip(a, b):
                if x == y:
                    continue
                if isinstance(x, (int, float)) and isinstance(y, (int, float)):
                    rel = abs(x - y) / max(abs(x), abs(y), 1e-300)
                    worst = max(worst, rel)
                    exact = False
                else:
                    exact = None
                    detail = f"first diff: {a} vs {b}"
                    break
            if exact is None:
                break
        status = "VALUES" if exact is None else "FLOATDIFF"
        if exact is not None:
            detail = f"max rel diff {worst:.3g}"
    return status, detail, len(sr), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    prefixes = argv[2:]
    from pyspark.sql import SparkSession
    import __spark_entry__ as entry
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        sql = oracles.get(name)
        if sql is None:
            df = fn(spark, sf_dir)
            print(f"{name:34s} NO-ORACLE rows={df.count()}")
            continue
        try:
            status, detail, n, secs = compare(spark, con, name, fn, sql, sf_dir)
        except Exception as e:  # report and continue
            status, detail, n, secs = "ERROR", repr(e)[:300], -1, 0.0
        bad += status != "MATCH"
        print(f"{name:34s} {status:9s} rows={n:<6d} {secs:6.2f}s {detail}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
