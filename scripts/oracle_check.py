"""Run queries in Spark and their oracle SQL in DuckDB; compare.

usage: python scripts/oracle_check.py [sf_dir] [name ...]
Compares row count, sorted column names and an order-insensitive hash of
the values (doubles rounded to 6 decimals).
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from kestrel.plans.registry import all_queries  # noqa: E402
from kestrel.session import build_session  # noqa: E402
from kestrel.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        r = round(v, 6)
        return repr(0.0 if r == 0 else r)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    qs = all_queries()
    if os.environ.get("ORACLE_CHECK_DEFAULT_SESSION"):
        # like the driver: Spark defaults (200 shuffle partitions, no checkpoint folder)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    results = {}
    for name, q in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
            ts = time.time() - t0
        except Exception as e:  # noqa: BLE001
            results[name] = {"status": "spark_error", "error": str(e)[:400]}
            print(name, "SPARK ERROR", str(e)[:400], flush=True)
            continue
        if not q.oracle:
            results[name] = {"status": "rows_only", "rows": len(rows), "sec": round(ts, 2)}
            print(f"{name}: rows-only {len(rows)} rows {ts:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(q.oracle)
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = {"status": "oracle_error", "error": str(e)[:400]}
            print(name, "ORACLE ERROR", str(e)[:400], flush=True)
            continue
        hs, ls = digest(cols, rows)
        ho, lo = digest(ocols, orows)
        ok = (len(rows) == len(orows)) and sorted(cols) == sorted(ocols) and hs == ho
        results[name] = {"status": "match" if ok else "MISMATCH", "rows": len(rows), "oracle_rows": len(orows),
                         "sec": round(ts, 2)}
        print(f"{name}: {'ok' if ok else 'MISMATCH'} spark={len(rows)} oracle={len(orows)} {ts:.1f}s", flush=True)
        if not ok:
            print("  cols", sorted(cols), sorted(ocols))
            a, b = set(ls), set(lo)
            print("  only spark:", sorted(a - b)[:5])
            print("  only oracle:", sorted(b - a)[:5])
    print(json.dumps({k: v["status"] for k, v in results.items()}))
    print("total spark sec", round(sum(v.get("sec", 0) for v in results.values()), 1))


if __name__ == "__main__":
    main()
