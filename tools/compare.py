"""Run registered queries on Spark and their SQL checks on DuckDB; compare.

usage: python tools/compare.py [sf_dir] [query ...]
Prints one line per query: ok / MISMATCH with row counts.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from personalens.plans.registry import all_queries  # noqa: E402
from personalens.session import get_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6)) if os.environ.get("STRICT_FLOATS") else repr(round(v, 6) + 0.0)
    return repr(v)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    qs = all_queries()
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            srows = q.run(spark, sf_dir).collect()
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-ERROR {name}: {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        sql = q.sql()
        if sql is None:
            print(f"rows-only {name}: {len(srows)} rows  spark {t1 - t0:.1f}s")
            continue
        try:
            drows = con.execute(sql).fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"DUCK-ERROR {name}: {str(e)[:400]}")
            bad += 1
            continue
        s = sorted(tuple(norm(v) for v in r) for r in srows)
        d = sorted(tuple(norm(v) for v in r) for r in drows)
        if s == d:
            print(f"ok {name}: {len(s)} rows  spark {t1 - t0:.1f}s")
        else:
            bad += 1
            print(f"MISMATCH {name}: spark {len(s)} duck {len(d)}")
            ss, dd = set(s), set(d)
            only_s = sorted(ss - dd)[:3]
            only_d = sorted(dd - ss)[:3]
            cols = [c for c, _ in q.spec]
            for r in only_s:
                print("  spark-only", dict(zip(cols, r)))
            for r in only_d:
                print("  duck-only ", dict(zip(cols, r)))
            for a, b in zip(only_s, only_d):
                print("  differs:", {c: (x, y) for c, x, y in zip(cols, a, b) if x != y})
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
