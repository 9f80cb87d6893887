"""Run catalogue queries in Spark and their oracle SQL in DuckDB; compare
row count, column names and the order-insensitive multiset of rows."""

from __future__ import annotations

import argparse
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from lifetab.plans import catalog  # noqa: E402
from lifetab.plans.tables import TABLES  # noqa: E402
from lifetab.session import get_spark  # noqa: E402


def canon(v):
    if isinstance(v, float):
        if v != v:
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return repr(v)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--small-rows", default=None, help="lifetab.ordered.smallRows (0 forces bucketed paths)")
    args = ap.parse_args()
    spark = get_spark()
    if args.small_rows is not None:
        spark.conf.set("lifetab.ordered.smallRows", args.small_rows)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    names = args.names or list(catalog.QUERIES)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = catalog.QUERIES[name](spark, args.sf)
            cols = sdf.columns
            srows = [tuple(canon(r[c]) for c in sorted(cols)) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = catalog.SQL.get(name)
        if sql is None:
            print(f"{name}: rows-only {len(srows)} ({ts:.1f}s)")
            continue
        try:
            rel = con.execute(sql)
            dcols = [d[0] for d in rel.description]
            drows_raw = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: DUCKDB ERROR {str(e)[:400]}")
            bad += 1
            continue
        idx = {c: i for i, c in enumerate(dcols)}
        if sorted(dcols) != sorted(cols):
            print(f"{name}: COLUMNS differ spark={sorted(cols)} duck={sorted(dcols)}")
            bad += 1
            continue
        drows = [tuple(canon(r[idx[c]]) for c in sorted(cols)) for r in drows_raw]
        ok = sorted(srows) == sorted(drows)
        if not ok:
            bad += 1
            ss, dd = set(srows), set(drows)
            print(f"{name}: MISMATCH spark={len(srows)} duck={len(drows)} cols={sorted(cols)}")
            print("  only spark:", sorted(ss - dd)[:3])
            print("  only duck :", sorted(dd - ss)[:3])
        else:
            print(f"{name}: OK {len(srows)} rows ({ts:.1f}s)")
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
