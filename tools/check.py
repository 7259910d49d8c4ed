"""Run registered queries on Spark and their oracle SQL on DuckDB; compare rows order-insensitively.

usage: python tools/check.py [name ...] [--sf DIR]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerflow.plans import catalog  # noqa: E402
from ledgerflow.session import get_session  # noqa: E402
from ledgerflow.sources.tables import DRIVER_TABLES  # noqa: E402


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.11g}"  # NaN is not null; sums may differ in the last digits only
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.11g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(canon(x)) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(canon(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    names = args.names or list(qs)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sdf = qs[n](spark, args.sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        el = time.time() - t0
        if n not in sqls:
            print(f"ROWS {n}: {len(srows)} rows (no oracle) {el:.1f}s")
            continue
        try:
            res = con.execute(sqls[n])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {n}: columns {sorted(scols)} vs {sorted(dcols)}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a == b:
            print(f"OK   {n}: {len(a)} rows {el:.1f}s")
        else:
            bad += 1
            sa, sb = set(a), set(b)
            print(f"FAIL {n}: {len(a)} vs {len(b)} rows; spark-only {list(sa - sb)[:3]} duck-only {list(sb - sa)[:3]}")
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
