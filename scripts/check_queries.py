"""Run queries in Spark and their SQL twins in DuckDB and compare all rows.

    python scripts/check_queries.py [--sf DIR] [--time] [PREFIX ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys
import time
import traceback

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallyward.session import get_session  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("prefix", nargs="*")
    args = ap.parse_args()
    entry = importlib.import_module("__spark_entry__")
    spark = get_session()
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(os.listdir(args.sf)):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{args.sf}/{f}'")
    oracle = entry.oracle_sql()
    bad = []
    for name, fn in entry.queries().items():
        if args.prefix and not any(name.startswith(p) for p in args.prefix):
            continue
        t = time.time()
        try:
            df = fn(spark, args.sf)
            cols = sorted(df.columns)
            got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
            took = time.time() - t
            if name not in oracle:
                print(f"rows {name}: {len(got)} rows {took:.1f}s", flush=True)
                if not got:
                    bad.append(name)
                continue
            t = time.time()
            cur = con.execute(oracle[name])
            names = [d[0] for d in cur.description]
            kinds = {d[0]: str(d[1]) for d in cur.description}
            idx = [names.index(c) for c in sorted(names)]
            want = sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
            dt = time.time() - t
            if sorted(names) != cols:
                raise AssertionError(f"columns {cols} vs {sorted(names)}")
            same = {
                "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                "timestamp": "TIMESTAMP",
            }
            types = [
                f"{c}:{k}/{kinds[c]}" for c, k in df.dtypes if same.get(k, kinds[c]) != kinds[c]
            ]
            if got != want:
                diff = [(g, w) for g, w in zip(got, want) if g != w][:3]
                raise AssertionError(f"{len(got)} vs {len(want)} rows; {cols}; {diff}")
            if not got:
                raise AssertionError("no rows")
            print(f"ok   {name}: {len(got)} rows {took:.1f}s sql {dt:.1f}s {'TYPES ' + str(types) if types else ''}", flush=True)
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            text = str(e) if isinstance(e, AssertionError) else traceback.format_exc(limit=-3)
            print(f"BAD  {name}: {text[:1500]}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
