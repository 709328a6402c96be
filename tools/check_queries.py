"""Compare registered queries with their SQL: python tools/check_queries.py [folder] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import namewire.plans.live_queries  # noqa: E402, F401
from namewire.plans.registry import ORACLE, QUERIES  # noqa: E402
from namewire.session import build_session  # noqa: E402

TABLES = ["events", "documents", "part", "orders", "lineitem", "conversations"]


def printed(value) -> str:
    if value is None or value != value:
        return "null"
    return f"{value:.6f}" if isinstance(value, float) else str(value)


def normal(frame):
    """Rows in an order-free form; numbers print the same in both engines, whole ones with nulls as floats."""
    frame = frame[sorted(frame.columns)]
    kinds = frame.dtypes
    for c in frame.columns:
        if kinds[c].kind == "f":
            frame[c] = frame[c].map(lambda v: "null" if v != v else f"{v:.6f}")
        else:
            frame[c] = frame[c].map(printed)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"create view {t} as from '{folder}/{t}.parquet'")
    bad = 0
    for name in names:
        began = time.time()
        try:
            ours = QUERIES[name](spark, folder).toPandas()
        except Exception as e:
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:1500]}")
            bad += 1
            continue
        took = time.time() - began
        if name not in ORACLE:
            print(f"rows {name}: {len(ours)} rows, {took:.1f}s")
            continue
        try:
            theirs = duck.sql(ORACLE[name]).df()
        except Exception as e:
            print(f"SQL  {name}: {str(e)[:800]}")
            bad += 1
            continue
        mixed = {c: (str(ours.dtypes[c]), str(theirs.dtypes[c])) for c in ours.columns
                 if c in theirs.columns and str(ours.dtypes[c]).lower() != str(theirs.dtypes[c]).lower()}
        if mixed:
            print(f"types {name}: {mixed}")
        a, b = normal(ours), normal(theirs)
        same = a.shape == b.shape and list(a.columns) == list(b.columns) and a.equals(b)
        print(f"{'ok  ' if same else 'DIFF'} {name}: {len(a)} / {len(b)} rows, {took:.1f}s", flush=True)
        if not same:
            bad += 1
            print(list(a.columns), list(b.columns), dict(ours.dtypes), dict(theirs.dtypes))
            if a.shape == b.shape:
                off = (a != b).any(axis=1)
                print(a[off].head(3).to_string(), b[off].head(3).to_string(), sep="\n")
            else:
                print(a.head(3).to_string(), b.head(3).to_string(), sep="\n")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
