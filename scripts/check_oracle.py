"""Run every registered query on Spark and its oracle on DuckDB; compare.

    python scripts/check_oracle.py [sf_dir] [name-substring ...]

Compares row count, column names and the sorted rows (values as text).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from beatline.plans.registry import QUERIES  # noqa: E402
from beatline.session import get_spark  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(df):
    df = df[sorted(df.columns)]
    rows = [tuple("None" if v is None or (isinstance(v, float) and v != v) else str(v)
                  for v in r) for r in df.itertuples(index=False)]
    return sorted(rows)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, q in QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sp = q.run(spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:34s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.oracle is None:
            print(f"{name:34s} rows={len(sp):6d} (no oracle) {ts:5.1f}s")
            continue
        try:
            dk = con.execute(q.oracle).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:34s} DUCKDB ERROR {str(e)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(sp.columns) == sorted(dk.columns)
        a, b = canon(sp), canon(dk) if ok_cols else []
        ok = ok_cols and len(sp) == len(dk) and a == b
        if not ok:
            bad += 1
            print(f"{name:34s} MISMATCH rows {len(sp)} vs {len(dk)} cols_ok={ok_cols}")
            if not ok_cols:
                print("   spark:", sorted(sp.columns), "\n   duck:", sorted(dk.columns))
            else:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                for x, y in diff:
                    print("   S:", x, "\n   D:", y)
        else:
            print(f"{name:34s} ok rows={len(sp):6d} {ts:5.1f}s")
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
