"""Run ``queries()`` in Spark and ``oracle_sql()`` in DuckDB and compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive multiset of rows
(floats rounded to 6 digits).
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "item"):
        v = v.item()
        if isinstance(v, float):
            return round(v, 6)
    return v


def rows_of(df_pd):
    cols = sorted(df_pd.columns)
    out = []
    for rec in df_pd[cols].itertuples(index=False):
        out.append(tuple("<null>" if (x is None or (isinstance(x, float) and x != x)) else _norm(x) for x in rec))
    return cols, sorted(out, key=repr)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from pilecall.session import local_session

    spark = local_session(8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"{name}: rows={len(sp)} (no oracle) spark={t1 - t0:.1f}s")
            continue
        try:
            dk = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: DUCKDB ERROR {str(e)[:400]}")
            bad += 1
            continue
        c1, r1 = rows_of(sp)
        c2, r2 = rows_of(dk)
        ok = c1 == c2 and r1 == r2
        bad += not ok
        print(f"{name}: {'OK' if ok else 'MISMATCH'} spark_rows={len(r1)} duck_rows={len(r2)} spark={t1 - t0:.1f}s")
        if not ok:
            if c1 != c2:
                print("   cols", c1, c2)
            else:
                s1, s2 = set(r1), set(r2)
                print("   only spark:", list(s1 - s2)[:3])
                print("   only duck: ", list(s2 - s1)[:3])
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
