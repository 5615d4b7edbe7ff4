"""Run registered queries against their DuckDB oracles and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison: same column names; same row count; rows compared as sorted
multisets, columns in name order, with floats equal within 1e-9 relative
(and reported separately whether they are bit-for-bit equal).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "toArray"):
        return tuple(float(x) for x in v.toArray())
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return float(v)
    except Exception:
        pass
    return v


def _key(row):
    return tuple((x is None, repr(type(x)), x if not isinstance(x, float) or not math.isnan(x)
                  else float("inf")) for x in row)


def _close(a, b, tol=1e-9):
    if isinstance(a, float) and isinstance(b, float):
        if math.isnan(a) and math.isnan(b):
            return True
        return a == b or abs(a - b) <= tol * max(1.0, abs(a), abs(b))
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y, tol) for x, y in zip(a, b))
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return float(a) == float(b)
    return a == b


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"columns differ: {sorted(set(spark_cols) ^ set(duck_cols))}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if len(a) != len(b):
        return False, f"rows {len(a)} vs {len(b)}"
    exact = a == b
    bad = [(x, y) for x, y in zip(a, b) if not _close(x, y)]
    if bad:
        x, y = bad[0]
        diffs = [(order[i], p, q) for i, (p, q) in enumerate(zip(x, y)) if not _close(p, q)]
        return False, f"{len(bad)} rows differ, first: {diffs[:4]}"
    return True, "exact" if exact else "within tolerance"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from loadcast.session import local_session
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    failures = 0
    for name in names or list(qs):
        t = time.time()
        df = qs[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        ts = time.time() - t
        if name not in sqls:
            print(f"{name:24s} rows-only  {len(rows)} rows  spark {ts:.1f}s", flush=True)
            continue
        t = time.time()
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        td = time.time() - t
        ok, msg = compare(rows, df.columns, drows, dcols)
        failures += not ok
        print(f"{name:24s} {'OK  ' if ok else 'FAIL'} {msg}  ({len(rows)} rows, "
              f"spark {ts:.1f}s, duckdb {td:.1f}s)", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv))
