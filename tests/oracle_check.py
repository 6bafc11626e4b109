"""Run registered queries in Spark and their SQL in DuckDB; compare.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares column names, row counts and the sorted multiset of rows (floats
rounded to 9 significant digits).  Prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark, sf: str, name: str, fn, sql: str | None, con) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    t_spark = time.time() - t0
    if sql is None:
        return True, f"rows={len(srows)} (no oracle) {t_spark:.1f}s"
    res = con.execute(sql.replace("/root/testdata/sf0.01", sf.rstrip("/")))
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    if sorted(dcols) != cols:
        return False, f"columns differ spark={cols} duck={sorted(dcols)}"
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows_raw]
    if len(srows) != len(drows):
        return False, f"rows spark={len(srows)} duck={len(drows)}"
    a, b = sorted(srows, key=_key), sorted(drows, key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first diff spark={x} duck={y}"
    return True, f"rows={len(srows)} {t_spark:.1f}s"


def main(argv: list[str]) -> int:
    import __spark_entry__ as E
    from tidemark.session import get_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session("local[8]", 8)
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            ok, msg = compare(spark, sf, name, fn, sqls.get(name), con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: {msg}", flush=True)
    total = len([n for n in qs if not names or n in names])
    print(f"{total - bad}/{total} match", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
