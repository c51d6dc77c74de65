"""Compare registered Spark queries with their DuckDB oracle SQL.

Usable from pytest and from the command line:
    python tests/oracle_check.py [sf_dir] [key ...]
Checks row count, column names and an order-insensitive multiset of values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return str(v)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    res = {"key": name, "spark_s": round(t1 - t0, 2), "rows": (len(s_rows), len(d_rows))}
    if sorted(s_cols) != sorted(d_cols):
        res["ok"] = False
        res["why"] = f"columns {sorted(s_cols)} vs {sorted(d_cols)}"
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_idx = {c: i for i, c in enumerate(d_cols)}
    s_set = Counter(tuple(r[i] for i in order) for r in s_rows)
    d_set = Counter(tuple(r[d_idx[s_cols[i]]] for i in order) for r in d_rows)
    res["ok"] = s_set == d_set
    if not res["ok"]:
        only_s = list((s_set - d_set).elements())[:3]
        only_d = list((d_set - s_set).elements())[:3]
        res["why"] = f"cols={[s_cols[i] for i in order]} spark-only={only_s} oracle-only={only_d}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from lakelayer.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]")
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in os_:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS-ONLY {name}: {n} rows ({time.time() - t0:.1f}s)", flush=True)
            continue
        try:
            r = compare(spark, con, name, fn, os_[name], sf_dir)
        except Exception as exc:  # report and go on
            r = {"key": name, "ok": False, "why": f"{type(exc).__name__}: {str(exc)[:600]}"}
        bad += not r["ok"]
        print(("OK   " if r["ok"] else "FAIL ") + str(r), flush=True)
    print(f"{len(qs)} keys, {bad} failing", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
