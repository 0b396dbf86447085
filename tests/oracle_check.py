"""Run a registered query in Spark and its oracle in DuckDB; compare order-insensitively.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidemill.sources.tables import TABLES, table_path  # noqa: E402


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = table_path(sf_dir, t)
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 4):.4f}"
    if isinstance(v, decimal.Decimal):
        return f"{round(float(v), 4):.4f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    rows = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted(tuple(_norm(r[i]) for i in idx) for r in rows)


def compare(spark, key, sf_dir, con=None):
    from tidemill.plans import registry
    q = registry.queries()[key]
    sql = registry.oracle_sql().get(key)
    t0 = time.time()
    scols, srows = spark_rows(q(spark, sf_dir))
    t1 = time.time()
    out = {"key": key, "spark_rows": len(srows), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        out["oracle"] = None
        return out
    con = con or duck_connection(sf_dir)
    dcols, drows = duck_rows(con, sql)
    out.update(duck_rows=len(drows), duck_s=round(time.time() - t1, 2),
               cols_match=scols == dcols, values_match=srows == drows)
    if scols != dcols:
        out["spark_cols"], out["duck_cols"] = scols, dcols
    elif srows != drows:
        sset, dset = set(srows), set(drows)
        out["only_spark"] = sorted(sset - dset)[:3]
        out["only_duck"] = sorted(dset - sset)[:3]
    return out


if __name__ == "__main__":
    from tidemill.session import build_session
    from tidemill.plans import registry
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or sorted(registry.queries())
    spark = build_session("local[8]", 8)
    con = duck_connection(sf)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf, con)
        except Exception as e:  # report and continue
            r = {"key": k, "error": repr(e)[:600]}
        ok = r.get("values_match", r.get("oracle", 1) is None and "error" not in r)
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
