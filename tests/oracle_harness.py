"""Run a registered query and its DuckDB twin; compare like the driver does.

Columns are sorted by name, rows compared as an order-insensitive multiset,
doubles rounded to 6 places.
"""

from __future__ import annotations

import math
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    ok = ok_cols and len(a) == len(b) and a == b
    detail = ""
    if not ok:
        if not ok_cols:
            detail = f"cols spark={scols} duck={dcols}"
        elif len(a) != len(b):
            detail = f"rows spark={len(a)} duck={len(b)}"
        else:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            detail = f"first diffs {diff}"
    return ok, len(a), t1 - t0, t2 - t1, detail
