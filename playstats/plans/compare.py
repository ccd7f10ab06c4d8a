"""Compare a Spark result with the DuckDB oracle's: column names, row
count, and the rows as a multiset (doubles rounded to 6 places)."""

from __future__ import annotations

import datetime as dt
import math
import os

from playstats.plans.fixtures import TABLES


def normalize(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(normalize(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return normalize(v.item())
    return v


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def compare_frames(sdf, con, sql: str) -> list[str]:
    """Problems found (empty when the results agree)."""
    s_cols = list(sdf.columns)
    s_rows = [tuple(normalize(v) for v in r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = [tuple(normalize(v) for v in r) for r in rel.fetchall()]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        return [f"columns spark={s_cols} duck={d_cols}"]
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    else:
        a = sorted(s_rows, key=_key)
        b = sorted(d_rows, key=_key)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            problems.append(f"{len(diff)} rows differ, e.g. spark={diff[0][0]} duck={diff[0][1]}")
    return problems
