"""Run registered queries against their DuckDB twins (same compare as the gate).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_raw = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if not sql:
        return dict(name=name, rows=len(s_raw), oracle=None, ok=None, sec=round(t1 - t0, 2))
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_raw = cur.fetchall()
    s_cols, s_rows = _rows(sdf.columns, s_raw)
    d_cols, d_rows = _rows(d_names, d_raw)
    ok = s_cols == d_cols and s_rows == d_rows
    info = dict(name=name, rows=len(s_rows), oracle_rows=len(d_rows), ok=ok, sec=round(t1 - t0, 2))
    if s_cols != d_cols:
        info["cols"] = (s_cols, d_cols)
    elif not ok:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:2]
        info["diff"] = diff
    return info


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from barforge.session import build_session
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    spark = build_session("local[8]", driver_memory=os.environ.get("CHECK_DRIVER_MEMORY", "8g"))
    con = duck(sf_dir)
    q, o = queries(), oracle_sql()
    bad = 0
    for name in names or list(q):
        try:
            info = compare(spark, con, name, q[name], o.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            info = dict(name=name, ok=False, error=str(e)[:600])
        bad += info.get("ok") is False
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
