"""Run registered Spark queries and their DuckDB oracle side by side and
compare row count, column names and the multiset of normalised rows.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.sql(f"create view {t} as select * from read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return ("f", round(v, 6))
    if isinstance(v, Decimal):
        return ("n", str(v.normalize()) if v == v.to_integral() or True else str(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("n", str(Decimal(v).normalize()))
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("t", dt.datetime(v.year, v.month, v.day).isoformat())
    return ("s", str(v))


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res["duck_rows"] = len(d_rows)
    res["duck_sec"] = round(time.time() - t1, 2)
    if sorted(c.lower() for c in s_cols) != sorted(c.lower() for c in d_cols):
        res["status"] = f"COLUMNS {sorted(s_cols)} vs {sorted(d_cols)}"
        return res
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i].lower())
    d_index = {c.lower(): i for i, c in enumerate(d_cols)}
    d_order = [d_index[s_cols[i].lower()] for i in order]
    a = Counter(tuple(norm(r[i]) for i in order) for r in s_rows)
    b = Counter(tuple(norm(r[i]) for i in d_order) for r in d_rows)
    if a == b:
        res["status"] = "OK"
    else:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        res["status"] = "MISMATCH"
        res["cols"] = [s_cols[i] for i in order]
        res["only_spark"] = only_s
        res["only_duck"] = only_d
        res["n_diff"] = sum((a - b).values())
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from kredex.session import build_local
    spark = build_local(8)
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, sf_dir, name, qs[name], oracle.get(name))
        except Exception as e:  # report and go on
            r = {"query": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("OK", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
