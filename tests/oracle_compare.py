"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the correctness gate: same column names, same row count and the
same multiset of rows (columns sorted by name; floats compared after
rounding to 9 significant digits). Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0:
            return 0.0
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=_key)


def compare(spark, sf_dir: str, key: str, con=None) -> tuple[bool, str]:
    from feedlake.plans.registry import ORACLE, QUERIES

    con = con or duck(sf_dir)
    df = QUERIES[key](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_names, s_vals = rows_of(df.columns, s_rows)
    if key not in ORACLE:
        return True, f"rows-only {len(s_rows)} rows"
    res = con.execute(ORACLE[key])
    d_names = [d[0] for d in res.description]
    d_names, d_vals = rows_of(d_names, res.fetchall())
    if s_names != d_names:
        return False, f"columns differ: spark={s_names} oracle={d_names}"
    if len(s_vals) != len(d_vals):
        return False, f"row count spark={len(s_vals)} oracle={len(d_vals)}"
    if s_vals != d_vals:
        diffs = [(a, b) for a, b in zip(s_vals, d_vals) if a != b][:3]
        return False, f"values differ ({sum(a != b for a, b in zip(s_vals, d_vals))} rows), e.g. {diffs}"
    return True, f"{len(s_vals)} rows"


def main(argv):
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    from feedlake.plans.registry import QUERIES, load_all
    from feedlake.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    load_all()
    keys = argv[2:] or sorted(QUERIES)
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            ok, msg = compare(spark, sf_dir, k, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {k:28s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
