"""Run a catalog query in Spark and its SQL twin in DuckDB, and compare.

The comparison is strict: same column names (order ignored), same row
count and, after sorting rows, equal values (floats compared exactly after
normalising -0.0 and NaN).  Usage::

    python -m tests.oracle_harness /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

from trendlake.sources.testdata import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(v + 0.0))
    if isinstance(v, dt.datetime):
        return (1, v.isoformat(sep=" "))
    if isinstance(v, dt.date):
        return (1, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (1, repr([_norm(x) for x in v]))
    if hasattr(v, "tolist"):
        return (1, repr([_norm(x) for x in v.tolist()]))
    if isinstance(v, bool):
        return (1, str(int(v)))
    return (1, str(v))


def rows_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect())


def rows_duck(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted(tuple(_norm(r[i]) for i in idx) for r in data)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    sc, sr = rows_spark(df)
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(sr), "spark_s": round(t1 - t0, 2)}
    dc, dr = rows_duck(con, sql)
    res = {"name": name, "rows": len(sr), "duck_rows": len(dr), "spark_s": round(t1 - t0, 2)}
    if sc != dc:
        res.update(ok=False, why=f"columns {sc} != {dc}")
    elif len(sr) != len(dr):
        res.update(ok=False, why="row count")
    elif sr != dr:
        bad = next(i for i, (a, b) in enumerate(zip(sr, dr)) if a != b)
        res.update(ok=False, why=f"values differ at {bad}: {sr[bad]} vs {dr[bad]}")
    else:
        res.update(ok=True)
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from trendlake.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], oracle.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
