"""Side-by-side check of a Spark query against its DuckDB twin.

Mirrors the driver's gate: row count, column names, and an order-insensitive
hash of the values (columns sorted by name).  Floats are compared exactly and,
failing that, after rounding to 9 significant digits so float noise can be
told apart from real differences.

    python -m tessera.checks.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

from tessera.sources.tables import TABLES, table_path


def _norm(v, sig: int | None):
    if v is None:
        return "∅"
    if isinstance(v, float) and math.isnan(v):
        return "∅"
    if isinstance(v, (bool,)):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(v) if sig is None else f"{v:.{sig}g}"
    if isinstance(v, (dt.datetime,)):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x, sig) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), sig)
    return str(v)


def digest(columns, rows, sig=None) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i], sig) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare_one(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols),
           "spark_sec": round(t1 - t0, 2), "duck_sec": round(t2 - t1, 2)}
    out["exact"] = out["cols_match"] and digest(scols, srows) == digest(dcols, drows)
    out["close"] = out["cols_match"] and digest(scols, srows, 9) == digest(dcols, drows, 9)
    if not out["cols_match"]:
        out["spark_cols"] = scols
        out["duck_cols"] = dcols
    return out


def main(argv):
    from tessera.catalog import QUERIES
    from tessera.checks.oracle_sql import ORACLE
    from tessera.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    bad = 0
    for name in names:
        sql = ORACLE.get(name)
        if sql is None:
            n = QUERIES[name](spark, sf_dir).count()
            print(f"{name:28s} rows-only spark_rows={n}")
            continue
        try:
            r = compare_one(spark, con, name, QUERIES[name], sql, sf_dir)
        except Exception as e:  # report and continue with the next query
            bad += 1
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = r["exact"] and r["spark_rows"] == r["duck_rows"]
        bad += 0 if ok else 1
        print(f"{name:28s} {'OK   ' if ok else 'FAIL '} {r}")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
