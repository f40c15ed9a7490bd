"""Run registered queries in Spark and their oracle SQL in DuckDB on the same
tables, and compare row count, column names and an order-insensitive hash of
the values. Usage: ``python tests/oracle_check.py [sf_dir] [key ...]``."""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return str(int(v))
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest()


def compare(spark, con, key: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t_spark = time.time() - t0
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out["oracle_rows"] = len(d_rows)
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    out["hash_match"] = out["cols_match"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    if out["cols_match"] and not out["hash_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        a = sorted("|".join(_norm(r[i]) for i in order_s) for r in s_rows)
        b = sorted("|".join(_norm(r[i]) for i in order_d) for r in d_rows)
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
        out["cols"] = sorted(s_cols)
    out["status"] = "ok" if out["hash_match"] and len(s_rows) == len(d_rows) else "MISMATCH"
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from taxiframe.session import local_session
    spark = local_session()
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            res = compare(spark, con, key, qs[key], oracle.get(key), sf_dir)
        except Exception as exc:  # report and go on with the next key
            res = {"key": key, "status": "ERROR", "error": str(exc)[:400]}
        bad += res["status"] not in ("ok", "rows-only")
        print(res, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
