"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
from datetime import date, datetime
from decimal import Decimal

import duckdb

EXACT = False
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (v if EXACT else round(v, 6))
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, date):
        return v.isoformat()
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    problems = []
    if sorted(c.lower() for c in s_cols) != sorted(c.lower() for c in d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = rows_key(s_cols, s_rows), rows_key(d_cols, d_rows)
        if a != b:
            diff_a = [r for r in a if r not in set(b)][:3]
            diff_b = [r for r in b if r not in set(a)][:3]
            problems.append(f"values differ: spark-only {diff_a} duck-only {diff_b}")
    return len(s_rows), problems


def main():
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from loanlens.session import build_session

    args = sys.argv[1:]
    global EXACT
    EXACT = bool(os.environ.get("COMPARE_EXACT"))
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(e.queries())
    if os.environ.get("COMPARE_VANILLA"):  # a plain session, as a caller might create it
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for n in names:
        try:
            cnt, problems = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as ex:  # report and continue
            cnt, problems = -1, [f"error: {type(ex).__name__}: {str(ex)[:600]}"]
        bad += bool(problems)
        print(f"{'OK ' if not problems else 'BAD'} {n:28s} rows={cnt} {'; '.join(problems)}", flush=True)
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
