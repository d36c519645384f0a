"""Run a registered query in Spark and its oracle SQL in DuckDB; compare.

Comparison: same column names and types, same row count, and equal multisets
of rows after sorting columns by name, with doubles rounded to 6 digits.
Usable from pytest and as a script: ``python tests/oracle_check.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, key: str, sf_dir: str, con=None):
    """Returns (ok, message)."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[key](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(key)
    if sql is None:
        return True, f"{key}: rows-only ({len(s_rows)} rows)"
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{key}: columns differ spark={s_cols} duck={d_cols}"
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    wrong = {n: (s_types[n], d_types[n]) for n in s_types if s_types[n] != d_types[n]}
    if wrong:
        return False, f"{key}: column types differ (spark, duck): {wrong}"
    if len(s_rows) != len(d_rows):
        return False, f"{key}: row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_key(s_cols, s_rows), rows_key(d_cols, d_rows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        return False, f"{key}: values differ ({len(s_rows)} rows)\n  spark-only {only_s}\n  duck-only  {only_d}"
    return True, f"{key}: ok ({len(s_rows)} rows)"


if __name__ == "__main__":
    from postsift.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from __spark_entry__ import queries

    keys = sys.argv[2:] or sorted(queries())
    spark = local_session()
    con = duck(sf)
    bad = 0
    for k in keys:
        try:
            ok, msg = compare(spark, k, sf, con)
        except Exception as e:  # report and go on
            ok, msg = False, f"{k}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} passed")
