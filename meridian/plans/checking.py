"""Local stand-in for the correctness gate: run a registered Spark query and
its DuckDB oracle on the same parquet tables and compare them.

Comparison: column names, row count, and the sorted multiset of rows with
floats rounded to 6 places (``exact=True``: floats compared bit for bit).
"""

from __future__ import annotations

import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact: bool = False):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v) if exact else f"{round(v, 6):.6f}")
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    return (1, str(v))


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None, exact: bool = False) -> dict:
    con = con or duckdb_conn(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(sql)
    o_cols = [d[0] for d in rel.description]
    o_rows = rel.fetchall()
    res = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "cols_match": sorted(s_cols) == sorted(o_cols)}
    if res["cols_match"]:
        order = [o_cols.index(c) for c in s_cols]
        o_rows = [tuple(r[i] for i in order) for r in o_rows]
        a = sorted(tuple(_norm(v, exact) for v in r) for r in s_rows)
        b = sorted(tuple(_norm(v, exact) for v in r) for r in o_rows)
        res["values_match"] = a == b
        if a != b:
            sa, sb = set(a), set(b)
            res["only_spark"] = [r for r in a if r not in sb][:3]
            res["only_oracle"] = [r for r in b if r not in sa][:3]
    else:
        res["spark_cols"], res["oracle_cols"] = s_cols, o_cols
        res["values_match"] = False
    return res
