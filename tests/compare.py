"""Spark-vs-DuckDB result comparison used by the oracle tests.

Rows are compared as multisets after normalising values to plain Python
(decimals and floats to float, dates/timestamps to ISO text); floats must be
bit-identical. Columns are compared by name.
"""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, float):
        return v
    return v


def rows_by_name(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql: str, limit_diff: int = 5):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    sc, sr = rows_by_name(s_cols, s_rows)
    dc, dr = rows_by_name(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
        return problems
    if len(sr) != len(dr):
        problems.append(f"row count spark={len(sr)} duck={len(dr)}")
    if sr != dr:
        only_s = [r for r in sr if r not in set(dr)][:limit_diff]
        only_d = [r for r in dr if r not in set(sr)][:limit_diff]
        problems.append(f"values differ; spark-only={only_s} duck-only={only_d}")
    return problems


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def type_mismatches(spark_df, con, sql: str):
    """Columns whose Spark type does not correspond to the oracle's DuckDB type."""
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for f in spark_df.schema.fields:
        st = f.dataType.simpleString()
        if SPARK_TO_DUCK.get(st, st) != duck_types.get(f.name):
            out.append((f.name, st, duck_types.get(f.name)))
    return out
