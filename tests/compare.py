"""Order-insensitive comparison of a Spark result with a DuckDB statement."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(norm(r[i]) for i in order) for r in rows], [columns[i] for i in order]


def compare(spark_df, con, sql: str, show: int = 5):
    s_cols = spark_df.columns
    s_rows, s_names = rows_of(s_cols, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows, d_names = rows_of(d_cols, res.fetchall())
    out = {"spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "columns_match": s_names == d_names}
    cs, cd = Counter(s_rows), Counter(d_rows)
    only_s = list((cs - cd).elements())[:show]
    only_d = list((cd - cs).elements())[:show]
    out["values_match"] = not only_s and not only_d and out["columns_match"]
    if not out["values_match"]:
        out["names"] = (s_names, d_names)
        out["only_spark"] = only_s
        out["only_duck"] = only_d
    return out


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def spark_type_as_duck(t: str) -> str:
    if t.startswith("decimal("):
        return "DECIMAL" + t[len("decimal"):].replace(" ", "")
    if t.startswith("array<"):
        return spark_type_as_duck(t[len("array<"):-1]) + "[]"
    return SPARK_TO_DUCK.get(t, t.upper())


def types_of(spark_df, con, sql: str):
    s = {n: spark_type_as_duck(t) for n, t in spark_df.dtypes}
    rel = con.sql(sql)
    d = {n: str(t).replace(" ", "") for n, t in zip(rel.columns, rel.types)}
    return s, d
