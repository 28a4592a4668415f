"""Test helpers: typed literal tables in Spark and DuckDB, result comparison."""
from __future__ import annotations

from decimal import Decimal

import duckdb

from tests.compare import norm

TRADE_DDL = ("trade_date DATE, account VARCHAR, action VARCHAR, symbol VARCHAR, "
             "currency VARCHAR, price DECIMAL(18,4), quantity DECIMAL(18,6), "
             "amount DECIMAL(18,2), source_account_hint VARCHAR, source VARCHAR, "
             "row_hash VARCHAR")
TRADE_SPARK = ("trade_date date, account string, action string, symbol string, "
               "currency string, price decimal(18,4), quantity decimal(18,6), "
               "amount decimal(18,2), source_account_hint string, source string, "
               "row_hash string")


def D(x):
    return None if x is None else Decimal(str(x))


def duck_with(tables: dict[str, tuple[str, list[tuple]]]) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name, (ddl, rows) in tables.items():
        con.execute(f"CREATE TABLE {name} ({ddl})")
        if rows:
            marks = ", ".join("?" for _ in rows[0])
            con.executemany(f"INSERT INTO {name} VALUES ({marks})", rows)
    return con


def as_set(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def same(spark_df, con, query: str):
    res = con.execute(query)
    cols = [d[0] for d in res.description]
    d = as_set(cols, res.fetchall())
    s = as_set(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    assert sorted(spark_df.columns) == sorted(cols), (spark_df.columns, cols)
    assert s == d, {"only_spark": [r for r in s if r not in d][:5],
                    "only_duck": [r for r in d if r not in s][:5]}
