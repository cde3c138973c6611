"""DuckDB over the given tables, and an order-free comparison with Spark."""

from __future__ import annotations

import collections
import decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return value.normalize() + 0
    return value


def spark_rows(df) -> tuple[list[str], collections.Counter]:
    names = sorted(df.columns)
    rows = df.select(names).collect()
    return names, collections.Counter(tuple(_plain(v) for v in row) for row in rows)


def duck_rows(con, sql: str) -> tuple[list[str], collections.Counter]:
    rel = con.sql(sql)
    names = sorted(rel.columns)
    rel = rel.select(*[duckdb.ColumnExpression(n) for n in names])
    return names, collections.Counter(tuple(_plain(v) for v in row) for row in rel.fetchall())


def difference(left: collections.Counter, right: collections.Counter, limit: int = 4) -> str:
    only_left, only_right = left - right, right - left
    return (f"spark rows {sum(left.values())}, duckdb rows {sum(right.values())}; "
            f"only spark {list(only_left)[:limit]}; only duckdb {list(only_right)[:limit]}")
