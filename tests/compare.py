"""Order-insensitive comparison of a Spark result with a SQL oracle."""

from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize())
    return value


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_bag(df) -> Counter:
    return bag([tuple(r) for r in df.collect()], df.columns)


def oracle_bag(con, sql) -> tuple[Counter, list[str]]:
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return bag(cur.fetchall(), columns), columns
