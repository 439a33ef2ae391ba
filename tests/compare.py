"""Row comparison of a Spark frame with a DuckDB query, blind to row and column order."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def difference(frame, con, sql: str) -> str | None:
    """None if equal, else a short account of the difference."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted_rows = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    got, wanted = rows(frame.columns, frame.collect()), rows(names, wanted_rows)
    if got == wanted:
        return None
    less, more = wanted - got, got - wanted
    return (f"{got.total()} rows against {wanted.total()}; {less.total()} missing, {more.total()} extra; columns "
            f"{sorted(names)}; e.g. missing {list(less)[:2]}, extra {list(more)[:2]}")
