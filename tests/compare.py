"""Order-insensitive comparison of a Spark result with its SQL twin in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return repr(value)


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else a short account."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    ours = result.collect()
    left, right = _rows(result.columns, ours), _rows(names, theirs)
    if left == right:
        return None
    return (
        f"rows {len(ours)} / {len(theirs)}; only Spark: {list((left - right).items())[:2]}; "
        f"only SQL: {list((right - left).items())[:2]}"
    )
