"""Order-insensitive comparison of a Spark result with DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return con


def plain(value):
    """A value in a form both engines share."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else f"f:{value!r}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, decimal.Decimal):
        return f"d:{value.normalize():f}"
    if isinstance(value, dt.datetime):
        return f"t:{value.isoformat()}"
    if isinstance(value, dt.date):
        return f"day:{value.isoformat()}"
    return f"s:{value}"


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    place = [df.columns.index(n) for n in names]
    return names, sorted(tuple(plain(row[i]) for i in place) for row in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple], dict[str, str]]:
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    names = sorted(columns)
    place = [columns.index(n) for n in names]
    rows = sorted(tuple(plain(row[i]) for i in place) for row in cursor.fetchall())
    return names, rows, types
