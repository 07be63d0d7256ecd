"""Comparison of a Spark result with the rows of its SQL."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {
    "BOOLEAN": "boolean",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "HUGEINT": "hugeint",
    "VARCHAR": "string",
    "DATE": "date",
    "DOUBLE": "double",
    "FLOAT": "float",
    "TIMESTAMP": "timestamp",
}


def differences(df, connection, sql: str) -> list[str]:
    """What differs between ``df`` and the result of ``sql``; empty if nothing does."""
    relation = connection.sql(sql)
    found = []
    if sorted(df.columns) != sorted(relation.columns):
        return [f"columns {sorted(df.columns)} and {sorted(relation.columns)}"]
    wanted_types = {name: _KINDS.get(str(kind), str(kind)) for name, kind in zip(relation.columns, relation.types)}
    for name, kind in df.dtypes:
        if wanted_types[name] != kind:
            found.append(f"{name} is {kind}, not {wanted_types[name]}")
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    wanted = _rows(relation.columns, relation.fetchall())
    if got != wanted:
        extra, missing = list((got - wanted).items())[:2], list((wanted - got).items())[:2]
        found.append(f"{sum(got.values())} and {sum(wanted.values())} rows; only Spark {extra}, only SQL {missing}")
    return found
