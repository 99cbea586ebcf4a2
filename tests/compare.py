"""Compare a query's rows with DuckDB's answer to its SQL, by value and without order."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def as_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def type_name(kind: str) -> str:
    """A common name for the type of a Spark or DuckDB column."""
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    return names.get(kind, kind.upper().replace(" ", ""))


def differences(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = connection.execute(sql)
    their_columns = [item[0] for item in result.description]
    their_types = {item[0]: type_name(str(item[1])) for item in result.description}
    theirs = result.fetchall()
    ours = [tuple(row) for row in frame.collect()]
    found = []
    our_types = {name: type_name(kind) for name, kind in frame.dtypes}
    if our_types != their_types:
        found.append(f"types: {our_types} against {their_types}")
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} against {len(theirs)}")
    if not found:
        mine, other = as_bag(frame.columns, ours), as_bag(their_columns, theirs)
        if mine != other:
            found.append(f"only here: {list((mine - other).items())[:3]}, "
                         f"only there: {list((other - mine).items())[:3]}")
    return found
