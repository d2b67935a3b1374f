"""Compare a Spark result with a DuckDB result, whatever the order of rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float):
        return value + 0.0
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def differences(spark_result, duck_result) -> list[str]:
    """What differs; an empty list means the results are equal."""
    columns = [d[0] for d in duck_result.description]
    if sorted(columns) != sorted(spark_result.columns):
        return [f"columns {sorted(spark_result.columns)} against {sorted(columns)}"]
    got = rows_of(spark_result.columns, spark_result.collect())
    wanted = rows_of(columns, duck_result.fetchall())
    if len(got) != len(wanted):
        return [f"{len(got)} rows against {len(wanted)}"]
    return [f"{g}\n{w}" for g, w in zip(got, wanted) if g != w or repr(g) != repr(w)]
