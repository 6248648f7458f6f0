"""Order-insensitive comparison of a Spark result with the same query in SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and the same bag of rows, else what differs."""
    relation = connection.sql(sql)
    if sorted(result.columns) != sorted(relation.columns):
        return f"columns {sorted(result.columns)} against {sorted(relation.columns)}"
    names = sorted(result.columns)
    got = Counter(tuple(row[name] for name in names) for row in result.collect())
    places = [relation.columns.index(name) for name in names]
    expected = Counter(tuple(row[place] for place in places) for row in relation.fetchall())
    if got == expected:
        return None
    surplus, lacking = list((got - expected).items()), list((expected - got).items())
    return (
        f"{sum(got.values())} rows against {sum(expected.values())};"
        f" only in result: {surplus[:3]}; only in SQL: {lacking[:3]}"
    )
