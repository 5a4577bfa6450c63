"""Run registered queries and their oracle SQL side by side."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def open_oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def normalise(columns: list[str], rows) -> Counter:
    """Multiset of rows with columns in name order."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results agree, else what differs."""
    relation = connection.sql(sql)
    if sorted(spark_df.columns) != sorted(relation.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(relation.columns)}"
    ours = normalise(spark_df.columns, spark_df.collect())
    theirs = normalise(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    only_ours, only_theirs = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return f"{sum(ours.values())} vs {sum(theirs.values())} rows; spark {only_ours}; oracle {only_theirs}"
