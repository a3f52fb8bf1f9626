"""Compare a Spark result with the same query in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = ["lineitem", "orders", "customer", "supplier", "nation"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a defined order."""
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def type_of(connection: duckdb.DuckDBPyConnection, column: str) -> str:
    """The type of a lineitem column."""
    return str(connection.sql(f"SELECT {column} FROM lineitem").types[0])


def assert_same(actual: pd.DataFrame, expected: pd.DataFrame) -> None:
    assert len(actual) > 0
    assert len(actual) == len(expected)
    pd.testing.assert_frame_equal(normal(actual), normal(expected), check_dtype=False, check_exact=True)
