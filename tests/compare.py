"""Comparison of a Spark result with the result of its oracle SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in a fixed order, one type per kind of value."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame[name] = frame[name].astype("datetime64[us]")
        elif pd.api.types.is_bool_dtype(frame[name]):
            frame[name] = frame[name].astype(bool)
        elif pd.api.types.is_integer_dtype(frame[name]):
            frame[name] = frame[name].astype("int64")
    return frame.sort_values(list(frame.columns), ignore_index=True)


def assert_same(spark_result: pd.DataFrame, oracle_result: pd.DataFrame) -> None:
    left, right = canonical(spark_result), canonical(oracle_result)
    assert list(left.columns) == list(right.columns)
    assert len(left) == len(right), (len(left), len(right))
    pd.testing.assert_frame_equal(left, right, check_exact=True, check_dtype=True)
