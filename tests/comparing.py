"""Compare a Spark result with the rows an independent engine gives for its SQL twin."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _bag(rows: list[tuple], columns: list[str]) -> Counter:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return Counter(tuple(_plain(row[n]) for n in order) for row in rows)


def differences(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same columns and the same bag of rows."""
    expected = connection.sql(sql)
    if sorted(frame.columns) != sorted(expected.columns):
        return f"columns {sorted(frame.columns)} != {sorted(expected.columns)}"
    got = _bag([tuple(row) for row in frame.collect()], frame.columns)
    want = _bag(expected.fetchall(), expected.columns)
    if got == want:
        return ""
    extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
    return (
        f"{sorted(frame.columns)}\n rows {got.total()} / {want.total()}, "
        f"differing {(got - want).total()}\n only Spark {extra}\n only SQL {missing}"
    )
