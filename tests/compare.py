"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    return value


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_normal(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str, show: int = 5) -> list[str]:
    """Empty where names and rows agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    expected = bag(names, cursor.fetchall())
    actual = bag(spark_df.columns, spark_df.collect())
    if actual == expected:
        return []
    missing, extra = expected - actual, actual - expected
    return [
        f"{sum(actual.values())} rows against {sum(expected.values())} expected",
        *[f"missing {row}" for row in list(missing)[:show]],
        *[f"extra   {row}" for row in list(extra)[:show]],
    ]
