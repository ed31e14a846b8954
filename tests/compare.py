"""Side-by-side run of the registered queries and their check SQL."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(source_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{source_dir}/{t}.parquet')")
    return con


def _plain(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "∅"
    if isinstance(value, float):
        return f"{value:.6f}"
    if isinstance(value, bool):
        return str(int(value))
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, relation: duckdb.DuckDBPyRelation) -> str | None:
    """None when both sides hold the same columns and the same rows, else what differs."""
    left_cols, right_cols = spark_df.columns, relation.columns
    if sorted(left_cols) != sorted(right_cols):
        return f"columns {sorted(set(left_cols) ^ set(right_cols))}"
    left = rows_of(left_cols, [tuple(r) for r in spark_df.collect()])
    right = rows_of(right_cols, relation.fetchall())
    if left == right:
        return None
    only_left = sorted(set(left) - set(right))[:3]
    only_right = sorted(set(right) - set(left))[:3]
    return f"rows {len(left)} vs {len(right)}; {sorted(left_cols)}; spark only {only_left}; sql only {only_right}"
