"""Data-quality checks: summaries per check and uniform failing-row records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _summary(counts: DataFrame, check: str, table: str, severity: str, passed: Column, message: str | None = None):
    return counts.select(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(severity).alias("severity"),
        F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.col("n_fail"), F.lit(0)).cast("bigint").alias("n_fail"),
        passed.alias("passed"),
        F.lit(message).cast("string").alias("message"),
    )


def _no_failures() -> Column:
    return F.coalesce(F.col("n_fail"), F.lit(0)) == 0


def not_empty(df: DataFrame, table: str) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_fail", (F.col("n_rows") == 0).cast("bigint"))
    return _summary(counts, "not_empty", table, "error", F.col("n_rows") > 0)


def _missing_column(df: DataFrame, check: str, table: str, column: str, severity: str) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_fail", F.col("n_rows"))
    return _summary(counts, check, table, severity, F.lit(False), f"column {column} not found")


def not_null(df: DataFrame, table: str, column: str, severity: str = "error") -> DataFrame:
    """Rows whose key is NULL. A table without the column fails."""
    if column not in df.columns:
        return _missing_column(df, "not_null", table, column, severity)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(column).isNull().cast("bigint")).alias("n_fail")
    )
    return _summary(counts, "not_null", table, severity, _no_failures())


def unique(df: DataFrame, table: str, column: str, within: str) -> DataFrame:
    """Surplus rows per key inside each value of ``within``; NULL keys equal each other."""
    if column not in df.columns:
        return _missing_column(df, "unique", table, column, "error")
    per_key = df.groupBy(within, column).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_fail"))
    return _summary(counts, "unique", table, "error", _no_failures())


def key_checks(df: DataFrame, table: str, key: str) -> DataFrame:
    """``not_null`` and ``unique`` of a model's key, both from one count per key value.

    NULL keys fail the first and are left out of the second.
    """
    n, is_null = F.col("n"), F.col(key).isNull()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum(n).alias("all_rows"),
        F.sum(F.when(is_null, n)).alias("null_rows"),
        F.sum(F.when(~is_null, n)).alias("keyed_rows"),
        F.sum(F.when(~is_null, n - 1)).alias("surplus_rows"),
    )

    def line(check: str, rows: str, failing: str) -> Column:
        bad = F.coalesce(failing, F.lit(0)).cast("bigint")
        return F.struct(
            F.lit(check).alias("check_name"),
            F.lit(table).alias("table_name"),
            F.lit("error").alias("severity"),
            F.coalesce(rows, F.lit(0)).cast("bigint").alias("n_rows"),
            bad.alias("n_fail"),
            (bad == 0).alias("passed"),
            F.lit(None).cast("string").alias("message"),
        )

    lines = F.array(line("not_null", "all_rows", "null_rows"), line("unique", "keyed_rows", "surplus_rows"))
    return counts.select(F.inline(lines))


# ---- failing rows -------------------------------------------------------------------------

Rule = Callable[[Column], Column]


def bad_email(c: Column) -> Column:
    return c.isNotNull() & ((c == "") | ~c.like("%@%.%"))


def bad_phone(c: Column) -> Column:
    return c.isNotNull() & ~c.rlike(r"^\+62[0-9]+$")


# ---- fixed values: sentinels that must not survive cleansing ---------------------------------
CHECKED_SENTINELS = ["TIDAK ADA", "000-000-0000", ""]
# -------------------------------------------------------------------------------------------


def sentinel_left(c: Column) -> Column:
    return c.isin(CHECKED_SENTINELS)


def not_positive(c: Column) -> Column:
    return c <= 0


def failing_rows(df: DataFrame, table: str, key: str, column: str, check: str, rule: Rule) -> DataFrame:
    bad = F.col(column)
    return df.filter(rule(bad)).select(
        F.lit(check).alias("check_name"),
        F.col(key).alias("entity_id"),
        F.lit(table).alias("source"),
        bad.cast("string").alias("bad_value"),
    )
