"""Order-level reconciliation and removal of re-scanned lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.operators.dedupe import first_rows


def total_mismatches(
    orders: DataFrame, lines: DataFrame, key: str, total: Column, line_value: Column, tolerance: float = 0.0
) -> DataFrame:
    """Orders whose stated total differs from the sum of their lines by more than ``tolerance``.

    Lines are summed before the join; an order without lines sums to zero.
    """
    summed = lines.groupBy(key).agg(F.sum(line_value).alias("line_total"))
    both = orders.select(key, total.alias("stated_total")).join(summed, key, "left")
    difference = F.col("stated_total") - F.coalesce("line_total", F.lit(0))
    return both.withColumn("difference", difference).filter(F.abs("difference") > tolerance)


def latest_scan(lines: DataFrame, keys: list[str], scanned_at: str, tiebreak: str) -> DataFrame:
    """One line per key, the one scanned last."""
    return first_rows(lines, list(keys), [F.col(scanned_at).desc_nulls_last(), F.col(tiebreak).desc()])
