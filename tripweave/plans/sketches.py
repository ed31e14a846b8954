"""Distinct travellers as mergeable sketches, stored per route and month.

A month's exact count cannot be added to another's: a person who travels in both would count twice. A sketch can be
merged, so one stored row per route and month answers for any set of months, routes or cities without the facts. A
sketch has at most ``2 ** lg_k`` bytes, whatever the number of travellers, is combined before the shuffle, and is
nearly exact for a few hundred of them. Bookings without a customer add nobody. An empty fact gives no rows.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.operators.upsert import same
from tripweave.plans.marts import ROUTE_KEYS, route_rows

LG_K = 12
SIGMAS = 5  # standard errors that an estimate is allowed; one in about a million estimates is farther off


def error_bound(lg_k: int = LG_K) -> float:
    """Largest relative error that is to be expected of merged sketches of this size."""
    return SIGMAS * 1.04 / sqrt(2**lg_k)


def route_sketches(fact: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Bookings and the travellers' sketch of each route and month."""
    return route_rows(fact).groupBy(*ROUTE_KEYS).agg(
        F.count(F.lit(1)).alias("booking_count"), F.hll_sketch_agg("resolved_customer_id", F.lit(lg_k)).alias("travelers")
    )


def distinct_travelers(sketches: DataFrame, *by: str) -> DataFrame:
    """Travellers of any groups of stored rows, each person once however many months they travelled in."""
    return sketches.groupBy(*by).agg(
        F.countDistinct("year_month").alias("months"), F.sum("booking_count").alias("booking_count"),
        F.hll_sketch_estimate(F.hll_union_agg("travelers")).alias("estimate"),
    )


def within_bound(exact: DataFrame, estimated: DataFrame, keys: list[str], lg_k: int = LG_K) -> DataFrame:
    """Whether each estimate is within the sketch's error bound of ``unique_travelers``; its rounding is allowed one."""
    names = [f"_{k}" for k in keys]
    right = estimated.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "estimate")
    gap = F.abs(F.col("estimate") - F.col("unique_travelers"))
    close: Column = F.coalesce(gap <= 1 + error_bound(lg_k) * F.col("unique_travelers"), F.lit(False))
    return exact.join(right, same(keys, names), "left").withColumn("within", close).drop(*names, "estimate")
