"""Mergeable traveller counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripweave.plans import sketches
from tripweave.plans.marts import ROUTE_KEYS

FACT = "booking_type string, origin string, destination string, city string, booking_ts string, amount_idr bigint, status string, seat_class string, resolved_customer_id string"


def facts(spark, rows):
    df = spark.createDataFrame([("flight", a, b, None, at, 1, "completed", None, who) for a, b, at, who in rows], FACT)
    return df.withColumn("booking_ts", F.col("booking_ts").cast("timestamp"))


def test_a_person_of_two_months_counts_once(spark):
    rows = [("CGK", "DPS", f"2026-0{1 + k % 2}-05", f"c{k // 4}") for k in range(80)] + [("CGK", "DPS", "2026-03-01", None)]
    stored = sketches.route_sketches(facts(spark, rows))
    assert stored.count() == 3
    one = sketches.distinct_travelers(stored, "route_key").collect()
    assert [(r["months"], r["booking_count"], r["estimate"]) for r in one] == [(3, 81, 20)]


def test_merged_estimate_stays_within_the_bound(spark):
    rows = [("CGK", "DPS", f"2026-0{1 + k % 9}-05", f"c{k * 7919 % 30_000}") for k in range(60_000)]
    merged = sketches.distinct_travelers(sketches.route_sketches(facts(spark, rows)), "route_key").first()["estimate"]
    assert abs(merged - 30_000) <= sketches.error_bound() * 30_000
    assert sketches.error_bound(14) < sketches.error_bound(12) < 0.09


def test_flags_and_missing_groups(spark):
    exact = spark.createDataFrame([("a", None, 100), ("b", "x", 100), ("c", "x", 1)], "k string, l string, unique_travelers bigint")
    found = spark.createDataFrame([("a", None, 105), ("b", "x", 130)], "k string, l string, estimate bigint")
    out = {r["k"]: r["within"] for r in sketches.within_bound(exact, found, ["k", "l"]).collect()}
    assert out == {"a": True, "b": False, "c": False}


def test_empty_fact(spark):
    assert sketches.route_sketches(facts(spark, [])).count() == 0
    assert set(ROUTE_KEYS) <= set(sketches.route_sketches(facts(spark, [])).columns)


def test_the_sketches_take_one_shuffle(tables):
    plan = tables.route_sketches()  # stored
    merged = sketches.distinct_travelers(plan.drop("months"), "route_type")._jdf.queryExecution().executedPlan().toString()
    assert "amount_idr" not in merged and "FileScan" in merged
