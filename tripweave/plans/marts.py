"""Customer-value mart and route-by-month mart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import scoring
from tripweave.functions import temporal as T

BOOKING_TYPES = ["hotel", "flight", "experience"]


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def bookings_agg(fact: DataFrame) -> DataFrame:
    """Booking figures per customer; all bookings without a customer form one NULL group.

    Booking types are a closed set, so their latest times are kept per type. That leaves only
    fixed-width aggregates, which are combined in hash tables before the shuffle.
    """
    status = F.col("status")
    latest = [
        F.max(F.when(F.col("booking_type") == t, F.col("booking_ts"))).alias(f"latest_{t}") for t in BOOKING_TYPES
    ]
    seen = [F.max((F.col("booking_type") == t).cast("int")).alias(f"seen_{t}") for t in BOOKING_TYPES]
    grouped = fact.groupBy("resolved_customer_id").agg(
        F.coalesce(
            F.sum(F.when(status == "completed", F.col("amount_idr")).otherwise(F.lit(0))), F.lit(0).cast("bigint")
        ).alias("clv_idr"),
        _count(status == "completed").alias("completed_count"),
        _count(status == "cancelled").alias("cancelled_count"),
        _count(status == "no_show").alias("no_show_count"),
        F.count(F.lit(1)).alias("booking_count"),
        F.max("booking_ts").alias("last_booking_ts"),
        *latest,
        *seen,
    )
    return _booking_figures(grouped, [F.col(f"seen_{t}") for t in BOOKING_TYPES])


def kept_booking_figures(kept: DataFrame) -> DataFrame:
    """The same from the figures that :data:`tripweave.plans.kept.BOOKINGS` keeps."""
    return _booking_figures(kept, [(F.col(f"count_{t}") > 0).cast("int") for t in BOOKING_TYPES])


def _booking_figures(grouped: DataFrame, seen: list[Column]) -> DataFrame:
    # Bookings of one second are told apart by the type's name.
    newest = F.greatest(*[F.struct(F.col(f"latest_{t}").alias("at"), F.lit(t).alias("kind")) for t in BOOKING_TYPES])
    return grouped.select(
        "resolved_customer_id", "clv_idr", "completed_count", "cancelled_count", "no_show_count", "booking_count",
        "last_booking_ts",
        reduce(lambda a, b: a + b, seen).cast("bigint").alias("distinct_booking_types"),
        F.when(newest["at"].isNotNull(), newest["kind"]).alias("most_recent_booking_type"),
    )


def mart_customer_clv(dim: DataFrame, fact: DataFrame, support: DataFrame) -> DataFrame:
    """Value, churn score and next action per customer.

    All three inputs of the join are keyed by customer, and the two aggregates arrive already
    partitioned that way.
    """
    return value_mart(dim, bookings_agg(fact.filter(F.col("resolved_customer_id").isNotNull())), support)


def value_mart(dim: DataFrame, figures: DataFrame, support: DataFrame) -> DataFrame:
    """The same from booking figures per customer."""
    joined = (
        dim.select("resolved_customer_id", "dormant_days", "loyalty_tier")
        .join(figures, "resolved_customer_id", "left")
        .join(support, "resolved_customer_id", "left")
    )
    counts = [
        "clv_idr", "completed_count", "cancelled_count", "no_show_count", "booking_count",
        "critical_ticket_count", "has_support_ticket", "distinct_booking_types",
    ]
    filled = joined.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in counts})
    average = F.when(F.col("completed_count") > 0, F.expr("clv_idr div completed_count")).otherwise(F.lit(0))
    scored = filled.withColumns(
        {
            "aov_idr": average,
            "churn_risk_score": scoring.churn_score(
                F.col("clv_idr"), F.col("dormant_days"), F.col("cancelled_count") + F.col("no_show_count"),
                F.col("booking_count"), F.col("critical_ticket_count"),
            ),
        }
    )
    return scored.select(
        "resolved_customer_id", "clv_idr", "aov_idr", "booking_count", "completed_count", "cancelled_count",
        "no_show_count", "last_booking_ts", "dormant_days", "loyalty_tier", "churn_risk_score",
        "has_support_ticket", "critical_ticket_count", "avg_resolution_hours", "distinct_booking_types",
        scoring.recommended_action(
            F.col("churn_risk_score"), F.col("distinct_booking_types"), F.col("most_recent_booking_type"),
            F.col("loyalty_tier"),
        ).alias("recommended_action"),
    )


def with_holiday(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Attach the holiday window of ``year_month``; the entry with the lowest priority number wins.

    The calendar is reduced to one row per month, so its size is bounded by the months it spans.
    """
    by_month = calendar.groupBy("year_month").agg(F.min_by("holiday_window", "priority").alias("holiday_window"))
    return df.join(F.broadcast(by_month), "year_month", "left").withColumn(
        "holiday_window", F.coalesce("holiday_window", F.lit("none"))
    )


def route_rows(fact: DataFrame) -> DataFrame:
    flight = F.col("booking_type") == "flight"
    rows = fact.select(
        F.col("booking_type").alias("route_type"),
        F.when(flight, F.concat("origin", F.lit("-"), "destination")).otherwise(F.col("city")).alias("route_key"),
        F.when(flight, F.col("origin")).alias("origin"),
        F.when(flight, F.col("destination")).alias("destination"),
        F.when(~flight, F.col("city")).alias("city"),
        T.month_start(F.col("booking_ts")).alias("year_month"),
        "amount_idr", "status", "seat_class", "resolved_customer_id",
    )
    return rows


ROUTE_KEYS = ["route_type", "route_key", "origin", "destination", "city", "year_month"]


def mart_route_monthly(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Bookings and value per route and month.

    Distinct travellers are exact: Spark first groups by route and traveller, which spreads a dominating route over all
    tasks. :mod:`tripweave.plans.sketches` holds them in a form that can be merged over months.
    """
    rate = F.count(F.lit(1)).cast("double")
    premium = _count(F.col("seat_class").isin("business", "first"))
    grouped = route_rows(fact).groupBy(*ROUTE_KEYS).agg(
        F.count(F.lit(1)).alias("booking_count"),
        F.countDistinct("resolved_customer_id").alias("unique_travelers"),
        F.sum("amount_idr").alias("amount_idr_total"),
        F.expr("sum(amount_idr) div greatest(count(1), 1)").alias("amount_idr_avg"),
        F.when(F.col("route_type") == "flight", premium / rate).alias("business_class_share"),
        (_count(F.col("status") == "cancelled") / rate).alias("cancel_rate"),
        (_count(F.col("status") == "no_show") / rate).alias("no_show_rate"),
    )
    # A NULL part makes the whole key NULL on purpose; the key check reports it.
    key = F.concat("route_type", F.lit("|"), "route_key", F.lit("|"), F.col("year_month").cast("string"))
    return with_holiday(grouped, calendar).select(
        key.alias("_pk"), "route_type", "route_key", "origin", "destination", "city", "year_month",
        "booking_count", "unique_travelers", "amount_idr_total", "amount_idr_avg", "business_class_share",
        "cancel_rate", "no_show_rate", "holiday_window",
    )

