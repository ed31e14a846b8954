"""Customer value rules: tier, churn score and next action."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------
GOLD_FROM = 10_000_000
SILVER_FROM = 2_000_000
DORMANT_AFTER_DAYS = 90
DORMANCY_SCALE_DAYS = 180.0
CRITICAL_SCALE = 3.0
WEIGHT_VALUE, WEIGHT_DORMANCY, WEIGHT_LOST, WEIGHT_CRITICAL = 0.40, 0.40, 0.15, 0.05
REACTIVATE_FROM = 0.7
RETAIN_BELOW = 0.3
# -------------------------------------------------------------------------------------------


def loyalty_tier(clv: Column, dormant_days: Column) -> Column:
    return (
        F.when(dormant_days > DORMANT_AFTER_DAYS, "churn_risk")
        .when(clv >= GOLD_FROM, "gold")
        .when(clv >= SILVER_FROM, "silver")
        .otherwise("churn_risk")
    )


def _unit(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def churn_score(clv: Column, dormant_days: Column, lost: Column, bookings: Column, critical: Column) -> Column:
    """Weighted risk between 0 and 1; ``lost`` counts cancelled and missed bookings."""
    span = float(GOLD_FROM - SILVER_FROM)
    value_risk = (
        F.when(clv < SILVER_FROM, 1.0).when(clv >= GOLD_FROM, 0.0).otherwise(1.0 - (clv - SILVER_FROM) / span)
    )
    dormancy = F.least(dormant_days / DORMANCY_SCALE_DAYS, F.lit(1.0))
    lost_share = lost / F.greatest(bookings, F.lit(1))
    support = F.least(critical / CRITICAL_SCALE, F.lit(1.0))
    return _unit(
        WEIGHT_VALUE * value_risk + WEIGHT_DORMANCY * dormancy
        + WEIGHT_LOST * lost_share + WEIGHT_CRITICAL * support
    )


def recommended_action(score: Column, distinct_types: Column, latest_type: Column, tier: Column) -> Column:
    return (
        F.when(score >= REACTIVATE_FROM, "reactivate")
        .when((distinct_types == 1) & (latest_type == "flight"), "cross_sell")
        .when((tier == "gold") & (score < RETAIN_BELOW), "retain")
        .otherwise("reengage")
    )
