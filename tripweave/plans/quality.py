"""The checks run over landed, cleansed and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions import cleanse as C
from tripweave.operators import checks as K
from tripweave.operators.skew import hot_keys, lookup_join
from tripweave.schema import GOLD_KEYS, LANDED, SILVER_KEYS


def landed_not_empty(tables: dict[str, DataFrame]) -> DataFrame:
    return K.union_all([K.not_empty(df, name) for name, df in tables.items()])


def landed_no_null_keys(tables: dict[str, DataFrame]) -> DataFrame:
    return K.union_all([K.not_null(df, name, LANDED[name].key) for name, df in tables.items()])


def landed_unique_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Keys repeat freely across days, never within one."""
    return K.union_all(
        [K.unique(df, name, LANDED[name].key, within="ingest_date") for name, df in tables.items()]
    )


def silver_keys(tables: dict[str, DataFrame]) -> DataFrame:
    return K.union_all([K.key_checks(tables[name], name, key) for name, key in SILVER_KEYS.items()])


def gold_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Key checks, and a warning only for bookings without a customer."""
    parts = [K.key_checks(tables[name], name, key) for name, key in GOLD_KEYS.items()]
    unresolved = K.not_null(tables["fact_bookings"], "fact_bookings", "resolved_customer_id", "warn")
    return K.union_all([*parts, unresolved])


# Rule per check with the tables and columns it covers.
_EMAILS = [
    ("silver_customers", "email"), ("silver_flight_bookings", "email"), ("silver_experience_bookings", "email"),
    ("silver_tickets", "customer_email"),
]
_PHONES = [("silver_customers", "phone"), ("silver_tickets", "customer_phone")]
_AMOUNTS = [
    ("silver_hotel_bookings", "amount_idr"), ("silver_flight_bookings", "amount_idr"),
    ("silver_experience_bookings", "amount_idr"),
]
ROW_CHECKS = {
    "email_valid": (K.bad_email, _EMAILS),
    "phone_e164": (K.bad_phone, _PHONES),
    "no_sentinels": (K.sentinel_left, _PHONES),
    "amount_positive": (K.not_positive, _AMOUNTS),
}


def failures(tables: dict[str, DataFrame], check: str) -> DataFrame:
    rule, columns = ROW_CHECKS[check]
    return K.union_all(
        [K.failing_rows(tables[t], t, SILVER_KEYS[t], column, check, rule) for t, column in columns]
    )


def all_failures(tables: dict[str, DataFrame]) -> DataFrame:
    return K.union_all([failures(tables, check) for check in ROW_CHECKS])


def row_check_summary(tables: dict[str, DataFrame], check: str) -> DataFrame:
    """Rows looked at and rows failing, per table; one scan each."""
    rule, columns = ROW_CHECKS[check]
    parts = []
    for table, column in columns:
        counts = tables[table].agg(
            F.count(F.lit(1)).alias("n_rows"), F.count(F.when(rule(F.col(column)), F.lit(1))).alias("n_fail")
        )
        parts.append(
            counts.select(
                F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "n_rows", "n_fail",
                (F.col("n_fail") == 0).alias("passed"),
            )
        )
    return K.union_all(parts)


def identity_fan_out(anchors: DataFrame) -> DataFrame:
    """How many app customers share one email or one phone at most."""
    parts = []
    for column in ("email", "phone"):
        shared = anchors.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            shared.agg(
                F.max("n").alias("largest"), F.count(F.when(F.col("n") > 1, F.lit(1))).alias("shared_values")
            ).select(F.lit(column).alias("link"), "largest", "shared_values")
        )
    return K.union_all(parts)


def postal_city_mismatches(customers: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Customers whose postal code does not start with a prefix of their city.

    ``prefixes`` holds ``(city, postal_prefix)``; a city may have several.
    """
    by_city = prefixes.groupBy(C.title_case(F.col("city")).alias("city")).agg(
        F.collect_set("postal_prefix").alias("prefixes")
    )
    joined = lookup_join(customers, by_city, "city", "customer_id", hot_keys(customers, "city"))
    fits = F.exists("prefixes", lambda p: F.startswith(F.col("postal_code"), p))
    # Unknown cities and missing postal codes leave the condition NULL.
    return joined.filter(~fits).select("customer_id", "city", "postal_code")
