"""The unified booking fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.identity import placeholder_id, scoped
from tripweave.operators.skew import hot_keys, lookup_join
from tripweave.operators.upsert import HASH, hashed

FACT_COLUMNS = [
    "booking_id", "resolved_customer_id", "identity_confidence", "source", "booking_type", "provider", "city",
    "origin", "destination", "amount_idr", "payment_method", "booking_ts", "status", "check_in_date",
    "check_out_date", "departure_ts", "arrival_ts", "activity_date", "seat_class", "category", "guests",
    "participants",
]


def _booking(booking_type: str, source: str, booking_id: str, source_key: Column, **columns: str) -> list[Column]:
    shared = ["amount_idr", "payment_method", "booking_ts"]
    return [
        F.col(booking_id).alias("booking_id"),
        source_key.alias("source_customer_id"),
        F.lit(source).alias("source"),
        F.lit(booking_type).alias("booking_type"),
        F.col("booking_status").alias("status"),
        *[F.col(c) for c in shared],
        *[F.col(c).alias(name) for name, c in columns.items()],
    ]


def bookings_unified(hotels: DataFrame, flights: DataFrame, experiences: DataFrame) -> DataFrame:
    """Hotel, flight and experience bookings in one shape; fields a type lacks are NULL."""
    by_email = scoped("vendor", F.lower(F.trim("email")))
    hotel = hotels.select(
        *_booking(
            "hotel", "app_oltp", "booking_id", scoped("app", F.col("customer_id")),
            provider="hotel_name", city="hotel_city", check_in_date="check_in_date",
            check_out_date="check_out_date", guests="guests",
        )
    )
    flight = flights.select(
        *_booking(
            "flight", "vendor_api", "booking_ref", by_email,
            provider="airline", city="destination", origin="origin", destination="destination",
            departure_ts="departure_ts", arrival_ts="arrival_ts", seat_class="seat_class",
        )
    )
    experience = experiences.select(
        *_booking(
            "experience", "vendor_api", "booking_ref", by_email,
            provider="experience_name", city="city", activity_date="activity_date", category="category",
            participants="participants",
        )
    )
    out = hotel.unionByName(flight, allowMissingColumns=True)
    out = out.unionByName(experience, allowMissingColumns=True)
    order = [c for c in FACT_COLUMNS if c not in ("resolved_customer_id", "identity_confidence")]
    return out.select("source_customer_id", *order)


def fact_bookings(
    bookings: DataFrame, customer_keys: DataFrame, placeholders: bool = False, hot: DataFrame | None = None
) -> DataFrame:
    """Every booking once, with its customer where one is known.

    ``hot`` lists the source keys of many bookings; without it they are counted in ``bookings``.

    Unresolved bookings keep a NULL customer, or with ``placeholders`` a stable stand-in derived
    from their source key that a later run replaces once the key resolves.
    """
    hot = hot_keys(bookings, "source_customer_id") if hot is None else hot
    joined = lookup_join(bookings, customer_keys, "source_customer_id", "booking_id", hot)
    if placeholders:
        joined = joined.withColumns(
            {
                "identity_confidence": F.when(
                    F.col("resolved_customer_id").isNull() & F.col("source_customer_id").isNotNull(), "placeholder"
                ).otherwise(F.col("identity_confidence")),
                "resolved_customer_id": F.coalesce(
                    "resolved_customer_id", placeholder_id(F.col("source_customer_id"))
                ),
            }
        )
    return joined.select(*FACT_COLUMNS)


def moved_keys(before: DataFrame, after: DataFrame) -> DataFrame:
    """Source keys that are new, gone, or point to another customer or confidence than before."""
    columns = ["source_customer_id", "resolved_customer_id", "identity_confidence"]
    sides = before.select(*columns, F.lit(-1).alias("side")).unionByName(after.select(*columns, F.lit(1).alias("side")))
    changed = sides.groupBy(*columns).agg(F.sum("side").alias("balance")).filter(F.col("balance") != 0)
    return changed.select("source_customer_id").distinct()


def bookings_to_resolve(bookings: DataFrame, delivered: DataFrame, moved: DataFrame) -> DataFrame:
    """The delivered bookings, and all earlier ones whose source key moved.

    Every other booking keeps the customer it has, so the fact table needs no other update.
    """
    key, row_id = "source_customer_id", "booking_id"
    again = hashed(bookings, key).join(hashed(moved, key), [HASH, key], "left_semi").drop(HASH)
    now = hashed(delivered.select(row_id), row_id)
    earlier = hashed(again, row_id).join(now, [HASH, row_id], "left_anti").drop(HASH)
    return earlier.select(*delivered.columns).unionByName(delivered)
