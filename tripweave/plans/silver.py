"""Cleansed tables, one per landed table. Each takes a landed DataFrame, usually a window of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import cleanse as C
from tripweave.functions import temporal as T
from tripweave.operators.dedupe import first_rows
from tripweave.schema import CUSTOMERS, EXPERIENCES, FLIGHTS, HOTELS, TICKETS, LandedTable


def _cleansed(landed: DataFrame, table: LandedTable, rules: dict[str, Column]) -> DataFrame:
    """The payload columns in order, each passed through its rule where it has one."""
    return landed.select(*[rules.get(name, F.col(name)).alias(name) for name in table.payload])


def _naive(name: str, source_tz: str | None) -> Column:
    """Typed timestamps are already parsed; only local time of a known zone needs shifting."""
    at = F.date_trunc("second", F.col(name))
    return F.to_utc_timestamp(at, source_tz) if source_tz else at


def silver_customers(landed: DataFrame, source_tz: str | None = None) -> DataFrame:
    """Latest version of every customer."""
    rows = _cleansed(
        landed,
        CUSTOMERS,
        {
            "email": C.email(F.col("email")),
            "phone": C.phone(F.col("phone")),
            "full_name": C.person_name(F.col("full_name")),
            "address": F.trim("address"),
            "city": C.title_case(F.col("city")),
            "province": C.title_case(F.col("province")),
            "postal_code": C.postal_code(F.col("postal_code")),
            "loyalty_tier": C.tier_or_default(F.col("loyalty_tier")),
            "preferred_airline": C.blank_to_null(F.col("preferred_airline")),
            "created_at": _naive("created_at", source_tz),
            "updated_at": _naive("updated_at", source_tz),
        },
    )
    newest = F.coalesce("updated_at", "created_at").desc_nulls_last()
    # Versions with the same time stamp are ordered by content, so that reruns agree.
    return _first(rows, [F.col("customer_id")], [newest, *_content_order(rows, "customer_id")])


def _first(rows: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row per key, sorted by a hash of the keys before themselves: texts that begin alike are slow to compare."""
    return first_rows(rows, [F.xxhash64(*keys), *keys], order)


def _content_order(rows: DataFrame, key: str) -> list[Column]:
    return [F.xxhash64(*[c for c in rows.columns if c != key]).asc()]


def hotel_rows(landed: DataFrame, source_tz: str | None = None, strict_payment: bool = True) -> DataFrame:
    """Cleansed hotel bookings, re-submissions included."""
    return _cleansed(
        landed,
        HOTELS,
        {
            "hotel_name": C.title_case(F.col("hotel_name")),
            "hotel_city": C.title_case(F.col("hotel_city")),
            "room_type": C.title_case(F.col("room_type")),
            "guests": C.guests(F.col("guests")),
            "amount_idr": C.whole_hundreds(F.col("amount_idr")),
            "payment_method": C.payment_method(F.col("payment_method"), strict_payment),
            "booking_status": C.booking_status(F.col("booking_status")),
            "booking_ts": _naive("booking_ts", source_tz),
        },
    )


def same_stay() -> list[Column]:
    return [F.col("customer_id"), F.trim(F.lower("hotel_name")), F.col("check_in_date"), F.col("amount_idr")]


def silver_hotel_bookings(landed: DataFrame, source_tz: str | None = None, strict_payment: bool = True) -> DataFrame:
    """Hotel bookings without re-submissions of the same stay at nearly the same price."""
    return _first(hotel_rows(landed, source_tz, strict_payment), same_stay(), [F.col("booking_id").asc()])


def flight_rows(landed: DataFrame, source_tz: str | None = None, strict_payment: bool = True) -> DataFrame:
    """Cleansed flight bookings, re-submissions included."""
    return _cleansed(
        landed,
        FLIGHTS,
        {
            "email": C.email(F.col("email")),
            "airline": C.title_case(F.col("airline")),
            "flight_number": C.upper_code(F.col("flight_number")),
            "origin": C.upper_code(F.col("origin")),
            "destination": C.upper_code(F.col("destination")),
            "departure_ts": T.timestamp(F.col("departure_ts"), source_tz),
            "arrival_ts": T.timestamp(F.col("arrival_ts"), source_tz),
            "passenger_name": C.person_name(F.col("passenger_name")),
            "seat_class": C.lower_code(F.col("seat_class")),
            "amount_idr": C.whole_hundreds(F.col("amount_idr")),
            "payment_method": C.payment_method(F.col("payment_method"), strict_payment),
            "booking_status": C.booking_status(F.col("booking_status")),
            "booking_ts": T.timestamp(F.col("booking_ts"), source_tz),
        },
    )


def same_flight() -> list[Column]:
    return [F.col(c) for c in ("email", "flight_number", "departure_ts", "amount_idr")]


def silver_flight_bookings(landed: DataFrame, source_tz: str | None = None, strict_payment: bool = True) -> DataFrame:
    return _first(flight_rows(landed, source_tz, strict_payment), same_flight(), [F.col("booking_ref").asc()])


def experience_rows(landed: DataFrame, source_tz: str | None = None, strict_payment: bool = True) -> DataFrame:
    """Cleansed experience bookings, re-submissions included."""
    return _cleansed(
        landed,
        EXPERIENCES,
        {
            "email": C.email(F.col("email")),
            "experience_name": C.title_case(F.col("experience_name")),
            "city": C.title_case(F.col("city")),
            "category": C.lower_code(F.col("category")),
            "activity_date": T.day(F.col("activity_date")),
            "participants": C.participants(F.col("participants")),
            "amount_idr": C.whole_hundreds(F.col("amount_idr")),
            "payment_method": C.payment_method(F.col("payment_method"), strict_payment),
            "booking_status": C.booking_status(F.col("booking_status")),
            "booking_ts": T.timestamp(F.col("booking_ts"), source_tz),
        },
    )


def same_activity() -> list[Column]:
    return [F.col("email"), F.trim(F.lower("experience_name")), F.col("activity_date"), F.col("amount_idr")]


def silver_experience_bookings(
    landed: DataFrame, source_tz: str | None = None, strict_payment: bool = True
) -> DataFrame:
    return _first(experience_rows(landed, source_tz, strict_payment), same_activity(), [F.col("booking_ref").asc()])


def silver_tickets(landed: DataFrame, source_tz: str | None = None) -> DataFrame:
    """Latest version of every support ticket."""
    rows = _cleansed(
        landed,
        TICKETS,
        {
            "customer_email": C.email(F.col("customer_email")),
            "customer_phone": C.phone(F.col("customer_phone")),
            "customer_name": C.person_name(F.col("customer_name")),
            "subject": F.trim("subject"),
            "body": C.without_mojibake(F.col("body")),
            "status": C.lower_code(F.col("status")),
            "priority": C.lower_code(F.col("priority")),
            "channel": C.lower_code(F.col("channel")),
            "created_at": T.timestamp(F.col("created_at"), source_tz),
            "resolved_at": T.timestamp(F.col("resolved_at"), source_tz),
            "category": C.lower_code(F.col("category")),
            "agent_name": C.title_case(F.col("agent_name")),
        },
    )
    newest = F.col("created_at").desc_nulls_last()
    return _first(rows, [F.col("ticket_id")], [newest, *_content_order(rows, "ticket_id")])


MODELS = {
    "silver_customers": ("customers", silver_customers),
    "silver_hotel_bookings": ("hotel_bookings", silver_hotel_bookings),
    "silver_flight_bookings": ("flights", silver_flight_bookings),
    "silver_experience_bookings": ("experiences", silver_experience_bookings),
    "silver_tickets": ("tickets", silver_tickets),
}
