"""Fixed schemas of the landed tables, their keys and their clustering."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {
        "string": T.StringType(),
        "long": T.LongType(),
        "date": T.DateType(),
        "timestamp": T.TimestampType(),
    }
    fields = []
    for part in spec.split():
        name, _, kind = part.partition(":")
        fields.append(T.StructField(name, kinds[kind or "string"], True))
    return T.StructType(fields)


@dataclass(frozen=True)
class LandedTable:
    name: str
    key: str
    event_time: str
    schema: T.StructType

    @property
    def payload(self) -> list[str]:
        """Columns the source delivers, without the landing stamp."""
        return [f.name for f in self.schema.fields if f.name != "ingest_date"]


CUSTOMERS = LandedTable(
    "customers",
    "customer_id",
    "updated_at",
    _struct(
        "customer_id email phone full_name address city province postal_code loyalty_tier "
        "preferred_airline created_at:timestamp updated_at:timestamp ingest_date:date"
    ),
)
HOTELS = LandedTable(
    "hotel_bookings",
    "booking_id",
    "booking_ts",
    _struct(
        "booking_id customer_id hotel_name hotel_city check_in_date:date check_out_date:date room_type "
        "guests:long amount_idr:long payment_method booking_status booking_ts:timestamp ingest_date:date"
    ),
)
FLIGHTS = LandedTable(
    "flights",
    "booking_ref",
    "booking_ts",
    _struct(
        "booking_ref email airline flight_number origin destination departure_ts arrival_ts passenger_name "
        "seat_class amount_idr:long payment_method booking_status booking_ts ingest_date:date"
    ),
)
EXPERIENCES = LandedTable(
    "experiences",
    "booking_ref",
    "booking_ts",
    _struct(
        "booking_ref email experience_name city category activity_date participants:long amount_idr:long "
        "payment_method booking_status booking_ts ingest_date:date"
    ),
)
TICKETS = LandedTable(
    "tickets",
    "ticket_id",
    "created_at",
    _struct(
        "ticket_id customer_email customer_phone customer_name subject body status priority channel "
        "created_at resolved_at category agent_name ingest_date:date"
    ),
)

LANDED = {t.name: t for t in (CUSTOMERS, HOTELS, FLIGHTS, EXPERIENCES, TICKETS)}

SILVER_KEYS = {
    "silver_customers": "customer_id",
    "silver_hotel_bookings": "booking_id",
    "silver_flight_bookings": "booking_ref",
    "silver_experience_bookings": "booking_ref",
    "silver_tickets": "ticket_id",
}

GOLD_KEYS = {
    "dim_customer": "resolved_customer_id",
    "fact_bookings": "booking_id",
    "mart_customer_clv": "resolved_customer_id",
    "mart_route_monthly": "_pk",
}
