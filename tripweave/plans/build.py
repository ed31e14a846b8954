"""Builds and stores the layer tables of one source directory."""

from __future__ import annotations

import hashlib
from datetime import date
from functools import partial
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from tripweave.plans import facts, identity, marts, search_index, silver, sketches
from tripweave.plans.daily import together
from tripweave.session import prepare, shared_root
from tripweave.sources import fixtures
from tripweave.sources.reference_data import holiday_calendar
from tripweave.sources.tables import SnapshotTable

DEFAULT_AS_OF = "2026-12-31"

# Every table with the stored tables it is computed from, in build order.
DEPENDENCIES = {
    "silver_customers": [],
    "silver_hotel_bookings": [],
    "silver_flight_bookings": [],
    "silver_experience_bookings": [],
    "silver_tickets": [],
    "vendor_emails": ["silver_flight_bookings", "silver_experience_bookings"],
    "ticket_links": ["silver_tickets", "silver_customers"],
    "customer_records": ["silver_customers", "silver_tickets", "vendor_emails"],
    "dim_customer": [
        "silver_customers", "silver_hotel_bookings", "vendor_emails", "ticket_links", "customer_records",
    ],
    "fact_bookings": [
        "silver_customers", "silver_hotel_bookings", "silver_flight_bookings", "silver_experience_bookings",
        "vendor_emails",
    ],
    "mart_customer_clv": ["dim_customer", "fact_bookings", "silver_customers", "ticket_links"],
    "mart_route_monthly": ["fact_bookings"],
}


class Warehouse:
    """Layer tables derived from the Parquet tables of one directory.

    A table is written once per application, on first use, into the shared folder; later readers
    scan the stored copy. Models themselves are plain functions and can be run without it.
    """

    def __init__(self, spark: SparkSession, source_dir: str, as_of: str | date = DEFAULT_AS_OF):
        self.spark = prepare(spark)
        self.source_dir = str(source_dir).rstrip("/")
        self.as_of = str(as_of)
        label = hashlib.md5(f"{self.source_dir}|{self.as_of}".encode()).hexdigest()[:12]
        self.root = f"{shared_root(spark)}/{label}"
        self._stored: dict[str, DataFrame] = {}
        self._building = {name: Lock() for name in DEPENDENCIES}

    def landed(self, name: str) -> DataFrame:
        return fixtures.landed(self.spark, self.source_dir, name)

    def model(self, name: str) -> DataFrame:
        """The model's plan over its stored inputs, not yet run."""
        if name in silver.MODELS:
            source, cleanse = silver.MODELS[name]
            return cleanse(self.landed(source))
        t = self._tables(DEPENDENCIES[name])
        if name == "vendor_emails":
            return identity.vendor_grouped(t["silver_flight_bookings"], t["silver_experience_bookings"])
        if name == "customer_records":
            return identity.customer_records(self.anchors(), t["vendor_emails"], t["silver_tickets"])
        if name == "ticket_links":
            return identity.ticket_links(t["silver_tickets"], self.anchors())
        if name == "dim_customer":
            people = identity.dim_customer(
                t["silver_customers"], t["silver_hotel_bookings"], t["vendor_emails"], t["ticket_links"], self.as_of
            )
            return identity.with_lists(people, t["customer_records"])
        if name == "fact_bookings":
            return facts.fact_bookings(self.bookings(), self.customer_keys())
        if name == "mart_customer_clv":
            return marts.mart_customer_clv(t["dim_customer"], t["fact_bookings"], self.support())
        if name == "mart_route_monthly":
            return marts.mart_route_monthly(t["fact_bookings"], holiday_calendar(self.spark))
        raise KeyError(name)

    def table(self, name: str) -> DataFrame:
        """The stored table, built together with everything it needs."""
        with self._building[name]:
            if name not in self._stored:
                plan = self.model(name)
                lookup = "resolved_customer_id" if "resolved_customer_id" in plan.columns else None
                if lookup:
                    # Rows of one customer lie together, which compresses well and reads few pages.
                    plan = plan.sortWithinPartitions(lookup)
                self._stored[name] = SnapshotTable(self.spark, f"{self.root}/{name}").write(plan, lookup)
            return self._stored[name]

    def _tables(self, names: list[str]) -> dict[str, DataFrame]:
        """Stored tables by name; missing ones that do not need each other are built side by side.

        A table waits for those it needs only, so the few last tasks of one do not leave the other cores idle.
        """
        missing = {name: partial(self.table, name) for name in names if name not in self._stored}
        if missing:
            together(missing)
        return {name: self._stored[name] for name in names}

    def build_all(self) -> None:
        self._tables(list(DEPENDENCIES))

    def create_views(self) -> None:
        """Make the stored tables available to ``spark.sql`` under their names."""
        for name in DEPENDENCIES:
            self.table(name).createOrReplaceTempView(name)

    # ---- parts shared by several models -----------------------------------------------------

    def anchors(self) -> DataFrame:
        return identity.app_anchors(self.table("silver_customers"))

    def vendors(self) -> DataFrame:
        return self.table("vendor_emails")

    def bookings(self) -> DataFrame:
        return facts.bookings_unified(
            self.table("silver_hotel_bookings"), self.table("silver_flight_bookings"),
            self.table("silver_experience_bookings"),
        )

    def customer_keys(self) -> DataFrame:
        return identity.customer_keys(self.anchors(), self.vendors())

    def route_sketches(self) -> DataFrame:
        """Travellers per route and month as stored sketches."""
        if "route_sketches" not in self._stored:
            rows = sketches.route_sketches(self.table("fact_bookings"))
            self._stored["route_sketches"] = SnapshotTable(self.spark, f"{self.root}/route_sketches").write(rows)
        return self._stored["route_sketches"]

    def search_postings(self) -> DataFrame:
        """Stored posting lists of the customers."""
        path = f"{self.root}/search_postings"
        if "search_postings" not in self._stored:
            search_index.write_postings(self.table("dim_customer"), path)
            self._stored["search_postings"] = search_index.read_postings(self.spark, path)
        return self._stored["search_postings"]

    def support(self) -> DataFrame:
        return identity.support_agg(identity.ticket_summaries(self.table("ticket_links"), self.anchors()))
