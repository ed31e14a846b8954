"""The daily job: cleanse a window of landed days, upsert the layers, run the checks."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.skew import hot_keys
from tripweave.plans import facts, identity, kept, marts, quality, silver
from tripweave.plans.kept import Figures, KeptFigures
from tripweave.schema import GOLD_KEYS, LANDED, SILVER_KEYS
from tripweave.session import prepare
from tripweave.sources import landing
from tripweave.sources.reference_data import holiday_calendar
from tripweave.sources.files import delete_path, path_exists, touch
from tripweave.sources.tables import MonthlyTable, SnapshotTable

# Event time that decides the storage month of each cleansed table.
_EVENT_TIME = {
    "silver_customers": "created_at",
    "silver_hotel_bookings": "booking_ts",
    "silver_flight_bookings": "booking_ts",
    "silver_experience_bookings": "booking_ts",
    "silver_tickets": "created_at",
}


# Figures that are kept of each table.
_KEPT: dict[str, tuple[Figures, list[str]]] = {
    "vendor_emails": (kept.VENDOR_EMAILS, ["silver_flight_bookings", "silver_experience_bookings"]),
    "hotel_value": (kept.HOTEL_VALUE, ["silver_hotel_bookings"]),
    "contacts": (kept.CONTACTS, ["silver_tickets"]),
    "booking_figures": (kept.BOOKINGS, ["fact_bookings"]),
}


def together(calls: dict[str, Callable[[], object]]) -> dict:
    """Results of independent calls by name; their Spark jobs run side by side, so small ones do not wait in line."""
    with ThreadPoolExecutor(max(1, len(calls))) as pool:
        running = {name: pool.submit(call) for name, call in calls.items()}
        return {name: future.result() for name, future in running.items()}


def _one_of(c: Column, values: list) -> Column:
    """Null-safe membership, never NULL."""
    known = [v for v in values if v is not None]
    found = F.coalesce(c.isin(known), F.lit(False)) if known else F.lit(False)
    return found | c.isNull() if None in values else found


class DailyJob:
    """Tables under one root folder.

    ``bronze`` is stored by landing day, ``silver`` and the booking fact by month, the other gold
    tables as snapshots.
    """

    def __init__(self, spark: SparkSession, root: str, as_of: str | date, calendar: DataFrame | None = None):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.as_of = str(as_of)
        self.calendar = calendar if calendar is not None else holiday_calendar(spark)

    def bronze_path(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def bronze(self, name: str, low: date | None = None, high: date | None = None) -> DataFrame:
        """All landed days, or those from ``low`` up to ``high``; folders of other days are not listed."""
        path, table = self.bronze_path(name), LANDED[name]
        if low is not None and high is not None:
            return landing.read_days(self.spark, path, table, low, high)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], table.schema)
        return landing.read_landed(self.spark, path, table)

    def land(self, name: str, batch: DataFrame, days: list[str | date]) -> None:
        landing.replace_days(batch, self.bronze_path(name), LANDED[name], days)

    def _snapshot(self, layer: str, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{layer}/{name}")

    def _monthly(self, path: str, key: str, event_time: str, like: DataFrame) -> MonthlyTable:
        return MonthlyTable(self.spark, f"{self.root}/{path}", key, event_time, like.schema)

    # ---- figures that follow the months a run touches ---------------------------------------

    @property
    def _unfinished(self) -> str:
        """Stands while a run is on; found at the start, what is kept beside the tables is made anew from them."""
        return f"{self.root}/stage/unfinished"

    def _upsert(self, name: str, table: MonthlyTable, batch: DataFrame, full_refresh: bool) -> list[str] | None:
        """Upsert a batch and note what its months gave to the kept figures; None if the whole table is new."""
        if full_refresh or not table.exists():
            table.replace_all(batch)
            return None

        def watch(rows: DataFrame) -> None:
            for kept_name, (figures, sources) in _KEPT.items():
                if name in sources:
                    self._snapshot("before", f"{kept_name}_{name}").write(figures.of(rows))

        return table.upsert(batch, watch=watch)

    def _kept(self, name: str, tables: dict[str, MonthlyTable], months: dict[str, list[str] | None], anew: bool) -> DataFrame:
        """The figures of that name after this run."""
        figures, sources = _KEPT[name]
        state = KeptFigures(figures, self._snapshot("stage", name))
        columns = [c for c in tables[sources[0]].schema.fieldNames() if all(c in tables[s].schema.fieldNames() for s in sources)]

        def rows(of: dict[str, list[str] | None]) -> DataFrame:
            out = None
            for source in sources:
                part = tables[source].read(of[source]).select(*columns)
                out = part if out is None else out.unionByName(part)
            return out

        everything = rows({s: None for s in sources})
        if anew or all(months[s] is None for s in sources):
            return state.rebuild(everything)
        before = [self._snapshot("before", f"{name}_{s}").read() for s in sources if months[s] is not None]
        return state.update(before, [rows(months)], everything)

    def run(self, days: list[str | date], full_refresh: bool = False) -> dict[str, DataFrame]:
        """One run over the selected days; a full refresh rebuilds from the first day ever.

        Returns the silver and gold tables by name. The day range is one widened filter, never a
        loop over days. Figures per vendor email, hotel customer, ticket contact and customer are
        kept: a run takes back and puts in what the months it rewrote give to them.
        """
        low, high = landing.backfill_window(days, full_refresh)
        anew = full_refresh or path_exists(self.spark, self._unfinished)
        touch(self.spark, self._unfinished)
        t: dict[str, DataFrame] = {}
        delivered: dict[str, DataFrame] = {}
        tables: dict[str, MonthlyTable] = {}
        months: dict[str, list[str] | None] = {}

        def cleanse(name: str) -> tuple[DataFrame, MonthlyTable, list[str] | None]:
            source, model = silver.MODELS[name]
            # The batch is stored first: the upsert and the fact table read it again.
            batch = self._snapshot("batch", name).write(model(landing.window(self.bronze(source, low, high), low, high)))
            table = self._monthly(f"silver/{name}", SILVER_KEYS[name], _EVENT_TIME[name], batch)
            return batch, table, self._upsert(name, table, batch, full_refresh)

        for name, done in together({n: partial(cleanse, n) for n in silver.MODELS}).items():
            delivered[name], tables[name], months[name] = done
            t[name] = tables[name].read()

        anchors = identity.app_anchors(t["silver_customers"])
        of_sources = together({n: partial(self._kept, n, tables, months, anew) for n in ("vendor_emails", "hotel_value", "contacts")})
        vendors, spent, contacts = of_sources["vendor_emails"], of_sources["hotel_value"], of_sources["contacts"]

        def write_fact() -> DataFrame:
            self._update_fact(t, delivered, identity.customer_keys(anchors, vendors), full_refresh, tables, months)
            return self._kept("booking_figures", tables, months, anew)

        made = together({
            "links": lambda: self._snapshot("stage", "ticket_links").write(identity.contact_links(contacts, anchors)),
            "records": lambda: self._snapshot("stage", "customer_records").write(
                identity.customer_records(anchors, vendors, t["silver_tickets"])
            ),
            "bookings": write_fact,
        })
        links, records, bookings = made["links"], made["records"], made["bookings"]

        def gold(name: str, plan: DataFrame) -> None:
            # One narrow pass: the plan holds every customer, as dormancy moves with the date.
            t[name] = self._snapshot("gold", name).write(plan, lookup=GOLD_KEYS[name])

        def customers() -> None:
            people = identity.customer_rows(t["silver_customers"], spent, vendors, links, self.as_of)
            gold("dim_customer", identity.with_lists(people, records))
            support = identity.support_agg(identity.ticket_summaries(links, anchors))
            known = marts.kept_booking_figures(bookings).filter(F.col("resolved_customer_id").isNotNull())
            gold("mart_customer_clv", marts.value_mart(t["dim_customer"], known, support))

        def routes() -> None:
            # A route's month depends on the bookings of that month only, so the rows of rewritten months
            # are replaced as a whole. Their text key may be missing and takes no part.
            table = self._snapshot("gold", "mart_route_monthly")
            rewritten = None if anew else months["fact_bookings"]
            fresh = marts.mart_route_monthly(tables["fact_bookings"].read(rewritten), self.calendar)
            if rewritten is not None and table.exists():
                first_days = [None if m == "none" else date.fromisoformat(f"{m}-01") for m in rewritten]
                stays = table.read().filter(~_one_of(F.col("year_month"), first_days))
                fresh = stays.unionByName(fresh)
            t["mart_route_monthly"] = table.write(fresh, lookup=GOLD_KEYS["mart_route_monthly"])

        together({"customers": customers, "routes": routes})
        delete_path(self.spark, self._unfinished)
        return t

    def _update_fact(
        self, t: dict[str, DataFrame], delivered: dict[str, DataFrame], keys: DataFrame, full_refresh: bool,
        tables: dict[str, MonthlyTable], months: dict[str, list[str] | None],
    ) -> None:
        """Bring the fact table up to date, and add it and the months that it rewrote to the lists.

        Bookings are resolved anew only if they were delivered now or their source key changed
        hands since the last run.
        """

        def unified(sources: dict[str, DataFrame]) -> DataFrame:
            return facts.bookings_unified(
                sources["silver_hotel_bookings"], sources["silver_flight_bookings"], sources["silver_experience_bookings"]
            )

        key_table = self._snapshot("stage", "customer_keys")
        before = key_table.read() if key_table.exists() else None
        keys = key_table.write(keys)
        rebuild = full_refresh or before is None
        bookings, hot = unified(t), None
        if not rebuild:
            moved = self._snapshot("stage", "moved_keys").write(facts.moved_keys(before, keys))
            # Without a moved key no earlier booking has to be looked at.
            if moved.isEmpty():
                bookings = unified(delivered)
            else:
                # Counted in all bookings, as their selection would have to be made a second time for it.
                hot = hot_keys(bookings, "source_customer_id")
                bookings = facts.bookings_to_resolve(bookings, unified(delivered), moved)
        updates = self._snapshot("batch", "fact_bookings").write(facts.fact_bookings(bookings, keys, hot=hot))
        tables["fact_bookings"] = self._monthly("gold/fact_bookings", GOLD_KEYS["fact_bookings"], "booking_ts", updates)
        months["fact_bookings"] = self._upsert("fact_bookings", tables["fact_bookings"], updates, rebuild)
        t["fact_bookings"] = tables["fact_bookings"].read()

    def checks(self, tables: dict[str, DataFrame], days: list[str | date]) -> DataFrame:
        """All check summaries of a run; a failing check is reported, it does not stop anything."""
        landed = {name: landing.partitions(self.bronze(name), list(days)) for name in LANDED}
        parts = [
            quality.landed_not_empty(landed),
            quality.landed_no_null_keys(landed),
            quality.landed_unique_keys(landed),
            quality.silver_keys(tables),
            quality.gold_keys(tables),
            *[quality.row_check_summary(tables, check) for check in quality.ROW_CHECKS],
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        return out
