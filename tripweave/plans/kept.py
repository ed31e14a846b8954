"""Figures per key that are kept up to date by change propagation instead of being computed from all history.

A run rewrites some months of a table. What the rows of those months added to the figures before is taken back, what
they add now is put in: sums and counts by signed addition. A maximum (or minimum) that was taken back may have to be
replaced by one of an untouched month. It stands if a row of an untouched month held it, or if the months' new rows
reach it again; only for the other keys is the whole table asked, through a semi-join on them. So the work follows the
months and keys that changed, except for one narrow pass over the figures themselves, one row per key.

Keys may be missing and group together as in SQL. Keys without a row are dropped. Sums of nothing are 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import temporal as T
from tripweave.functions.identity import scoped
from tripweave.operators.skew import not_blank
from tripweave.operators.upsert import same
from tripweave.plans.marts import BOOKING_TYPES
from tripweave.sources.tables import SnapshotTable

ROWS, STALE = "_rows", "_stale"
Columns = Callable[[], dict[str, Column]]


def _nothing() -> dict[str, Column]:
    return {}


@dataclass(frozen=True)
class Figures:
    """What is kept per key: sums, smallest and largest values of the rows that ``where`` lets through."""

    keys: tuple[str, ...]
    sums: Columns = _nothing
    lows: Columns = _nothing
    highs: Columns = _nothing
    where: Callable[[], Column] | None = None

    def of(self, rows: DataFrame) -> DataFrame:
        """The figures of some rows; aggregates of fixed width, combined before the shuffle."""
        counted = rows if self.where is None else rows.filter(self.where())
        return counted.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias(ROWS),
            *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(n) for n, c in self.sums().items()],
            *[F.min(c).alias(n) for n, c in self.lows().items()],
            *[F.max(c).alias(n) for n, c in self.highs().items()],
        )

    def merged(self, state: DataFrame, before: list[DataFrame], after: list[DataFrame]) -> DataFrame:
        """The figures with ``before`` taken back and ``after`` put in; ``_stale`` where a bound has to be looked up."""
        columns = [*self.keys, ROWS, *self.sums(), *self.lows(), *self.highs()]
        parts = [(state, 0), *[(x, 1) for x in before], *[(x, 2) for x in after]]
        rows = None
        for part, tag in parts:
            part = part.select(*columns, F.lit(tag).alias("_tag"))
            rows = part if rows is None else rows.unionByName(part)
        sign = F.when(F.col("_tag") == 1, -1).otherwise(1)
        bounds = [(n, F.min, F.least) for n in self.lows()] + [(n, F.max, F.greatest) for n in self.highs()]
        grouped = rows.groupBy(*self.keys).agg(
            *[F.sum(sign * F.col(n)).alias(n) for n in (ROWS, *self.sums())],
            *[best(F.when(F.col("_tag") == t, F.col(n))).alias(f"{n}_{t}") for n, best, _ in bounds for t in range(3)],
        )
        stale = F.lit(False)
        for n, _, _ in bounds:
            kept, gone, come = (F.col(f"{n}_{t}") for t in range(3))
            reached = (come >= kept) if n in self.highs() else (come <= kept)
            # What is taken back is never beyond what was kept.
            stale = stale | (gone.isNotNull() & (gone == kept) & ~F.coalesce(reached, F.lit(False)))
        return grouped.filter(F.col(ROWS) > 0).select(
            *self.keys, ROWS, *self.sums(), *[pick(f"{n}_0", f"{n}_2").alias(n) for n, _, pick in bounds], stale.alias(STALE)
        )


class KeptFigures:
    """Stored figures, brought up to date after the tables behind them changed."""

    def __init__(self, figures: Figures, table: SnapshotTable):
        self.figures, self.table = figures, table

    def read(self) -> DataFrame:
        return self.table.read().drop(STALE)

    def rebuild(self, rows: DataFrame) -> DataFrame:
        return self.table.write(self.figures.of(rows).withColumn(STALE, F.lit(False))).drop(STALE)

    def update(self, before: list[DataFrame], after: list[DataFrame], rows: DataFrame) -> DataFrame:
        """Figures after a change of some months: ``before`` holds their figures of then, ``after`` their rows of now.

        ``rows`` is everything there is now; only keys whose largest or smallest value went are looked up in it.
        """
        if not self.table.exists():
            return self.rebuild(rows)
        found = self.table.write(self.figures.merged(self.table.read(), before, [self.figures.of(x) for x in after]))
        stale = found.filter(STALE)
        if stale.isEmpty():
            return found.drop(STALE)
        names = [f"_{k}" for k in self.figures.keys]
        asked = stale.select(*[F.col(k).alias(n) for k, n in zip(self.figures.keys, names)])
        again = self.figures.of(rows.join(asked, same(list(self.figures.keys), names), "left_semi")).withColumn(STALE, F.lit(False))
        return self.table.write(found.filter(~F.col(STALE)).unionByName(again)).drop(STALE)


def _completed(status: str) -> Column:
    return F.when(F.col(status) == "completed", F.col("amount_idr"))


def _ticket_name() -> Column:
    scid = scoped("crm", F.col("ticket_id")).alias("scid")
    return F.when(F.col("customer_name").isNotNull(), F.struct("created_at", scid, "customer_name"))


def _ticket_sums() -> dict[str, Column]:
    hours = T.hours_between(F.col("created_at"), F.col("resolved_at"))
    return {
        "tickets": F.lit(1).cast("bigint"), "critical": (F.col("priority") == "critical").cast("bigint"),
        "hours": hours, "timed": hours.isNotNull().cast("bigint"),
    }


def _booking_sums() -> dict[str, Column]:
    status, kind = F.col("status"), F.col("booking_type")
    count = lambda c: F.when(c, 1).otherwise(0).cast("bigint")
    return {
        "clv_idr": _completed("status"), "completed_count": count(status == "completed"),
        "cancelled_count": count(status == "cancelled"), "no_show_count": count(status == "no_show"),
        "booking_count": F.lit(1).cast("bigint"), **{f"count_{t}": count(kind == t) for t in BOOKING_TYPES},
    }


def _booking_latest() -> dict[str, Column]:
    latest = {f"latest_{t}": F.when(F.col("booking_type") == t, F.col("booking_ts")) for t in BOOKING_TYPES}
    return {"last_booking_ts": F.col("booking_ts"), **latest}


#: Vendor bookings of an email.
VENDOR_EMAILS = Figures(
    ("email",), lambda: {"completed_idr": _completed("booking_status")}, lambda: {"first_seen": F.col("booking_ts")},
    lambda: {"last_seen": F.col("booking_ts")}, lambda: not_blank(F.col("email")),
)
#: Completed hotel value of an app customer.
HOTEL_VALUE = Figures(
    ("customer_id",), lambda: {"clv_idr": F.col("amount_idr")}, where=lambda: F.col("booking_status") == "completed"
)
#: Tickets of an email and phone.
CONTACTS = Figures(
    ("customer_email", "customer_phone"), _ticket_sums, lambda: {"first_seen": F.col("created_at")},
    lambda: {"last_seen": F.col("created_at"), "named": _ticket_name()},
)
#: Bookings of a customer; those without one form a group of their own.
BOOKINGS = Figures(("resolved_customer_id",), _booking_sums, highs=_booking_latest)
