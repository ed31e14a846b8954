"""Dashboard queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.identity import hex_id, id_from_hex
from tripweave.operators.dedupe import first_rows
from tripweave.operators.search import SearchFilter, sort_order
from tripweave.operators.skew import hot_keys, lookup_join, not_blank
from tripweave.plans.marts import BOOKING_TYPES

_ID = "resolved_customer_id"
OPEN_STATES = ["open", "in_progress"]


def _sum_or_zero(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))


def _whole_average(name: str) -> Column:
    """Average rounded half-even to a whole number."""
    return F.bround(F.avg(name))


# ---- executive overview -------------------------------------------------------------------


def kpi_summary(dim: DataFrame, fact: DataFrame, tickets: DataFrame) -> DataFrame:
    """Six figures in one row; every table is read once."""
    one = F.lit(1)
    customers = dim.agg(
        F.count(one).alias("total_customers"),
        F.bround(F.avg(F.when(F.col("clv_idr") > 0, F.col("clv_idr")))).alias("avg_clv"),
        F.count(F.when(F.col("loyalty_tier") == "churn_risk", one)).alias("churn_risk_count"),
    )
    revenue = fact.filter(F.col("status") == "completed").agg(_sum_or_zero(F.col("amount_idr")).alias("total_revenue"))
    is_open = F.col("status").isin(OPEN_STATES)
    support = tickets.agg(
        F.count(F.when(is_open, one)).alias("open_tickets"),
        F.count(F.when(is_open & (F.col("priority") == "critical"), one)).alias("critical_tickets"),
    )
    rows = customers.unionByName(revenue, allowMissingColumns=True).unionByName(support, allowMissingColumns=True)
    names = [
        "total_customers", "avg_clv", "total_revenue", "churn_risk_count", "open_tickets", "critical_tickets",
    ]
    return rows.agg(*[F.max(n).alias(n) for n in names])


def churn_share(kpis: DataFrame) -> DataFrame:
    share = F.col("churn_risk_count") / F.greatest(F.col("total_customers"), F.lit(1)) * 100
    return kpis.select("total_customers", "churn_risk_count", share.alias("churn_pct"))


def identity_funnel(dim: DataFrame) -> DataFrame:
    """Customers per combination of source systems."""
    combo = F.concat_ws(", ", F.sort_array("source_systems")).alias("combo")
    return dim.groupBy(combo).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), "combo")


def tier_mix(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy("loyalty_tier")
        .agg(F.count(F.lit(1)).alias("cnt"), _whole_average("clv_idr").alias("avg_clv"))
        .orderBy(F.desc("avg_clv"), "loyalty_tier")
    )


def revenue_by_type(bookings: DataFrame) -> DataFrame:
    return (
        bookings.filter(F.col("status") == "completed")
        .groupBy("booking_type")
        .agg(F.count(F.lit(1)).alias("cnt"), _sum_or_zero(F.col("amount_idr")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "booking_type")
    )


def monthly_revenue(routes: DataFrame) -> DataFrame:
    """Value per month over all statuses, unlike the completed-only headline revenue."""
    return (
        routes.groupBy("year_month").agg(F.sum("amount_idr_total").alias("total_revenue"))
        .orderBy(F.asc_nulls_last("year_month"))
    )


def _by_city(routes: DataFrame, *extra: Column) -> DataFrame:
    return routes.filter(not_blank(F.col("city"))).groupBy("city").agg(
        F.sum("amount_idr_total").alias("total_revenue"), F.sum("booking_count").alias("booking_count"), *extra
    )


def city_revenue(routes: DataFrame) -> DataFrame:
    return _by_city(routes).orderBy(F.desc_nulls_last("total_revenue"), "city")


def top_destinations(routes: DataFrame, limit: int = 10) -> DataFrame:
    cities = _by_city(routes, F.min("holiday_window").alias("peak_holiday"))
    return cities.orderBy(F.desc_nulls_last("total_revenue"), "city").limit(limit)


def top_customers(dim: DataFrame, limit: int = 10) -> DataFrame:
    return dim.orderBy(F.desc("clv_idr"), _ID).limit(limit).select(
        _ID, hex_id(F.col(_ID)).alias("rcid_hex"), "name_std", "loyalty_tier", "clv_idr", "emails", "phones",
        "dormant_days", "source_systems",
    )


def city_revenue_map(routes: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """City value with its position, and relative to the largest city on the map.

    The largest value is one figure, read by a subquery.
    """
    placed = _by_city(routes).join(gazetteer, "city")
    largest = placed.agg(F.max("total_revenue").alias("largest")).scalar()
    return placed.select(
        "city", "province", "lat", "lng", "total_revenue", "booking_count",
        (F.col("total_revenue") / largest).alias("relative_revenue"),
    )


# ---- customer explorer --------------------------------------------------------------------

_MART_COLUMNS = [
    "loyalty_tier", "clv_idr", "churn_risk_score", "booking_count", "completed_count", "cancelled_count",
    "dormant_days", "last_booking_ts", "recommended_action", "has_support_ticket", "critical_ticket_count",
    "distinct_booking_types",
]
_DIM_COLUMNS = ["name_std", "emails", "phones", "source_systems", "identity_confidence"]


def _matching(mart: DataFrame, dim: DataFrame, where: SearchFilter) -> DataFrame:
    """Mart rows that satisfy all conditions; only ids of the customer table take part in the join.

    The mart has one row per customer, so without a condition on the customer table there is no join.
    """
    figures = mart.select(_ID, *_MART_COLUMNS).filter(where.on_figures())
    if not where.asks_identity():
        return figures
    return figures.join(dim.filter(where.on_identity()).select(_ID), _ID, "left_semi")


def customer_search(
    mart: DataFrame, dim: DataFrame, where: SearchFilter = SearchFilter(), sort_by: str = "clv_desc", limit: int = 100
) -> DataFrame:
    """The first ``limit`` matching customers with their contact lists.

    The page is cut first and then completed from the customer table. Spark's size check decides
    whether the page is broadcast.
    """
    page = _matching(mart, dim, where).orderBy(*sort_order(sort_by)).limit(limit)
    full = dim.select(_ID, *_DIM_COLUMNS).join(page, _ID).orderBy(*sort_order(sort_by)).limit(limit)
    return full.select(
        _ID, hex_id(F.col(_ID)).alias("rcid_hex"), "name_std", *_MART_COLUMNS, "emails", "phones", "source_systems",
        "identity_confidence",
    )


def customer_search_count(mart: DataFrame, dim: DataFrame, where: SearchFilter = SearchFilter()) -> DataFrame:
    return _matching(mart, dim, where).agg(F.count(F.lit(1)).alias("total"))


# ---- one customer in full -----------------------------------------------------------------


def _of_customer(df: DataFrame, rcid_hex: str | None) -> DataFrame:
    """Rows of one customer, or of all of them; the raw id column is compared."""
    if rcid_hex is None:
        return df.filter(F.col(_ID).isNotNull())
    resolved = id_from_hex(rcid_hex)
    return df.filter(F.col(_ID) == resolved) if resolved else df.limit(0)


def customer_profile(dim: DataFrame, mart: DataFrame, rcid_hex: str | None = None) -> DataFrame:
    """Identity and value side by side; an unknown id gives no row."""
    figures = mart.drop("dormant_days", "loyalty_tier").withColumnRenamed("clv_idr", "mart_clv_idr")
    joined = _of_customer(dim, rcid_hex).join(_of_customer(figures, rcid_hex), _ID, "left")
    return joined.withColumn("rcid_hex", hex_id(F.col(_ID)))


_BOOKING_COLUMNS = [
    "booking_id", "booking_type", "provider", "city", "origin", "destination", "amount_idr", "payment_method",
    "booking_ts", "status", "check_in_date", "check_out_date", "departure_ts", "arrival_ts", "activity_date",
    "seat_class", "category", "guests", "participants",
]


def _newest(at: str, key: str) -> list[Column]:
    return [F.col(at).desc_nulls_last(), F.col(key).asc()]


def customer_bookings(fact: DataFrame, rcid_hex: str | None = None) -> DataFrame:
    """Bookings per customer, newest first."""
    rows = _of_customer(fact, rcid_hex).select(_ID, *_BOOKING_COLUMNS)
    return rows.orderBy(_ID, *_newest("booking_ts", "booking_id"))


def _contact_points(dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    emails = dim.select(_ID, F.explode("emails").alias("customer_email"))
    phones = dim.select(_ID, F.explode("phones").alias("customer_phone"))
    return emails, phones


def customer_tickets(dim: DataFrame, tickets: DataFrame, rcid_hex: str | None = None) -> DataFrame:
    """Tickets carrying any email or any phone of a customer, newest first.

    The either-or condition is one equality join over contact points of both kinds, made distinct. It moves ids only;
    texts are fetched for the pairs found. Contact points with many tickets are spread; a shared one shows its tickets
    once per owner, as the list asks for.
    """
    def points(emails: Column, phones: Column) -> Column:
        marked = F.concat(
            F.transform(emails, lambda x: F.concat(F.lit("e:"), x)), F.transform(phones, lambda x: F.concat(F.lit("p:"), x))
        )
        return F.explode(marked).alias("_point")

    one = lambda c: F.when(not_blank(F.col(c)), F.array(c)).otherwise(F.array().cast("array<string>"))
    keyed = tickets.select("ticket_id", points(one("customer_email"), one("customer_phone")))
    owned = _of_customer(dim, rcid_hex).select(_ID, points(F.col("emails"), F.col("phones")))
    held = lookup_join(keyed, owned, "_point", "ticket_id", hot_keys(keyed, "_point"))
    hits = held.filter(F.col(_ID).isNotNull()).select(_ID, F.col("ticket_id").alias("_hit")).distinct()
    found = hits.join(tickets, F.col("_hit").eqNullSafe(F.col("ticket_id"))).select(_ID, *tickets.columns)
    return found.orderBy(_ID, *_newest("created_at", "ticket_id"))


def type_gap(fact: DataFrame) -> DataFrame:
    """Number of booking types per customer and the type booked most, ties by name."""
    known = fact.filter(F.col(_ID).isNotNull())
    per_type = known.groupBy(_ID, "booking_type").agg(F.count(F.lit(1)).alias("n"))
    dominant = F.max_by("booking_type", F.struct("n", "booking_type"))
    return per_type.groupBy(_ID).agg(
        F.count(F.lit(1)).alias("distinct_booking_types"), dominant.alias("booking_type_mode")
    )


def cross_sell_gap(fact: DataFrame) -> DataFrame:
    """Types missing for customers who book a single type."""
    every = F.array(*[F.lit(t) for t in BOOKING_TYPES])
    per_type = fact.filter(F.col(_ID).isNotNull()).select(_ID, "booking_type").distinct()
    single = per_type.groupBy(_ID).agg(F.count(F.lit(1)).alias("n"), F.min("booking_type").alias("booked_type"))
    return single.filter(F.col("n") == 1).select(
        _ID, "booked_type", F.array_except(every, F.array("booked_type")).alias("missing_types")
    )


def booking_mix(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col(_ID).isNotNull()).groupBy(_ID, "booking_type").agg(F.count(F.lit(1)).alias("bookings"))
    )


def booking_timeline(fact: DataFrame) -> DataFrame:
    """Points of the per-customer series, one series per type and status, in time order.

    Points stay rows and the order is a range sort over the whole key, so a customer with very
    many bookings is spread over several tasks.
    """
    points = fact.filter(F.col(_ID).isNotNull()).select(
        _ID, "booking_type", "status", "booking_ts", "amount_idr", "provider", "city", "payment_method", "booking_id"
    )
    return points.orderBy(_ID, "booking_type", "status", F.asc_nulls_last("booking_ts"), "booking_id")


def recent_bookings(fact: DataFrame, k: int = 10) -> DataFrame:
    known = fact.filter(F.col(_ID).isNotNull()).select(
        _ID, "booking_id", "booking_type", "provider", "city", "origin", "destination", "amount_idr", "status",
        "payment_method", "booking_ts",
    )
    return first_rows(known, [_ID], _newest("booking_ts", "booking_id"), k)


def recent_tickets(dim: DataFrame, tickets: DataFrame, k: int = 20) -> DataFrame:
    """The newest ``k`` tickets of every customer.

    Each email and each phone first keeps its own newest ``k``; a customer's newest ``k`` are among
    those, so no contact point shared by many ever meets all of its tickets with all of its owners.
    Ranking moves ids and times only; texts are fetched for the winners.
    """
    newest = _newest("created_at", "ticket_id")
    kept = ["ticket_id", "subject", "status", "priority", "category", "channel", "created_at", "resolved_at",
            "agent_name", "body"]
    parts = []
    for point, owners in zip(("customer_email", "customer_phone"), _contact_points(dim)):
        keyed = tickets.filter(not_blank(F.col(point))).select(point, "ticket_id", "created_at")
        held = lookup_join(owners, first_rows(keyed, [point], newest, k), point, _ID, hot_keys(owners, point))
        parts.append(held.filter(F.col("ticket_id").isNotNull()).select(_ID, "ticket_id", "created_at"))
    hits = parts[0].unionByName(parts[1]).dropDuplicates([_ID, "ticket_id"])
    winners = first_rows(hits, [_ID], newest, k).select(_ID, "ticket_id")
    return winners.join(tickets.select(*kept), "ticket_id").select(_ID, *kept)


def identity_panel(dim: DataFrame) -> DataFrame:
    """One line per email, with the phone, source id and system at the same position."""
    lists = ["emails", "phones", "source_customer_ids", "source_systems"]
    cut = dim.select(_ID, *[F.slice(name, F.lit(1), F.size("emails")).alias(name) for name in lists])
    lines = cut.select(_ID, F.posexplode(F.arrays_zip(*lists)).alias("position", "line"))
    return lines.select(
        _ID, "position", F.col("line.emails").alias("email"), F.col("line.phones").alias("phone"),
        F.col("line.source_customer_ids").alias("source_customer_id"),
        F.col("line.source_systems").alias("source_system"),
    )


# ---- routes -------------------------------------------------------------------------------


def _of_type(routes: DataFrame, route_type: str | None) -> DataFrame:
    return routes if route_type in (None, "all") else routes.filter(F.col("route_type") == route_type)


def route_table(routes: DataFrame, route_type: str | None = None, limit: int = 50) -> DataFrame:
    """Largest routes. Travellers are monthly counts added up, rates are means of monthly rates."""
    grouped = _of_type(routes, route_type).groupBy("route_key", "route_type", "origin", "destination", "city").agg(
        F.sum("booking_count").alias("booking_count"),
        F.sum("unique_travelers").alias("unique_travelers"),
        F.sum("amount_idr_total").alias("amount_idr_total"),
        F.expr("sum(amount_idr_total) div greatest(sum(booking_count), 1)").alias("amount_idr_avg"),
        F.avg("cancel_rate").alias("cancel_rate"),
        F.avg("no_show_rate").alias("no_show_rate"),
        F.min("holiday_window").alias("peak_holiday"),
        F.avg("business_class_share").alias("business_class_share"),
    )
    return grouped.orderBy(F.desc_nulls_last("amount_idr_total"), "route_type", "route_key").limit(limit)


def route_monthly_trend(routes: DataFrame, route_type: str | None = None, top_n: int = 5) -> DataFrame:
    """Monthly value of the ``top_n`` routes, all others folded into ``Other``."""
    rows = _of_type(routes, route_type)
    top = (
        rows.groupBy("route_key").agg(F.sum("amount_idr_total").alias("total"))
        .orderBy(F.desc_nulls_last("total"), "route_key").limit(top_n)
        .select("route_key", F.lit(True).alias("is_top"))
    )
    # The broadcast side holds top_n rows.
    label = F.when(F.col("is_top"), F.col("route_key")).otherwise("Other")
    return (
        rows.join(F.broadcast(top), "route_key", "left")
        .groupBy("year_month", label.alias("route_key"))
        .agg(F.sum("amount_idr_total").alias("amount_idr_total"), F.sum("booking_count").alias("booking_count"))
        .orderBy(F.asc_nulls_last("year_month"), F.desc_nulls_last("amount_idr_total"), "route_key")
    )


def holiday_comparison(routes: DataFrame, route_type: str | None = None) -> DataFrame:
    return (
        _of_type(routes, route_type).filter(not_blank(F.col("holiday_window"))).groupBy("holiday_window")
        .agg(F.sum("amount_idr_total").alias("total_revenue"), F.sum("booking_count").alias("booking_count"))
        .orderBy(F.desc_nulls_last("total_revenue"), "holiday_window")
    )


def business_class(routes: DataFrame, limit: int = 15) -> DataFrame:
    flights = routes.filter((F.col("route_type") == "flight") & F.col("business_class_share").isNotNull())
    return (
        flights.groupBy("route_key")
        .agg(F.avg("business_class_share").alias("business_class_share"), F.sum("booking_count").alias("booking_count"))
        .orderBy(F.desc("business_class_share"), "route_key").limit(limit)
    )
