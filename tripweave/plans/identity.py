"""One customer identity per person across the app, vendor and support sources.

A customer id is a pure function of an email, so most of the resolution needs no join: app rows and
vendor bookings carry the email themselves. Only support tickets have to be looked up, first by
email and then by phone, and they are summarised per contact (email, phone) before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import scoring
from tripweave.functions import temporal as T
from tripweave.functions.identity import resolved_id, scoped
from tripweave.operators.skew import hot_keys, lookup_join, not_blank

# ---- fixed values: confidence ranks and their labels -----------------------------------------
RANK_DIRECT, RANK_PHONE, RANK_EMAIL_ONLY = 3, 2, 1
# -------------------------------------------------------------------------------------------

IDENTITY_COLUMNS = [
    "resolved_customer_id", "source_customer_id", "source_system", "confidence_rank", "first_seen", "last_seen",
    "email", "phone", "name_std", "address_city", "address_province", "address_postal_code",
]


def confidence_label(rank: Column) -> Column:
    return F.when(rank == RANK_DIRECT, "high").when(rank == RANK_PHONE, "phone_bridge").otherwise("email")


# ---- per source ---------------------------------------------------------------------------


def email_universe(customers: DataFrame, flights: DataFrame, experiences: DataFrame, tickets: DataFrame) -> DataFrame:
    """Every distinct non-blank email with its customer id."""
    feeds = [
        customers.select("email"), flights.select("email"), experiences.select("email"),
        tickets.select(F.col("customer_email").alias("email")),
    ]
    emails = feeds[0]
    for feed in feeds[1:]:
        emails = emails.unionByName(feed)
    distinct = emails.filter(not_blank(F.col("email"))).distinct()
    return distinct.withColumn("resolved_customer_id", resolved_id(F.col("email")))


def app_anchors(customers: DataFrame) -> DataFrame:
    """App customers with an email; their id comes straight from it."""
    return customers.filter(not_blank(F.col("email"))).select(
        resolved_id(F.col("email")).alias("resolved_customer_id"),
        "customer_id",
        "email",
        "phone",
        F.col("full_name").alias("name_std"),
        F.col("city").alias("address_city"),
        F.col("province").alias("address_province"),
        F.col("postal_code").alias("address_postal_code"),
        F.col("created_at").alias("first_seen"),
        F.coalesce("updated_at", "created_at").alias("last_seen"),
        scoped("app", F.col("customer_id")).alias("source_customer_id"),
        F.lit("app_oltp").alias("source_system"),
        F.lit(RANK_DIRECT).alias("confidence_rank"),
    )


def vendor_grouped(flights: DataFrame, experiences: DataFrame) -> DataFrame:
    """First and last vendor booking per email, with the value of the completed ones."""
    columns = ["email", "booking_ts", "booking_status", "amount_idr"]
    feed = flights.select(*columns).unionByName(experiences.select(*columns))
    done = F.when(F.col("booking_status") == "completed", F.col("amount_idr"))
    return feed.filter(not_blank(F.col("email"))).groupBy("email").agg(
        F.min("booking_ts").alias("first_seen"),
        F.max("booking_ts").alias("last_seen"),
        F.sum(done).alias("completed_idr"),
    )


def _vendor_row(resolved: Column, rank: int, email: Column) -> list[Column]:
    return [
        resolved.alias("resolved_customer_id"),
        scoped("vendor", email).alias("source_customer_id"),
        F.lit("vendor_api").alias("source_system"),
        F.lit(rank).alias("confidence_rank"),
        F.col("first_seen"),
        F.col("last_seen"),
        email.alias("email"),
        F.lit("").alias("phone"),
    ]


def vendor_identities(vendors: DataFrame, anchors: DataFrame) -> DataFrame:
    """Vendor emails no app customer has."""
    alone = vendors.join(anchors.select("email").distinct(), "email", "left_anti")
    nothing = [
        F.lit(None).cast("string").alias(c)
        for c in ("name_std", "address_city", "address_province", "address_postal_code")
    ]
    return alone.select(*_vendor_row(resolved_id(F.col("email")), RANK_EMAIL_ONLY, F.col("email")), *nothing)


def vendor_links(vendors: DataFrame, anchors: DataFrame) -> DataFrame:
    """Vendor emails of app customers, one row per app customer with that email."""
    seen = vendors.select("email", "first_seen", "last_seen", F.lit(True).alias("linked"))
    people = anchors.drop("first_seen", "last_seen", "phone")
    linked = lookup_join(people, seen, "email", "customer_id", hot_keys(people, "email"))
    return linked.filter(F.col("linked")).select(
        *_vendor_row(F.col("resolved_customer_id"), RANK_DIRECT, F.col("email")),
        "name_std", "address_city", "address_province", "address_postal_code",
    )


def phone_owners(anchors: DataFrame) -> DataFrame:
    """Distinct pairs of phone and customer id among the app customers."""
    return anchors.filter(not_blank(F.col("phone"))).select("phone", "resolved_customer_id").distinct()


def crm_candidates(tickets: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every ticket with each customer it supports: by email, else by phone, else by its own email.

    A ticket whose phone belongs to several customers appears once per customer; a ticket with
    neither email nor known phone keeps a NULL customer. This row form is for inspection only, the
    models use :func:`ticket_summaries`, which stays linear when a phone is shared by many.
    """
    known = anchors.select("email").distinct().withColumn("email_known", F.lit(True))
    # Only contacts and the few columns of the result pass through the joins; the id follows from the email after them.
    contact = ["customer_email", "customer_phone"]
    rows = tickets.select("ticket_id", *contact, "customer_name", "created_at", F.col("customer_email").alias("email"))
    flagged = lookup_join(
        rows, known, "email", "ticket_id", hot_keys(tickets.select(F.col("customer_email").alias("email")), "email"), contact
    ).drop("email")
    bridge = F.when(F.col("email_known").isNull() & not_blank(F.col("customer_phone")), F.col("customer_phone"))
    owners = phone_owners(anchors).withColumnRenamed("resolved_customer_id", "by_phone")
    out = lookup_join(
        flagged.withColumn("phone", bridge), owners, "phone", "ticket_id",
        hot_keys(tickets.select(F.col("customer_phone").alias("phone")), "phone"), contact,
    ).withColumn("by_email", F.when(F.col("email_known"), resolved_id(F.col("customer_email"))))
    own = F.when(not_blank(F.col("customer_email")), resolved_id(F.col("customer_email")))
    return out.select(
        F.coalesce("by_email", "by_phone", own).alias("resolved_customer_id"),
        "ticket_id",
        "customer_email",
        "customer_phone",
        F.col("customer_name").alias("name_std"),
        F.col("created_at").alias("first_seen"),
        F.col("created_at").alias("last_seen"),
        scoped("crm", F.col("ticket_id")).alias("source_customer_id"),
        F.lit("crm").alias("source_system"),
        F.when(F.col("by_email").isNotNull(), RANK_DIRECT).when(F.col("by_phone").isNotNull(), RANK_PHONE)
        .otherwise(RANK_EMAIL_ONLY).alias("confidence_rank"),
    )


def identity_rows(anchors: DataFrame, vendors: DataFrame, tickets: DataFrame) -> DataFrame:
    """All source records with the customer they belong to, in one shape."""
    crm = crm_candidates(tickets, anchors).select(
        "resolved_customer_id", "source_customer_id", "source_system", "confidence_rank", "first_seen", "last_seen",
        F.col("customer_email").alias("email"), F.col("customer_phone").alias("phone"), "name_std",
    )
    out = anchors.select(*IDENTITY_COLUMNS)
    for part in (vendor_identities(vendors, anchors), vendor_links(vendors, anchors)):
        out = out.unionByName(part)
    return out.unionByName(crm, allowMissingColumns=True).select(*IDENTITY_COLUMNS)


# ---- support tickets, summarised ----------------------------------------------------------


def contacts(tickets: DataFrame) -> DataFrame:
    """Tickets summarised per (email, phone); everything later works on these few rows of fixed width."""
    scid = scoped("crm", F.col("ticket_id"))
    hours = T.hours_between(F.col("created_at"), F.col("resolved_at"))
    named = F.when(F.col("customer_name").isNotNull(), F.struct("created_at", scid.alias("scid"), "customer_name"))
    return tickets.groupBy("customer_email", "customer_phone").agg(
        F.min("created_at").alias("first_seen"),
        F.max("created_at").alias("last_seen"),
        F.count(F.lit(1)).alias("tickets"),
        F.sum((F.col("priority") == "critical").cast("bigint")).alias("critical"),
        F.sum(hours).alias("hours"),
        F.count(hours).alias("timed"),
        F.max(named).alias("named"),
    )


def _routed_contacts(rows: DataFrame, anchors: DataFrame, emails: DataFrame, phones: DataFrame) -> DataFrame:
    """Contacts with the value that links them to customers; ``emails`` and ``phones`` tell which are hot.

    ``link`` is ``email`` when the email is an app customer's or nothing better is known, ``phone``
    when only the phone is an app customer's, NULL when the contact carries neither.
    """
    known_emails = anchors.select("email").distinct().withColumn("email_known", F.lit(True))
    known_phones = (
        anchors.filter(not_blank(F.col("phone"))).select("phone").distinct().withColumn("phone_known", F.lit(True))
    )
    contact_id = F.concat_ws(
        "\u0001", F.coalesce("customer_email", F.lit("")), F.coalesce("customer_phone", F.lit(""))
    )
    rows = rows.withColumns({"email": F.col("customer_email"), "contact_id": contact_id})
    rows = lookup_join(
        rows, known_emails, "email", "contact_id",
        hot_keys(emails.select(F.col("customer_email").alias("email")), "email"),
    )
    # Only contacts without a known email go on to the phone lookup.
    bridge = F.when(F.col("email_known").isNull() & not_blank(F.col("customer_phone")), F.col("customer_phone"))
    rows = lookup_join(
        rows.withColumn("phone", bridge), known_phones, "phone", "contact_id",
        hot_keys(phones.select(F.col("customer_phone").alias("phone")), "phone"),
    )
    has_email = not_blank(F.col("customer_email"))
    return rows.withColumns(
        {
            "link": F.when(F.col("phone_known"), "phone").when(has_email, "email"),
            "link_value": F.when(F.col("phone_known"), F.col("phone")).when(has_email, F.col("customer_email")),
            "confidence_rank": F.when(F.col("email_known"), RANK_DIRECT).when(F.col("phone_known"), RANK_PHONE)
            .otherwise(RANK_EMAIL_ONLY),
        }
    )


def ticket_links(tickets: DataFrame, anchors: DataFrame) -> DataFrame:
    """Ticket figures per linking email or phone; tickets that reach nobody form the NULL link.

    Stored as a table of its own, because both the customers and their support figures need it.
    """
    return _links(_routed_contacts(contacts(tickets), anchors, tickets, tickets))


def contact_links(kept: DataFrame, anchors: DataFrame) -> DataFrame:
    """The same from stored contacts (:data:`tripweave.plans.kept.CONTACTS`), without looking at tickets again."""
    return _links(_routed_contacts(kept, anchors, kept, kept))


def _links(routed: DataFrame) -> DataFrame:
    return routed.groupBy("link", "link_value", "confidence_rank").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("tickets").alias("tickets"),
        F.sum("critical").alias("critical"),
        F.sum("hours").alias("hours"),
        F.sum("timed").alias("timed"),
        F.max("named").alias("named"),
    )


def ticket_summaries(links: DataFrame, anchors: DataFrame) -> DataFrame:
    """Ticket figures per customer and link.

    A customer id follows from a linking email without a join. For phones, every (phone, customer)
    pair looks up the one row of its phone, so a phone with many tickets and many customers costs
    one row per customer, not one per ticket and customer.
    """
    direct = links.filter(F.col("link") == "email").withColumn(
        "resolved_customer_id", resolved_id(F.col("link_value"))
    )
    by_phone = links.filter(F.col("link") == "phone").withColumnRenamed("link_value", "phone").drop("link")
    owners = phone_owners(anchors)
    bridged = lookup_join(owners, by_phone, "phone", "resolved_customer_id", hot_keys(owners, "phone"))
    return direct.drop("link", "link_value").unionByName(
        bridged.filter(F.col("tickets").isNotNull()).drop("phone")
    )


def unresolved_tickets(links: DataFrame) -> DataFrame:
    """How many tickets reach no customer at all."""
    return links.filter(F.col("link").isNull()).agg(F.coalesce(F.sum("tickets"), F.lit(0)).alias("tickets"))


def support_agg(summaries: DataFrame) -> DataFrame:
    """Support figures per customer."""
    return summaries.groupBy("resolved_customer_id").agg(
        F.sum("critical").alias("critical_ticket_count"),
        (F.sum("hours") / F.nullif(F.sum("timed"), F.lit(0).cast("bigint"))).alias("avg_resolution_hours"),
        F.lit(1).cast("bigint").alias("has_support_ticket"),
    )


# ---- customers ----------------------------------------------------------------------------


def hotel_spent(hotels: DataFrame) -> DataFrame:
    """Completed hotel value per app customer."""
    done = hotels.filter(F.col("booking_status") == "completed")
    return done.groupBy("customer_id").agg(F.sum("amount_idr").alias("clv_idr"))


def _hotel_value(spent: DataFrame, anchors: DataFrame) -> DataFrame:
    """Hotel value per resolved customer, summed before it is joined."""
    spent = spent.select("customer_id", "clv_idr")
    return anchors.select("customer_id", "resolved_customer_id").join(spent, "customer_id").drop("customer_id")


def clv_by_resolved(
    anchors: DataFrame, vendors: DataFrame, hotels: DataFrame, links: DataFrame, dedupe_source_ids: bool = True
) -> DataFrame:
    """Lifetime value per customer: the sum of its completed bookings.

    With ``dedupe_source_ids=False`` the vendor value counts once per app customer sharing the
    email, the way a join over the undeduplicated source records would count it.
    """
    vendor = vendors.select("email", F.col("completed_idr").alias("clv_idr"))
    if not dedupe_source_ids:
        sharing = anchors.groupBy("email").agg(F.count(F.lit(1)).alias("n"))
        vendor = vendor.join(sharing, "email", "left").withColumn(
            "clv_idr", F.col("clv_idr") * F.coalesce("n", F.lit(1))
        )
    no_value = F.lit(None).cast("bigint").alias("clv_idr")
    everyone = anchors.select("resolved_customer_id", no_value).unionByName(
        ticket_summaries(links, anchors).select("resolved_customer_id", no_value)
    )
    value = _hotel_value(hotel_spent(hotels), anchors).unionByName(
        vendor.select(resolved_id(F.col("email")).alias("resolved_customer_id"), "clv_idr")
    )
    return everyone.unionByName(value).groupBy("resolved_customer_id").agg(
        F.coalesce(F.sum("clv_idr"), F.lit(0).cast("bigint")).alias("clv_idr")
    )


def customer_keys(anchors: DataFrame, vendors: DataFrame) -> DataFrame:
    """Source-scoped booking keys with their customer, one row per key."""
    known = anchors.select("email").distinct().withColumn("known", F.lit(RANK_DIRECT))
    rank = F.coalesce("known", F.lit(RANK_EMAIL_ONLY))
    vendor = vendors.select("email").join(known, "email", "left").select(
        scoped("vendor", F.col("email")).alias("source_customer_id"),
        resolved_id(F.col("email")).alias("resolved_customer_id"),
        confidence_label(rank).alias("identity_confidence"),
    )
    app = anchors.select(
        "source_customer_id", "resolved_customer_id",
        confidence_label(F.col("confidence_rank")).alias("identity_confidence"),
    )
    return app.unionByName(vendor)


LISTS = {"emails": "email", "phones": "phone", "source_customer_ids": "source_customer_id"}


def customer_records(anchors: DataFrame, vendors: DataFrame, tickets: DataFrame) -> DataFrame:
    """Membership: one row per source record and customer, with the contacts of the record."""
    return identity_rows(anchors, vendors, tickets).select("resolved_customer_id", "source_customer_id", "email", "phone")


def with_lists(dim: DataFrame, records: DataFrame) -> DataFrame:
    """The customer table with the sorted lists of emails, phones and source ids of each customer.

    ``records`` is the membership table (:func:`customer_records`), one row per source record and
    customer. The lists are made from its different values at the very end, so no list passes
    through a join but the last one. A customer with very many records has one very long row, as
    the list form asks for; the membership table holds the same without that.
    """
    def all_of(name: str) -> Column:
        return F.sort_array(F.collect_set(F.when(not_blank(F.col(name)), F.col(name))))

    lists = records.filter(F.col("resolved_customer_id").isNotNull()).groupBy("resolved_customer_id").agg(
        *[all_of(source).alias(name) for name, source in LISTS.items()]
    )
    joined = dim.join(lists, "resolved_customer_id")
    first = ["resolved_customer_id", "emails", "phones"]
    middle = ["name_std", "address_city", "address_province", "address_postal_code", "source_customer_ids"]
    return joined.select(*first, *middle, *[c for c in dim.columns if c not in first + middle])


def dim_customer(customers: DataFrame, hotels: DataFrame, vendors: DataFrame, links: DataFrame, as_of: str) -> DataFrame:
    """One row per resolved customer, without lists; :func:`with_lists` adds those."""
    return customer_rows(customers, hotel_spent(hotels), vendors, links, as_of)


def customer_rows(customers: DataFrame, spent: DataFrame, vendors: DataFrame, links: DataFrame, as_of: str) -> DataFrame:
    """The customer table from figures per source key, so that nothing else looks at bookings or tickets.

    ``spent`` comes from :func:`hotel_spent`, ``vendors`` from :func:`vendor_grouped` and ``links`` from :func:`ticket_links`. Each
    source is reduced to one row per source key, the rows are united and a single grouping by
    customer id produces every column, the lifetime value included.
    """
    anchors = app_anchors(customers)

    def pick(value: str) -> Column:
        col = F.col(value)
        best = F.struct("confidence_rank", "last_seen", "source_customer_id", col.alias("value"))
        return F.when(col.isNotNull(), best)

    app_rows = anchors.select(
        "resolved_customer_id", "confidence_rank", "first_seen", "last_seen",
        F.lit("app_oltp").alias("source_system"),
        pick("name_std").alias("name_std"),
        pick("address_city").alias("address_city"),
        pick("address_province").alias("address_province"),
        pick("address_postal_code").alias("address_postal_code"),
    )
    vendor_rows = vendors.select(
        resolved_id(F.col("email")).alias("resolved_customer_id"),
        F.lit(RANK_EMAIL_ONLY).alias("confidence_rank"),
        "first_seen", "last_seen",
        F.lit("vendor_api").alias("source_system"),
        F.col("completed_idr").alias("clv_idr"),
    )
    hotel_rows = _hotel_value(spent, anchors)

    crm_name = F.struct(
        "confidence_rank",
        F.col("named.created_at").alias("last_seen"),
        F.col("named.scid").alias("source_customer_id"),
        F.col("named.customer_name").alias("value"),
    )
    crm_rows = ticket_summaries(links, anchors).select(
        "resolved_customer_id", "confidence_rank", "first_seen", "last_seen",
        F.lit("crm").alias("source_system"),
        F.when(F.col("named").isNotNull(), crm_name).alias("name_std"),
    )
    rows = app_rows
    for part in (vendor_rows, hotel_rows, crm_rows):
        rows = rows.unionByName(part, allowMissingColumns=True)

    grouped = rows.groupBy("resolved_customer_id").agg(
        F.max("name_std").alias("name_std"),
        F.max("address_city").alias("address_city"),
        F.max("address_province").alias("address_province"),
        F.max("address_postal_code").alias("address_postal_code"),
        F.sort_array(F.collect_set("source_system")).alias("source_systems"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.max("confidence_rank").alias("max_rank"),
        F.coalesce(F.sum("clv_idr"), F.lit(0).cast("bigint")).alias("clv_idr"),
    )
    dormant = grouped.withColumn("dormant_days", T.days_since(F.col("last_seen"), as_of))
    return dormant.select(
        "resolved_customer_id",
        F.col("name_std.value").alias("name_std"),
        F.col("address_city.value").alias("address_city"),
        F.col("address_province.value").alias("address_province"),
        F.col("address_postal_code.value").alias("address_postal_code"),
        "source_systems", "first_seen", "last_seen", "dormant_days",
        confidence_label(F.col("max_rank")).alias("identity_confidence"),
        "clv_idr",
        scoring.loyalty_tier(F.col("clv_idr"), F.col("dormant_days")).alias("loyalty_tier"),
    )
