from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tripweave.functions.identity import resolved_id
from tripweave.operators.components import components, identity_components, shared_contacts
from tripweave.plans import facts, identity, marts, serving
from tripweave.schema import GOLD_KEYS

TICKET = (
    "ticket_id string, customer_email string, customer_phone string, customer_name string, subject string, "
    "body string, status string, priority string, channel string, created_at timestamp, resolved_at timestamp, "
    "category string, agent_name string"
)


def customers(spark, rows):
    """(customer_id, email, phone, name)"""
    df = spark.createDataFrame(rows, "customer_id string, email string, phone string, full_name string")
    at = F.lit("2026-01-01 00:00:00").cast("timestamp")
    text = F.lit(None).cast("string")
    return df.withColumns(
        {"city": text, "province": text, "postal_code": text, "created_at": at, "updated_at": at}
    )


def tickets(spark, rows):
    """(ticket_id, email, phone, priority)"""
    df = spark.createDataFrame(rows, "ticket_id string, customer_email string, customer_phone string, priority string")
    at = F.lit("2026-02-01 10:59:00").cast("timestamp")
    return df.withColumns(
        {"customer_name": F.concat(F.lit("N "), "ticket_id"), "created_at": at,
         "resolved_at": (at + F.expr("interval 61 minutes"))}
    )


def ids(spark, *emails):
    df = spark.createDataFrame([(i, e) for i, e in enumerate(emails)], "i int, e string")
    return [r[0] for r in df.orderBy("i").select(resolved_id(F.col("e"))).collect()]


@pytest.fixture(scope="module")
def people(spark):
    return identity.app_anchors(
        customers(
            spark,
            [("C1", "a@x.id", "+62811", "Ani"), ("C2", "b@x.id", "+62822", "Budi"), ("C3", "c@x.id", "+62822", "Cici"),
             ("C4", None, "+62844", "Dedi"), ("C5", "a@x.id", None, "Ani Dua"), ("C6", "", "+62811", "Eka")],
        )
    )


@pytest.fixture(scope="module")
def crm(spark):
    return tickets(
        spark,
        [("T1", "a@x.id", "+62822", "critical"),  # the email beats the phone
         ("T2", "work@y.id", "+62822", "critical"),  # phone of two customers
         ("T3", "solo@y.id", "+62999", "low"),  # stands on its own email
         ("T4", None, None, "critical"),  # nobody
         ("T5", None, "+62844", "low"),  # phone of a customer without email
         ("T6", None, "+62811", "critical")],  # phone bridge without email
    )


def test_candidates(spark, people, crm):
    a, b, c, solo = ids(spark, "a@x.id", "b@x.id", "c@x.id", "solo@y.id")
    got = {(r["ticket_id"], r["resolved_customer_id"], r["confidence_rank"])
           for r in identity.crm_candidates(crm, people).collect()}
    assert got == {("T1", a, 3), ("T2", b, 2), ("T2", c, 2), ("T3", solo, 1), ("T4", None, 1), ("T5", None, 1),
                   ("T6", a, 2)}


def test_summaries_agree_with_candidates(spark, people, crm):
    links = identity.ticket_links(crm, people)
    summed = {r["resolved_customer_id"]: (r["n"], r["c"], r["h"]) for r in identity.ticket_summaries(links, people)
              .groupBy("resolved_customer_id").agg(F.sum("tickets").alias("n"), F.sum("critical").alias("c"),
                                                   F.sum("hours").alias("h")).collect()}
    a, b, c, solo = ids(spark, "a@x.id", "b@x.id", "c@x.id", "solo@y.id")
    # 10:59 to 12:00 crosses two hour boundaries.
    assert summed == {a: (2, 2, 4), b: (1, 1, 2), c: (1, 1, 2), solo: (1, 0, 2)}
    assert identity.unresolved_tickets(links).first()[0] == 2


def test_customers_without_email_stay_unresolved(people):
    assert {r["customer_id"] for r in people.collect()} == {"C1", "C2", "C3", "C5"}


def test_shared_hot_phone_stays_linear(spark):
    """300 customers and 300 tickets on one phone: figures are right and rows grow with the sum."""
    who = [(f"C{i}", f"u{i}@x.id", "+62800", "X") for i in range(300)]
    people = identity.app_anchors(customers(spark, who))
    crm = tickets(spark, [(f"T{i}", None, "+62800", "critical" if i % 3 == 0 else "low") for i in range(300)])
    links = identity.ticket_links(crm, people)
    assert links.count() == 1
    summaries = identity.ticket_summaries(links, people)
    assert summaries.count() == 300
    support = identity.support_agg(summaries).collect()
    assert len(support) == 300
    assert {(r["critical_ticket_count"], r["avg_resolution_hours"]) for r in support} == {(100, 2.0)}


def test_recent_tickets_equal_brute_force(spark):
    rng = random.Random(3)
    dim_rows = [(f"r{i}", [f"e{rng.randrange(12)}"], [f"p{rng.randrange(4)}" for _ in range(rng.randrange(3))])
                for i in range(30)]
    rows = [(f"T{i:04d}", rng.choice([None, *[f"e{j}" for j in range(12)]]),
             rng.choice([None, "", *[f"p{j}" for j in range(4)]]), i % 97) for i in range(400)]
    dim = spark.createDataFrame(dim_rows, "resolved_customer_id string, emails array<string>, phones array<string>")
    crm = spark.createDataFrame(rows, "ticket_id string, customer_email string, customer_phone string, n int").withColumns(
        {"created_at": F.timestamp_seconds("n"),
         **{c: F.lit("x") for c in ("subject", "status", "priority", "category", "channel", "agent_name", "body")},
         "resolved_at": F.lit(None).cast("timestamp")})
    got = {}
    for r in serving.recent_tickets(dim, crm, 5).collect():
        got.setdefault(r["resolved_customer_id"], set()).add(r["ticket_id"])
    want = {}
    for rid, emails, phones in dim_rows:
        mine = [t for t in rows if t[1] in emails or (t[2] and t[2] in phones)]
        top = sorted(mine, key=lambda t: (-t[3], t[0]))[:5]
        if top:
            want[rid] = {t[0] for t in top}
    assert got == want


def test_long_emails_are_linked_and_whole(spark):
    """Emails beyond a thousand characters keep every character on their way through the bridge."""
    long = "a" * 1_200 + "@x.id"
    who = customers(spark, [("C1", long, "+62800", "A"), ("C2", "b@x.id", "+62800", "B")])
    none = spark.createDataFrame([], "email string")
    got = identity_components(who, none, none, tickets(spark, [("T1", "c@x.id", "+62800", "low")])).collect()
    assert {(r["email"], r["component_email"]) for r in got} == {(long, long), ("b@x.id", long), ("c@x.id", long)}


def test_shared_phone_with_many_tickets_moves_few_rows(spark):
    """Ten thousand tickets and a thousand owners on one phone: what the figures need stays linear."""
    owner = spark.range(1_000).select(
        F.concat(F.lit("C"), "id").alias("customer_id"), F.concat(F.lit("u"), "id", F.lit("@x.id")).alias("email"),
        F.lit("+62800").alias("phone"), F.lit("X").alias("full_name"),
    )
    text, at = F.lit(None).cast("string"), F.lit("2026-01-01 00:00:00").cast("timestamp")
    people = identity.app_anchors(owner.withColumns({"city": text, "province": text, "postal_code": text, "created_at": at, "updated_at": at}))
    crm = spark.range(10_000).select(
        F.concat(F.lit("T"), "id").alias("ticket_id"), text.alias("customer_email"), F.lit("+62800").alias("customer_phone"),
        F.lit("low").alias("priority"), text.alias("customer_name"), at.alias("created_at"), at.alias("resolved_at"),
    )
    links = identity.ticket_links(crm, people)
    assert not any(f.dataType.typeName() == "array" for f in links.schema.fields)
    assert identity.ticket_summaries(links, people).agg(F.count("*"), F.sum("tickets")).first()[:] == (1_000, 10_000_000)


def _union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components_equal_brute_force(spark, shape):
    if shape == "chain":
        edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(120)]
    elif shape == "star":
        edges = [("hub", f"n{i:03d}") for i in range(200)] + [("x", "y")]
    else:
        rng = random.Random(5)
        edges = [(f"n{rng.randrange(300):03d}", f"m{rng.randrange(300):03d}") for _ in range(260)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == _union_find(edges)


# ---- invariants over the test tables --------------------------------------------------------


def test_gold_keys_are_unique(tables):
    for name, key in GOLD_KEYS.items():
        df = tables.table(name)
        assert df.count() == df.select(key).distinct().count() == df.filter(F.col(key).isNotNull()).count(), name


def test_identity_join_neither_adds_nor_loses_bookings(tables):
    bookings, fact = tables.bookings(), tables.table("fact_bookings")
    total = F.sum("amount_idr")
    assert bookings.count() == fact.count()
    assert bookings.agg(total).first() == fact.agg(total).first()


def test_keys_match_the_stored_arrays(tables):
    stored = tables.table("dim_customer").select(
        F.explode("source_customer_ids").alias("source_customer_id"), "resolved_customer_id", "identity_confidence"
    ).filter(~F.col("source_customer_id").startswith("crm:"))
    assert stored.exceptAll(tables.customer_keys()).count() == 0
    assert stored.count() == tables.customer_keys().count()


def test_customer_value_agrees_between_tables(tables):
    dim = tables.table("dim_customer").select("resolved_customer_id", "clv_idr")
    mart = tables.table("mart_customer_clv").select("resolved_customer_id", "clv_idr")
    assert dim.exceptAll(mart).count() == 0


def test_scores_and_tiers_are_in_range(tables):
    mart = tables.table("mart_customer_clv")
    assert mart.filter("churn_risk_score < 0 or churn_risk_score > 1 or churn_risk_score is null").count() == 0
    assert {r[0] for r in mart.select("loyalty_tier").distinct().collect()} <= {"gold", "silver", "churn_risk"}


def test_customers_without_lists(tables):
    t = tables
    lean = identity.dim_customer(
        t.table("silver_customers"), t.table("silver_hotel_bookings"), t.table("vendor_emails"),
        identity.ticket_links(t.table("silver_tickets"), t.anchors()), t.as_of,
    )
    assert "collect_" not in lean._jdf.queryExecution().executedPlan().toString().replace("collect_set(source_system", "")
    full = t.table("dim_customer")
    assert "emails" not in lean.columns
    assert full.select(*lean.columns).exceptAll(lean).count() == 0


def test_placeholders_resolve_later(spark, tables):
    before = facts.fact_bookings(tables.bookings(), tables.customer_keys().limit(0), placeholders=True)
    assert before.filter("resolved_customer_id is null").count() == 0
    assert before.filter("resolved_customer_id like 'ph_%'").count() == before.count()
    after = facts.fact_bookings(tables.bookings(), tables.customer_keys(), placeholders=True)
    assert after.filter("identity_confidence = 'placeholder'").count() < before.count()


def test_latest_type_ignores_missing_times(spark):
    rows = [("r", "hotel", "2026-01-01 00:00:00", "b1"), ("r", "flight", None, "b2"), ("s", "flight", None, "b3")]
    df = spark.createDataFrame(rows, "resolved_customer_id string, booking_type string, ts string, booking_id string")
    fact = df.withColumns(
        {"booking_ts": F.col("ts").cast("timestamp"), "status": F.lit("completed"), "amount_idr": F.lit(5).cast("bigint")}
    )
    got = {r["resolved_customer_id"]: (r["most_recent_booking_type"], r["distinct_booking_types"])
           for r in marts.bookings_agg(fact).collect()}
    assert got == {"r": ("hotel", 2), "s": (None, 1)}


def test_unknown_customer_gives_no_rows(tables):
    dim, mart = tables.table("dim_customer"), tables.table("mart_customer_clv")
    for unknown in ("72635F" + "0" * 24, "not hex"):
        assert serving.customer_profile(dim, mart, unknown).count() == 0
        assert serving.customer_bookings(tables.table("fact_bookings"), unknown).count() == 0


def test_ticket_texts_are_not_shuffled(spark):
    """Customers of tickets are looked up with the contacts; subject and body stay where they are."""
    text, at = F.lit(None).cast("string"), F.lit("2026-01-01 00:00:00").cast("timestamp")
    crm = spark.range(100).select(
        F.concat(F.lit("T"), "id").alias("ticket_id"), F.concat(F.lit("u"), "id", F.lit("@x.id")).alias("customer_email"),
        F.concat(F.lit("+62"), "id").alias("customer_phone"), text.alias("customer_name"), at.alias("created_at"),
        F.concat(F.lit("s"), "id").alias("subject"), F.concat(F.lit("b"), "id").alias("body"),
    )
    people = identity.app_anchors(customers(spark, [("C1", "u1@x.id", "+622", "A"), ("C2", "a@x.id", "+622", "B")]))
    got = identity.crm_candidates(crm, people)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "body" not in plan and "subject" not in plan
    linked = {r["ticket_id"]: r["confidence_rank"] for r in got.filter("confidence_rank > 1").collect()}
    assert linked == {"T1": 3, "T2": 2}


@pytest.mark.parametrize("seed", range(3))
def test_links_of_shared_phones_join_the_same_emails(spark, seed):
    rng = random.Random(seed)
    rows = sorted({(f"e:{rng.randrange(60)}", f"p:{rng.randrange(70)}") for _ in range(75)})
    pairs = spark.createDataFrame(rows, "u string, v string")
    links = shared_contacts(pairs)
    emails = {r["node"]: r["component"] for r in components(links).collect()}
    whole = {r["node"]: r["component"] for r in components(pairs).collect()}
    assert {e: emails.get(e, e) for e, _ in rows} == {e: whole[e] for e, _ in rows}
    assert links.count() <= len(rows) - len({p for _, p in rows})
