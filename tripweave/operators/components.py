"""Connected components over contact pairs, for the transitive phone bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.operators.skew import not_blank
from tripweave.session import ensure_checkpoint_dir


def contact_edges(customers: DataFrame, tickets: DataFrame) -> DataFrame:
    """Distinct (email, phone) pairs seen together on a customer or a ticket."""
    pairs = customers.select("email", "phone").unionByName(
        tickets.select(F.col("customer_email").alias("email"), F.col("customer_phone").alias("phone"))
    )
    return pairs.filter(not_blank(F.col("email")) & not_blank(F.col("phone"))).distinct()


def _to_neighbourhood_minimum(edges: DataFrame) -> DataFrame:
    """Pairs (u, v) with the smallest node m among u and all its neighbours.

    The minimum is combined map-side. The pairs of a heavy node are split when it is attached to them again, as
    run-time skew handling may split the side with many rows of a key.
    """
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _mark(edges: DataFrame) -> tuple:
    """Number of pairs and sum of their hashes: equal for equal sets."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for undirected pairs ``(u, v)`` of text nodes; the component is its least node.

    Alternates two star contractions until a round changes nothing, when every node hangs directly under the least
    node of its component. The number of rounds grows with the logarithm of the component size, not with its
    diameter; each round is cut off by a reliable checkpoint and compared by one aggregate.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    current = edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct().checkpoint()
    before, mark = None, _mark(current)
    while mark != before:
        # Large star: hang every larger neighbour under the neighbourhood's least node.
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _to_neighbourhood_minimum(both).filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # Small star: every pair now points from a larger to a smaller node.
        down = large.filter(F.col("u") != F.col("v")).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        )
        hung = _to_neighbourhood_minimum(down)
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            hung.select("u", F.col("m").alias("v"))
        )
        current = small.filter(F.col("u") != F.col("v")).distinct().checkpoint()
        before, mark = mark, _mark(current)
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)


def contact_pairs(customers: DataFrame, tickets: DataFrame) -> DataFrame:
    """Contact edges as pairs ``(u, v)`` of marked nodes."""
    return contact_edges(customers, tickets).select(
        F.concat(F.lit("e:"), "email").alias("u"), F.concat(F.lit("p:"), "phone").alias("v")
    )


def shared_contacts(pairs: DataFrame) -> DataFrame:
    """Each email of a phone linked to the least email of that phone; ``(u, v)`` of marked emails.

    These links join the same emails as the contact pairs. A phone that one email has links nothing, so most pairs end
    in this one shuffle and take no part in the rounds.
    """
    least = pairs.groupBy("v").agg(F.min("u").alias("least"))
    return pairs.join(least, "v").filter("u <> least").select("u", F.col("least").alias("v")).distinct()


def identity_components(customers: DataFrame, flights: DataFrame, experiences: DataFrame, tickets: DataFrame) -> DataFrame:
    """Every known email with the least email it is linked to through shared phones."""
    links = shared_contacts(contact_pairs(customers, tickets))
    return email_components(components(links), customers, flights, experiences, tickets)


def email_components(
    labels: DataFrame, customers: DataFrame, flights: DataFrame, experiences: DataFrame, tickets: DataFrame
) -> DataFrame:
    """The same from the ``(node, component)`` of contact pairs."""
    # Emails sort before phones, so the least node of a component is an email.
    linked = labels.filter(F.col("node").startswith("e:")).select(
        F.substr("node", F.lit(3)).alias("email"), F.substr("component", F.lit(3)).alias("component_email")
    )
    emails = (
        customers.select("email").unionByName(flights.select("email")).unionByName(experiences.select("email"))
        .unionByName(tickets.select(F.col("customer_email").alias("email")))
        .filter(not_blank(F.col("email"))).distinct()
    )
    return emails.join(linked, "email", "left").select(
        "email", F.coalesce("component_email", "email").alias("component_email")
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()


def updated_components(labels: DataFrame, pairs: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """``(node, component)`` of all ``pairs``, from the labels before some were ``added`` and others ``removed``.

    A component that lost a pair is made anew from its own pairs. Added pairs then join components: each end stands for
    its component, so only components that a change touches take part in the rounds, as one node each. All other labels
    are passed on in one pass. Labels and pairs are read several times and should be stored.
    """
    spark = pairs.sparkSession
    ensure_checkpoint_dir(spark)
    torn = labels.join(_ends(removed), "node", "left_semi").select("component").distinct()
    loose = labels.join(torn, "component", "left_semi").select("node").checkpoint()
    whole = labels.join(torn, "component", "left_anti")
    if not loose.isEmpty():
        inner = pairs.join(loose.select(F.col("node").alias("u")), "u", "left_semi").join(
            loose.select(F.col("node").alias("v")), "v", "left_semi"
        )
        # Nodes that lost their last pair have no label any more.
        whole = whole.unionByName(components(inner.select("u", "v")).select("component", "node"))
    whole = whole.select("node", "component").checkpoint()
    fresh = _ends(added).join(whole, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    ends = fresh.checkpoint()
    lifted = added.join(ends.select(F.col("node").alias("u"), F.col("component").alias("cu")), "u").join(
        ends.select(F.col("node").alias("v"), F.col("component").alias("cv")), "v"
    )
    # A component's name is its least node, so the least name is the name of the joined one.
    joined = components(lifted.select(F.col("cu").alias("u"), F.col("cv").alias("v")))
    renamed = joined.select(F.col("node").alias("component"), F.col("component").alias("renamed"))
    every = whole.unionByName(ends.join(whole, "node", "left_anti"))
    return every.join(renamed, "component", "left").select("node", F.coalesce("renamed", "component").alias("component"))


def pair_changes(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs that came and pairs that went, of two sets of different pairs."""
    sides = before.select("u", "v", F.lit(-1).alias("side")).unionByName(after.select("u", "v", F.lit(1).alias("side")))
    balance = sides.groupBy("u", "v").agg(F.sum("side").alias("side"))
    return balance.filter("side > 0").select("u", "v"), balance.filter("side < 0").select("u", "v")
