"""Lists in chunks: no long row, nothing lost."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from tripweave.plans import lists

SHAPE = "resolved_customer_id string, source_customer_id string, email string, phone string"


def test_a_phone_with_many_tickets(spark):
    hot = spark.range(100_000).select(
        F.lit("rc_hot").alias("resolved_customer_id"), F.concat(F.lit("crm:"), F.col("id")).alias("source_customer_id"),
        F.lit(None).cast("string").alias("email"), F.lit("+62811").alias("phone"),
    )
    few = spark.createDataFrame([("rc_a", "app:1", "a@x", ""), ("rc_a", "app:1", "b@x", None), (None, "crm:x", "c@x", "+1")], SHAPE)
    chunks = lists.chunked_lists(hot.unionByName(few), 1_000).collect()
    assert max(r["n_values"] for r in chunks) == 1_000 == max(len(r["values"]) for r in chunks)
    whole = defaultdict(list)
    for r in sorted(chunks, key=lambda r: r["chunk"]):
        assert r["chunk"] == len(whole[r["resolved_customer_id"], r["list"]]) // 1_000
        whole[r["resolved_customer_id"], r["list"]] += r["values"]
    assert whole.pop(("rc_hot", "source_customer_ids")) == sorted(f"crm:{k}" for k in range(100_000))
    assert dict(whole) == {("rc_hot", "phones"): ["+62811"], ("rc_a", "emails"): ["a@x", "b@x"], ("rc_a", "source_customer_ids"): ["app:1"]}


def test_long_lists_are_spread(spark):
    """The values of one customer are dealt to many tasks before they are numbered."""
    rows = spark.range(20_000).select(
        F.lit("rc").alias("resolved_customer_id"), F.concat(F.lit("k"), F.col("id")).alias("source_customer_id"),
        F.lit("").alias("email"), F.lit("").alias("phone"),
    )
    dealt = lists.list_values(rows).repartitionByRange(8, "resolved_customer_id", "list", "value")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 5_000


def test_short_lists(spark):
    rows = spark.createDataFrame([("rc", f"k{i}", "a@x", None) for i in range(5)], SHAPE)
    out = {r["list"]: (r["n_values"], r["values"]) for r in lists.short_lists(lists.chunked_lists(rows, 4)).collect()}
    assert out == {"emails": (1, ["a@x"]), "source_customer_ids": (5, None)}
    assert lists.chunked_lists(rows.limit(0)).count() == 0
