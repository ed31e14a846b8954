"""Joins whose keys are missing or concentrated."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripweave.operators.dedupe import first_rows
from tripweave.operators.skew import hot_keys, lookup_join

ROWS = 30_000


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a tenth without any."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    )
    return spark.range(ROWS).select(F.col("id").cast("string").alias("row_id"), key.alias("k"))


@pytest.fixture(scope="module")
def lookup(spark, facts):
    known = facts.select("k").filter("k is not null and k <> 'k7'").distinct()
    return known.withColumn("v", F.upper("k"))


def test_hot_keys_lists_only_large_ones(facts):
    found = hot_keys(facts, "k", parts=30).collect()
    assert [(r["k"], r["_copies"]) for r in found] == [("hot", 11)]
    assert hot_keys(facts, "k", parts=1).count() == 0
    assert hot_keys(facts.limit(0), "k", parts=1_000).count() == 0


def test_every_hot_key_is_listed(spark):
    """Five thousand large keys are all spread; the copies stay within twice the number of parts."""
    rows = spark.range(200_000).select((F.col("id") % 5_000).cast("string").alias("k"))
    found = hot_keys(rows, "k", parts=5_001)
    assert found.count() == 5_000
    assert found.agg(F.sum("_copies")).first()[0] <= 2 * 5_001


def test_rows_without_key_and_id_are_spread(spark, lookup):
    rows = spark.range(1_000).select(F.lit(None).cast("string").alias("k"), F.lit(None).cast("string").alias("row_id"), "id")
    got = lookup_join(rows, lookup, "k", "row_id", hot_keys(rows, "k"))
    assert got.count() == 1_000 and got.filter("v is not null").count() == 0


@pytest.mark.parametrize("salted", [False, True])
def test_lookup_join_equals_plain_join(facts, lookup, salted):
    hot = hot_keys(facts, "k", parts=30) if salted else None
    got = lookup_join(facts, lookup, "k", "row_id", hot)
    plain = facts.join(lookup, "k", "left").select("row_id", "k", "v")
    assert got.count() == ROWS
    assert got.select("row_id", "k", "v").exceptAll(plain).count() == 0


def test_lookup_join_keeps_every_match(spark, facts):
    owners = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k1", "c")], "k string, v string")
    got = lookup_join(facts, owners, "k", "row_id", hot_keys(facts, "k", parts=30))
    plain = facts.join(owners, "k", "left")
    assert got.count() == plain.count()
    assert got.filter("k = 'hot'").groupBy("v").count().count() == 2


def test_hot_and_missing_keys_are_spread(spark, facts, lookup):
    """No task of the join sees more than a small multiple of its share."""
    settings = {
        "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = lookup_join(facts, lookup, "k", "row_id", hot_keys(facts, "k", parts=30))
        sizes = Counter(r[0] for r in joined.select(F.spark_partition_id()).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) >= 12
    assert max(sizes.values()) < 3 * ROWS / 16


def test_first_rows_limits_before_the_shuffle(spark, facts):
    df = first_rows(facts, ["k"], [F.col("row_id").asc()], 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert df.filter("k = 'hot'").count() == 3
