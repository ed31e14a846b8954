"""Left join to a lookup table when a few keys, or NULL, hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key that holds more than one in so many rows is spread out. No more than PARTS keys can, which
# is the proven row bound of the broadcast list of such keys.
PARTS = 2_000


def hot_keys(df: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """Keys with more than a ``parts``-th of all rows that have a key, and over how many tasks to spread each.

    Counts are combined before the shuffle, so it moves one row per key and input task. There are
    fewer than ``parts`` such keys whatever the size of the table, and the copies of all of them add
    up to at most twice ``parts``. The list only steers which rows are spread out; no result depends
    on it. What a key beyond the list holds is left to the run-time splitting of join partitions.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    share = F.col("n") * F.lit(parts) / total
    return counts.filter(share > 1).select(key, F.ceil(share).cast("bigint").alias("_copies"))


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, row_id: str, hot: DataFrame | None = None, content: list[str] | None = None
) -> DataFrame:
    """``facts`` left-joined to ``lookup`` on ``key``.

    Rows without a key get a private join value, so they spread over all tasks instead of meeting
    in one. Rows of a key listed in ``hot`` are spread over as many tasks as their number asks for,
    and only the lookup rows of those keys are copied.

    Rows without an id are spread by their ``content``, by default all columns; a join before this one then has to carry
    all of them.
    """
    own = F.coalesce(F.col(row_id).cast("string"), F.xxhash64(*(content or facts.columns)).cast("string"))
    # No lookup key starts with a NUL character, hence these rows stay unmatched as they should.
    # The hash of the key comes first in the join: texts that begin alike are slow to sort.
    hashed = F.xxhash64("_key")
    spread = facts.withColumn("_key", F.coalesce(F.col(key), F.concat(F.lit("\u0000"), own))).withColumn("_hash", hashed)
    target = lookup.withColumnRenamed(key, "_key").withColumn("_hash", hashed)
    if hot is None:
        return spread.join(target, ["_hash", "_key"], "left").drop("_hash", "_key")

    marks = F.broadcast(hot.withColumnRenamed(key, "_key"))
    one = F.lit(1).cast("bigint")
    copies = F.coalesce("_copies", one)
    left = spread.join(marks, "_key", "left").withColumn("_salt", F.pmod(F.xxhash64(own), copies)).drop("_copies")
    right = target.join(marks, "_key", "left").withColumn("_salt", F.explode(F.sequence(one - 1, copies - 1))).drop("_copies")
    return left.join(right, ["_hash", "_key", "_salt"], "left").drop("_hash", "_key", "_salt")


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (c != "")
