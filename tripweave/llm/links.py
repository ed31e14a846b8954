"""Connected components over pairs of whole numbers, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch


def _mark(pairs: DataFrame) -> tuple:
    """Equal for equal sets of pairs: their number and the sum of their hashes."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(pairs: DataFrame) -> DataFrame:
    """``(node, root)`` for undirected pairs ``(u, v)``; the root is the least node of the component.

    Alternates two contractions (every larger neighbour moves under the least neighbour, then every smaller one does)
    until nothing changes. The pairs never grow in number, and the rounds grow with the logarithm of a component's
    size. Minima are combined before the shuffle; each round ends in a written table, and the one before it goes.
    """
    scratch, turn = Scratch(pairs.sparkSession, "components"), 0
    down = pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = scratch.stored(down, "0")
    mark = _mark(current)
    while mark[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.filter("u <> v")
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lower.select("u", F.col("m").alias("v"))
        )
        current = scratch.stored(small.filter("u <> v").distinct(), str(turn + 1))
        scratch.drop(str(turn))
        turn += 1
        before, mark = mark, _mark(current)
        if mark == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
