"""Lists of any length per customer, in chunks.

One array per customer is one row that grows with the customer: a phone shared by a million tickets is one value that
one task has to build and every reader to carry. Here a list is rows of at most ``size`` values, numbered in the order of
the values. Values are dealt by ranges of (customer, list, value), so a long list is spread over many tasks; a value's
place follows from the counts of the ranges before its own. Each value is listed once; missing and blank ones are not.
Records without a customer are left out. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.operators.skew import not_blank
from tripweave.plans.identity import LISTS
from tripweave.session import ensure_checkpoint_dir

ID = "resolved_customer_id"
SIZE = 1_000


def list_values(records: DataFrame) -> DataFrame:
    """``(resolved_customer_id, list, value)``, each once, from the membership table."""
    values = F.array(*[F.struct(F.lit(name).alias("list"), F.col(source).alias("value")) for name, source in LISTS.items()])
    rows = records.filter(F.col(ID).isNotNull()).select(ID, F.explode(values).alias("v")).select(ID, "v.list", "v.value")
    return rows.filter(not_blank(F.col("value"))).distinct()


def chunked_lists(records: DataFrame, size: int = SIZE) -> DataFrame:
    """``(resolved_customer_id, list, chunk, n_values, values)``: chunks from 0, all full but the last of a list."""
    ensure_checkpoint_dir(records.sparkSession)
    order = [F.col(ID), F.col("list"), F.col("value")]
    dealt = list_values(records).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    # A list has no more rows here than there are ranges.
    counts = dealt.groupBy(ID, "list", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(ID, "list").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(ID, "list", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("_part", ID, "list").orderBy("value"))
    placed = dealt.withColumn("own", own).join(starts, [ID, "list", "_part"])
    chunk = F.expr(f"(start + own - 1) div {size}").alias("chunk")
    return placed.groupBy(ID, "list", chunk).agg(
        F.count(F.lit(1)).alias("n_values"), F.sort_array(F.collect_list("value")).alias("values")
    )


def short_lists(chunks: DataFrame) -> DataFrame:
    """One row per customer and list: the array if it is one chunk, null if longer, and the number of values."""
    return chunks.groupBy(ID, "list").agg(
        F.sum("n_values").alias("n_values"),
        F.max(F.when(F.col("chunk") == 0, F.col("values"))).alias("first"), F.max("chunk").alias("last"),
    ).select(ID, "list", "n_values", F.when(F.col("last") == 0, F.col("first")).alias("values"))
