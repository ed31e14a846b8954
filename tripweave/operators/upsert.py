"""Keyed replacement of stored rows by a batch."""

from __future__ import annotations

from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from tripweave.sources.tables import SnapshotTable


def same(left: list[str], right: list[str]) -> Column:
    """All pairs of columns are equal, or both missing."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def shuffled(batch: DataFrame) -> DataFrame:
    """A side of a join that grows with the delivered rows: it meets the other one in the tasks, and is never collected on
    the driver for a broadcast, however small its files are."""
    return batch.hint("merge")


HASH = "_hash"


def hashed(rows: DataFrame, *keys: str) -> DataFrame:
    """Append the hash of some key columns, to be the first key of a join or sort.

    Text keys mostly begin alike, and Spark's sort compares eight leading bytes before it has to look at the rows. Those of
    a hash differ.
    """
    return rows.withColumn(HASH, F.xxhash64(*keys))


def without_keys(stored: DataFrame, batch: DataFrame, key: str | list[str]) -> DataFrame:
    """Stored rows that the batch does not replace.

    Several key columns are compared null-safe and identify a row together. A row whose single key
    is missing has no identity: only an equal row of the batch replaces it, so a batch that is
    repeated adds nothing and rows of other days stay.
    """
    if not isinstance(key, str):
        names = [f"_replaced_{i}" for i in range(len(key))]
        replaced = shuffled(batch.select(*[F.col(k).alias(n) for k, n in zip(key, names)]))
        return stored.join(replaced, same(key, names), "left_anti")
    replaced = batch.filter(F.col(key).isNotNull()).select(F.col(key).alias("_replaced"))
    replaced = shuffled(replaced.withColumn("_replaced_hash", F.xxhash64("_replaced")))
    # One pass over the stored rows: keyless ones match nothing here and are compared as a whole next.
    met = (F.xxhash64(key) == F.col("_replaced_hash")) & (F.col(key) == F.col("_replaced"))
    kept = stored.join(replaced, met, "left_anti")
    return kept.filter(F.col(key).isNotNull()).unionByName(_keyless(kept, batch, key))


def _keyless(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Stored rows without a key that no row of the batch equals."""
    columns = stored.columns
    names = [f"_replaced_{i}" for i in range(len(columns))]
    equal = batch.filter(F.col(key).isNull()).select(*[F.col(c).alias(n) for c, n in zip(columns, names)])
    return stored.filter(F.col(key).isNull()).join(shuffled(equal), same(columns, names), "left_anti")


def upsert(
    stored: DataFrame, batch: DataFrame, key: str | list[str], newest: str | Column | None = None
) -> DataFrame:
    """Batch rows replace stored rows of the same key; all other stored rows stay.

    With ``newest``, a row is replaced only by one that is not older by that column, so the result
    does not depend on the order of batches. Another order of preference may be given instead, as a
    sort expression such as ``F.col("id").asc()``.
    """
    if newest is None:
        return without_keys(stored, batch, key).unionByName(batch)
    keys = [key] if isinstance(key, str) else list(key)
    every = stored.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    order = F.col(newest).desc_nulls_last() if isinstance(newest, str) else newest
    has_key = F.lit(True) if not isinstance(key, str) else F.col(key).isNotNull()
    # Both sides meet in one shuffle by key; stored rows of a key that the batch does not have all stay.
    of_key = Window.partitionBy(*keys)
    placed = every.filter(has_key).withColumns({
        "_place": F.row_number().over(of_key.orderBy(order, F.desc("_new"))), "_met": F.max("_new").over(of_key),
    })
    after = placed.filter((F.col("_met") == 0) | (F.col("_place") == 1)).select(*stored.columns)
    if not isinstance(key, str):
        return after
    return after.unionByName(_keyless(stored, batch, key)).unionByName(batch.filter(~has_key))


def merge_into(
    table: SnapshotTable, batch: DataFrame, key: str | list[str], full_refresh: bool = False, newest: str | None = None
) -> DataFrame:
    """Write the upserted table as its next snapshot and return the new content.

    ``batch`` holds at most one row per key, as every model of this package guarantees. Running
    the same batch again leaves the content unchanged.
    """
    after = batch if full_refresh or not table.exists() else upsert(table.read(), batch, key, newest)
    return table.write(after, lookup=key if isinstance(key, str) else None)


def merge_into_catalog(batch: DataFrame, target: str, key: str) -> None:
    """The same upsert for a catalog table whose format supports MERGE; only touched files change."""
    match = f"{target}.{key} = source.{key}"
    batch.alias("source").mergeInto(target, F.expr(match)).whenMatched().updateAll().whenNotMatched().insertAll().merge()
