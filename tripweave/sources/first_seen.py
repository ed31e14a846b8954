"""Near-duplicates across runs: one row per key however the rows come, and a record of all others.

Dropping re-submissions within a run leaves those of another day; a stream with a watermark forgets keys and lets late
rows go. Here the row that stays is the one with the lowest id among all that ever came with the key, so runs by day,
a stream in any order, one backfill and repeats of any of them end with the same rows. What is kept is a table stored
by month and found through its key index, so a batch reads only the months that hold one of its keys. No state lives in
memory, no row is too late, and every row that is not kept is listed with its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.operators.dedupe import first_rows
from tripweave.operators.upsert import shuffled
from tripweave.sources.tables import MonthlyTable, SnapshotTable

KEY = "near_key"


def near_key(columns: list[Column]) -> Column:
    """One text for the key's columns; missing ones are equal to each other and to nothing else."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.to_json(F.array(*parts)), 256)


class FirstSeenTable:
    """Rows under ``path`` with the lowest ``id_column`` of each key, and the others."""

    def __init__(self, spark: SparkSession, path: str, id_column: str, event_time: str, schema: T.StructType):
        self.spark, self.id_column, self.columns = spark, id_column, schema.fieldNames()
        self.kept = MonthlyTable(
            spark, f"{path}/kept", KEY, event_time, T.StructType([*schema.fields, T.StructField(KEY, T.StringType())])
        )
        self._others_schema = T.StructType([
            T.StructField("row_key", T.StringType()), T.StructField(id_column, T.StringType()),
            T.StructField(KEY, T.StringType()), schema[event_time],
        ])
        self.others = MonthlyTable(spark, f"{path}/others", "row_key", event_time, self._others_schema)
        self._work = SnapshotTable(spark, f"{path}/work")

    def _in_order(self) -> Column:
        return F.col(self.id_column).asc()

    def add(self, rows: DataFrame, key: list[Column]) -> None:
        """Take in cleansed rows, copies and late ones included. A repeat changes nothing."""
        batch = SnapshotTable(self.spark, f"{self._work.path}/batch").write(
            rows.select(*self.columns, near_key(key).alias(KEY)).distinct()
        )
        displaced: list[DataFrame] = []

        def watch(stored: DataFrame) -> None:
            met = stored.join(shuffled(batch.select(KEY).distinct()), KEY, "left_semi").select(*batch.columns)
            displaced.append(SnapshotTable(self.spark, f"{self._work.path}/met").write(met))

        # Rows of one id are versions of it; the content settles which of them stands for it in a batch.
        content = F.xxhash64(*[c for c in self.columns if c != self.id_column]).asc()
        firsts = SnapshotTable(self.spark, f"{self._work.path}/firsts").write(first_rows(batch, [KEY], [self._in_order(), content]))
        self.kept.upsert(firsts, newest=self._in_order(), watch=watch)
        every = batch
        for stored in displaced:
            every = every.unionByName(stored)
        lowest = first_rows(every, [KEY], [self._in_order()]).select(F.col(KEY).alias("_key"), F.col(self.id_column).alias("_first"))
        same_key = F.col(KEY) == F.col("_key")
        others = every.join(shuffled(lowest), same_key).filter(~F.col(self.id_column).eqNullSafe(F.col("_first")))
        names = self._others_schema.fieldNames()
        listed = others.withColumn("row_key", F.concat_ws("|", self.id_column, KEY)).select(
            *[F.col(n).cast(self._others_schema[n].dataType) for n in names]
        ).dropDuplicates(["row_key"])
        self.others.upsert(SnapshotTable(self.spark, f"{self._work.path}/listed").write(listed))

    def read(self) -> DataFrame:
        return self.kept.read().select(*self.columns)
