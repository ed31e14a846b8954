"""Stored Parquet tables: full snapshots and day-partitioned landing tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.operators.upsert import upsert
from tripweave.sources.files import child_names, delete_path, move_path, path_exists, touch
from tripweave.sources.key_index import KeyIndex

BUCKETS = 16  # folders of a table's key index; some hundred thousand keys each are a good size


class SnapshotTable:
    """A table whose every write is a complete new snapshot folder.

    Readers take the newest snapshot whose job committed, so a write that dies half-way, or one
    that reads the table it replaces, never harms the current content. The newest ``KEPT``
    committed snapshots stay, for readers that began before the last write; older ones go.
    """

    KEPT = 2

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _snapshots(self) -> list[int]:
        names = child_names(self.spark, self.path)
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("snapshot="))

    def _committed(self) -> int | None:
        for number in reversed(self._snapshots()):
            if path_exists(self.spark, f"{self.path}/snapshot={number}/_SUCCESS"):
                return number
        return None

    def exists(self) -> bool:
        return self._committed() is not None

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        number = self._committed()
        if number is None:
            raise FileNotFoundError(f"no committed snapshot under {self.path}")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.path}/snapshot={number}")

    def write(self, df: DataFrame, lookup: str | None = None) -> DataFrame:
        """Write the next snapshot; row groups get a Bloom filter on the ``lookup`` column.

        Ids are hashes, so min/max statistics alone would rarely skip anything for a single id.
        """
        number = max(self._snapshots(), default=0) + 1
        # Ids of one customer repeat over many rows, which the denser codec stores in less.
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if lookup:
            writer = writer.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(f"{self.path}/snapshot={number}")
        for old in self._snapshots()[: -self.KEPT]:
            delete_path(self.spark, f"{self.path}/snapshot={old}")
        return self.read(df.schema)


class MonthlyTable:
    """A keyed table stored by the month of its event time, so that an upsert rewrites few months.

    Only months that hold a row of the batch, or a stored row the batch replaces, are read and
    written; all others keep their files. An index of keys beside the table tells which those are. The new content of those months is first stored beside
    the table, and only then put in place; a run that dies in between is completed by the next
    reader or writer from that copy. Replaced files are gone, so a DataFrame read before an upsert
    has to be read again; tables that are served while they change belong in a
    :class:`SnapshotTable`.
    """

    MONTH = "stored_month"

    def __init__(
        self, spark: SparkSession, path: str, key: str, event_time: str, schema: T.StructType, buckets: int = BUCKETS
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.event_time = event_time
        self.schema = schema
        self.index = KeyIndex(spark, f"{self.path}__index", buckets)
        self._stored_schema = T.StructType([*schema.fields, T.StructField(self.MONTH, T.StringType())])

    # Beside the table: the rows to put in place in a folder per month, and then the months they replace ("*" for all)
    # and whether they have rows, whose commit makes the pair valid.
    @property
    def _pending_rows(self) -> str:
        return f"{self.path}__pending/rows"

    @property
    def _pending_months(self) -> str:
        return f"{self.path}__pending/months"

    def exists(self) -> bool:
        self._finish()
        return bool(child_names(self.spark, self.path))

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self._stored_schema).parquet(self.path)

    def read(self, months: list[str] | None = None) -> DataFrame:
        """The whole table, or only some of its months."""
        self._finish()
        rows = self._stored()
        if months is not None:
            rows = rows.filter(F.col(self.MONTH).isin(months))
        return rows.select(*self.schema.fieldNames())

    def _with_month(self, df: DataFrame) -> DataFrame:
        month = F.coalesce(F.date_format(self.event_time, "yyyy-MM"), F.lit("none"))
        return df.select(*self.schema.fieldNames()).withColumn(self.MONTH, month)

    def _prepare(self, df: DataFrame, months: list[str]) -> None:
        """Store the new content of some months beside the table; the second write commits it."""
        delete_path(self.spark, f"{self.path}__pending")
        dealt = df.hint("rebalance", self.MONTH)
        dealt.write.partitionBy(self.MONTH).parquet(self._pending_rows)
        filled = {n.split("=", 1)[1] for n in child_names(self.spark, self._pending_rows) if n.startswith(f"{self.MONTH}=")}
        listed = [F.struct(F.lit(m).alias(self.MONTH), F.lit(m in filled).alias("filled")) for m in sorted({*months, *filled})]
        rows = F.array(*listed).cast(f"array<struct<{self.MONTH}:string,filled:boolean>>")
        self.spark.range(1).select(F.inline(rows)).coalesce(1).write.parquet(self._pending_months)

    def _finish(self) -> None:
        """Put prepared months in place. Doing it again changes nothing, so it may die anywhere.

        The folders of the months are moved, so their rows are written once. A folder that is gone from beside the table
        is in place already.
        """
        if not path_exists(self.spark, f"{self._pending_months}/_SUCCESS"):
            return
        listed = {r[self.MONTH]: r["filled"] for r in self.spark.read.parquet(self._pending_months).collect()}
        filled = {f"{self.MONTH}={m}" for m, has_rows in listed.items() if has_rows}
        gone = {f"{self.MONTH}={m}" for m in listed} - filled
        if "*" in listed:
            gone = {n for n in child_names(self.spark, self.path) if n.startswith(f"{self.MONTH}=")} - filled
        for folder in sorted(gone):
            delete_path(self.spark, f"{self.path}/{folder}")
        for folder in sorted(filled):
            if path_exists(self.spark, f"{self._pending_rows}/{folder}"):
                delete_path(self.spark, f"{self.path}/{folder}")
                move_path(self.spark, f"{self._pending_rows}/{folder}", f"{self.path}/{folder}")
        # A table without rows exists, too.
        touch(self.spark, f"{self.path}/_SUCCESS")
        delete_path(self.spark, f"{self.path}__pending")

    def _pairs(self, rows: DataFrame) -> DataFrame:
        """``(key, month)`` of rows that have a key."""
        pairs = rows.select(F.col(self.key).cast("string").alias("key"), F.col(self.MONTH).alias("month"))
        return pairs.filter("key is not null")

    def _keys_by_month(self, rows: DataFrame) -> dict[str, int]:
        """Rows with a key by month, also of months without any."""
        counted = rows.groupBy(self.MONTH).agg(F.count(F.col(self.key)).alias("n"))
        return {r[self.MONTH]: r["n"] for r in counted.collect()}

    def _replace(self, rows: DataFrame) -> None:
        # Without an index the next upsert makes one, so it goes first.
        self.index.drop()
        self._prepare(rows, ["*"])
        self._finish()
        stored = self._stored()
        # Parquet footers have the number of rows.
        self.index.rebuild(self._pairs(stored), stored.count())

    def replace_all(self, df: DataFrame) -> None:
        """Static overwrite: keys absent from ``df`` disappear."""
        self._replace(self._with_month(df))

    def touched_months(self, batch: DataFrame) -> list[str]:
        """Months that hold a row of the batch, or a stored row with a key of the batch."""
        new = self._with_month(batch)
        # Month lists hold at most one row per month of the table's life.
        keys = self._keys_by_month(new)
        months = set(keys)
        if self.exists() and self.index.exists():
            months |= set(_values(self.index.months_of(self._pairs(new), sum(keys.values())), "month"))
        return sorted(months)

    def upsert(
        self, batch: DataFrame, newest: str | Column | None = None, watch: Callable[[DataFrame], object] | None = None
    ) -> list[str]:
        """Batch rows replace stored rows of the same key; returns the months rewritten.

        Running it twice equals running it once. ``batch`` is read several times and must not
        depend on this table; pass a stored one. With ``newest``, a row is replaced only by one
        that is not older by that column, or that comes first by a sort expression. Rows without a key
        are replaced by equal rows only. ``watch`` is called with the stored rows of
        those months before any is replaced.
        """
        new = self._with_month(batch)
        if not self.exists():
            self._replace(new)
            return _values(new, self.MONTH)
        stored = self._stored()
        if not self.index.exists():
            self.index.rebuild(self._pairs(stored))
        pairs = self._pairs(new)
        keys = self._keys_by_month(new)
        known = self.index.months_of(pairs, sum(keys.values())).persist()
        try:
            met = _values(known, "month")
            months = sorted({*keys, *met})
            self.index.add(pairs, known if met else None)
        finally:
            known.unpersist()
        touched = stored.filter(F.col(self.MONTH).isin(months))
        if watch is not None:
            watch(touched.select(*self.schema.fieldNames()))
        after = upsert(touched, new, self.key, newest)
        self._prepare(after, months)
        self._finish()
        return months


def _values(df: DataFrame, column: str) -> list[str]:
    return sorted(r[0] for r in df.select(column).distinct().collect())
