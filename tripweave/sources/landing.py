"""Landing of daily source slices into day-partitioned Parquet tables."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.schema import LandedTable
from tripweave.sources.files import child_names, delete_path

FIRST_DAY = date(2026, 1, 1)
DEFAULT_WINDOW = ("2026-01-01", "2026-01-02")


def as_day(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


# ---- slices of the sources ----------------------------------------------------------------


def time_slice(source: DataFrame, table: LandedTable, start: str, end: str) -> DataFrame:
    """Rows whose typed event time lies in ``[start, end)``, without the landing stamp."""
    at = F.col(table.event_time)
    inside = (at >= F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp"))
    return source.select(*table.payload).filter(inside)


def text_slice(source: DataFrame, table: LandedTable, start: str, end: str) -> DataFrame:
    """The same half-open window for sources that keep ISO text with a fixed +07:00 offset.

    The bounds are compared as text, both inclusive, the upper one a second before ``end``.
    """
    last = datetime.fromisoformat(end) - timedelta(seconds=1)
    since = f"{datetime.fromisoformat(start):%Y-%m-%dT%H:%M:%S}+07:00"
    until = f"{last:%Y-%m-%dT%H:%M:%S}+07:00"
    return source.select(*table.payload).filter(F.col(table.event_time).between(since, until))


def page(source: DataFrame, table: LandedTable, limit: int = 0, offset: int = 0) -> DataFrame:
    """One page, newest first; ``limit=0`` returns everything.

    A page is a top-k report: ``offset + limit`` rows meet in one task. To read all pages, scan instead.
    """
    ordered = source.orderBy(F.col(table.event_time).desc_nulls_last(), F.col(table.key).asc())
    return ordered.offset(offset).limit(limit) if limit else ordered


def row_counts(sources: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in sources.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def newest_daily_counts(sources: dict[str, tuple[DataFrame, Column]], days: int = 5) -> DataFrame:
    """Bookings per day and source, the newest ``days`` days of each source."""
    out = None
    for name, (df, at) in sources.items():
        one = (
            df.groupBy(F.to_date(at).alias("day")).agg(F.count(F.lit(1)).alias("bookings"))
            .orderBy(F.col("day").desc_nulls_last()).limit(days)
            .select(F.lit(name).alias("table_name"), "day", "bookings")
        )
        out = one if out is None else out.unionByName(one)
    return out


def day_file(spark: SparkSession, folder: str, table: LandedTable, day: str | date) -> DataFrame:
    """The daily JSON-array file of a source; a file that does not exist is an empty day."""
    payload = T.StructType([f for f in table.schema.fields if f.name != "ingest_date"])
    path = f"{folder.rstrip('/')}/{table.name}_{as_day(day):%Y%m%d}.json"
    try:
        return spark.read.schema(payload).option("multiLine", True).json(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], payload)


def day_files(spark: SparkSession, folder: str, table: LandedTable, low: str | date, high: str | date) -> DataFrame:
    """The daily JSON-array files of the days from ``low`` up to ``high`` in one read, with the day of each row's file.

    Only files of these days are opened, in parallel; days without a file are empty.
    """
    payload = T.StructType([f for f in table.schema.fields if f.name != "ingest_date"])
    first, last = f"{as_day(low):%Y%m%d}", f"{as_day(high):%Y%m%d}"
    named = re.compile(rf"{re.escape(table.name)}_(\d{{8}})\.json")
    days = {name: m.group(1) for name in child_names(spark, folder) if (m := named.fullmatch(name))}
    paths = [f"{folder.rstrip('/')}/{name}" for name, day in sorted(days.items()) if first <= day < last]
    if not paths:
        return spark.createDataFrame([], T.StructType([*payload.fields, T.StructField("ingest_date", T.DateType())]))
    rows = spark.read.schema(payload).option("multiLine", True).json(paths)
    day = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), rf"{table.name}_(\d{{8}})\.json", 1), "yyyyMMdd")
    return rows.select(*payload.fieldNames(), day.alias("ingest_date"))


def page_files(spark: SparkSession, path: str, table: LandedTable) -> DataFrame:
    """Rows of saved API pages, each a JSON object ``{total, limit, offset, data: [rows]}``."""
    payload = T.StructType([f for f in table.schema.fields if f.name != "ingest_date"])
    envelope = T.StructType([T.StructField("data", T.ArrayType(payload))])
    pages = spark.read.schema(envelope).option("multiLine", True).json(path)
    return pages.select(F.inline("data"))


def database_table(
    spark: SparkSession, url: str, table: LandedTable, split_on: str, bounds: tuple[str, str], splits: int, **options: str
) -> DataFrame:
    """A source table read over JDBC in ``splits`` parallel ranges of ``split_on``.

    Column choice and the window of :func:`time_slice` are pushed to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table.name)
    reader = reader.option("partitionColumn", split_on).option("numPartitions", splits)
    reader = reader.option("lowerBound", bounds[0]).option("upperBound", bounds[1])
    return reader.options(**options).load()


# ---- typed, day-partitioned storage -------------------------------------------------------


def conform(df: DataFrame, table: LandedTable) -> DataFrame:
    """Cast and reorder to the fixed schema; columns an old file lacks come out NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ]
    )


def stamp(df: DataFrame, day: str | date) -> DataFrame:
    """Add the landing day unless the batch already carries one."""
    return df if "ingest_date" in df.columns else df.withColumn("ingest_date", F.lit(as_day(day)))


def clustered(df: DataFrame, table: LandedTable) -> DataFrame:
    """Layout for writing: files hold one day and are sorted by key and event time.

    The rebalance hint lets AQE split a day that outweighs the others instead of giving it to
    one task, and merge the small ones.
    """
    return df.hint("rebalance", "ingest_date").sortWithinPartitions("ingest_date", table.key, table.event_time)


def read_landed(spark: SparkSession, root: str, table: LandedTable) -> DataFrame:
    return spark.read.schema(table.schema).parquet(root)


def read_days(spark: SparkSession, root: str, table: LandedTable, low: str | date, high: str | date) -> DataFrame:
    """The landed days from ``low`` up to ``high``. Only their folders are listed, however many others there are."""
    wanted = []
    for name in child_names(spark, root):
        column, _, value = name.partition("=")
        if column == "ingest_date" and re.fullmatch(r"\d{4}-\d\d-\d\d", value) and as_day(low) <= as_day(value) < as_day(high):
            wanted.append(f"{root.rstrip('/')}/{name}")
    if not wanted:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).option("basePath", root).parquet(*sorted(wanted))


def append(df: DataFrame, root: str, table: LandedTable, day: str | date) -> int:
    """Append a batch and return how many rows it added.

    Rows are counted on their way into the files, so the stored table is not read and other writers
    do not matter.
    """
    counted = Observation()
    batch = clustered(conform(stamp(df, day), table), table).observe(counted, F.count(F.lit(1)).alias("rows"))
    batch.write.mode("append").partitionBy("ingest_date").parquet(root)
    return counted.get["rows"]


def replace_days(df: DataFrame, root: str, table: LandedTable, days: list[str | date]) -> None:
    """Make the given days hold exactly the batch; running it twice equals running it once.

    ``df`` must carry ``ingest_date`` and is evaluated once: which days got rows is observed while
    they are written. The folders of the other days are removed.
    """
    wanted = {as_day(d) for d in days}
    batch = conform(df, table).filter(F.col("ingest_date").isin(sorted(wanted)))
    seen = Observation()
    # A set of at most as many days as were asked for.
    watched = clustered(batch, table).observe(seen, F.collect_set("ingest_date").alias("days"))
    (
        watched.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date").parquet(root)
    )
    for day in sorted(wanted - set(seen.get["days"])):
        delete_path(df.sparkSession, f"{root.rstrip('/')}/ingest_date={day.isoformat()}")


def replace_day(df: DataFrame, root: str, table: LandedTable, day: str | date) -> None:
    """Static overwrite of one day's folder, which also clears it when the batch is empty."""
    batch = conform(stamp(df, day), table).drop("ingest_date")
    (
        batch.hint("rebalance").sortWithinPartitions(table.key, table.event_time)
        .write.mode("overwrite").parquet(f"{root.rstrip('/')}/ingest_date={as_day(day).isoformat()}")
    )


def partitions(landed: DataFrame, days: str | date | list[str | date] | None = None) -> DataFrame:
    """All days, one day or a list of days; an empty list selects nothing."""
    if days is None:
        return landed
    if isinstance(days, list):
        return landed.filter(F.col("ingest_date").isin([as_day(d) for d in days])) if days else landed.limit(0)
    return landed.filter(F.col("ingest_date") == F.lit(as_day(days)))


def window(landed: DataFrame, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Half-open range of landing days; the filter on the partition column prunes folders."""
    low, high = as_day(start or DEFAULT_WINDOW[0]), as_day(end or DEFAULT_WINDOW[1])
    return landed.filter((F.col("ingest_date") >= F.lit(low)) & (F.col("ingest_date") < F.lit(high)))


def backfill_window(days: list[str | date], full_refresh: bool = False) -> tuple[date, date]:
    """One range covering the selected days; a full refresh starts at the first day ever."""
    chosen = [as_day(d) for d in days]
    return (FIRST_DAY if full_refresh else min(chosen)), max(chosen) + timedelta(days=1)


# ---- landing metadata ---------------------------------------------------------------------

_KINDS = {
    T.StringType: "string", T.LongType: "integer", T.IntegerType: "integer",
    T.DoubleType: "float", T.TimestampType: "datetime", T.DateType: "datetime",
}


def profile(landed: DataFrame, table: LandedTable) -> DataFrame:
    """One row per column: its normalised type, total rows, NULLs and number of landed days."""
    fields = table.schema.fields
    totals = landed.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("ingest_date").alias("partitions"),
        *[F.count(F.col(f.name)).alias(f"n_{f.name}") for f in fields],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(_KINDS[type(f.dataType)]).alias("column_type"),
                (F.col("row_count") - F.col(f"n_{f.name}")).alias("null_count"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return totals.select(
        F.lit(table.name).alias("table_name"), "row_count", "partitions", F.inline(per_column)
    )
