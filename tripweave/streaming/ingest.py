"""Incremental ingestion: files to landed tables, upserts per micro-batch, duplicate suppression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave.functions import cleanse as C
from tripweave.functions import temporal
from tripweave.schema import LandedTable
from tripweave.sources.landing import conform

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, folder: str, table: LandedTable, files_per_batch: int = 1_000) -> DataFrame:
    """New JSON-lines files under ``folder`` (one sub-folder per day) as a stream with a fixed schema.

    A backlog is read in micro-batches of ``files_per_batch`` files.
    """
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def land_stream(stream: DataFrame, table: LandedTable, target: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to the day-partitioned landed table, exactly once, and stop when caught up.

    Days are rebalanced at run time as in batch landing: a large day is split over tasks, small
    ones are merged.
    """
    rows = conform(stream, table).hint("rebalance", "ingest_date")
    return (
        rows.writeStream.format("parquet").partitionBy("ingest_date")
        .option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def upsert_stream(
    stream: DataFrame, model: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], object], checkpoint: str
) -> StreamingQuery:
    """Run a cleansing model on every micro-batch and hand its rows to ``write``, an upsert by key.

    A batch that is replayed after a failure leaves the table as it was. For the result not to depend
    on the order of batches either, ``write`` has to compare versions (``newest`` of the upserts).
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        rows = model(batch).persist()
        try:
            write(rows)
        finally:
            rows.unpersist()

    return (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def first_seen_stream(stream: DataFrame, at: str, keys: list[str], delay: str) -> DataFrame:
    """Drop re-submissions across micro-batches that arrive within ``delay`` of the first one.

    State is bounded by the watermark: a key is forgotten ``delay`` after its event time. It is kept on
    disk by the RocksDB store. Rows older than the watermark are not let through; :func:`late_rows`
    tells how many there were.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a finished query held back as older than its watermark, over the batches it remembers.

    Spark remembers ``spark.sql.streaming.numRecentProgressUpdates`` batches.
    """
    operators = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in operators)


def hotel_keys(hotels: DataFrame) -> DataFrame:
    """Landed hotel bookings reduced to their near-duplicate key and event time."""
    return hotels.select(
        "customer_id",
        F.lower(C.title_case(F.col("hotel_name"))).alias("hotel_name"),
        "check_in_date",
        C.whole_hundreds(F.col("amount_idr")).alias("amount_idr"),
        "booking_ts",
    )


def experience_keys(experiences: DataFrame) -> DataFrame:
    """Landed experience bookings reduced to their near-duplicate key and a typed event time."""
    return experiences.select(
        C.email(F.col("email")).alias("email"),
        F.lower(C.title_case(F.col("experience_name"))).alias("experience_name"),
        temporal.day(F.col("activity_date")).alias("activity_date"),
        C.whole_hundreds(F.col("amount_idr")).alias("amount_idr"),
        temporal.timestamp(F.col("booking_ts")).alias("booking_ts"),
    )


def flight_keys(flights: DataFrame) -> DataFrame:
    """Landed flights reduced to their near-duplicate key and a typed event time."""
    return flights.select(
        C.email(F.col("email")).alias("email"),
        C.upper_code(F.col("flight_number")).alias("flight_number"),
        temporal.timestamp(F.col("departure_ts")).alias("departure_ts"),
        C.whole_hundreds(F.col("amount_idr")).alias("amount_idr"),
        temporal.timestamp(F.col("booking_ts")).alias("booking_ts"),
    )

