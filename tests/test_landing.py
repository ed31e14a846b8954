from __future__ import annotations

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tripweave.operators.upsert import merge_into, upsert
from tripweave.plans import silver
from tripweave.schema import CUSTOMERS, FLIGHTS, HOTELS, TICKETS
from tripweave.sources import landing
from tripweave.sources.reference_data import gazetteer
from tripweave.sources.tables import MonthlyTable, SnapshotTable
from tripweave.streaming import ingest


def bookings(spark, rows):
    """(booking_id, day, amount) rows as landed hotel bookings."""
    df = spark.createDataFrame(rows, "booking_id string, day string, amount_idr bigint")
    return landing.conform(df.withColumn("ingest_date", F.col("day").cast("date")), HOTELS)


def content(spark, root):
    rows = landing.read_landed(spark, root, HOTELS).select("booking_id", "ingest_date", "amount_idr").collect()
    return sorted((r[0], r[1].isoformat(), r[2]) for r in rows)


def test_replace_is_idempotent_and_clears_empty_days(spark, tmp_path):
    root = str(tmp_path / "hotels")
    first = bookings(spark, [("a", "2026-01-01", 1), ("b", "2026-01-02", 2), ("c", "2026-01-03", 3)])
    landing.replace_days(first, root, HOTELS, ["2026-01-01", "2026-01-02", "2026-01-03"])
    again = bookings(spark, [("b2", "2026-01-02", 20)])
    for _ in range(2):
        landing.replace_days(again, root, HOTELS, ["2026-01-02", "2026-01-03"])
        assert content(spark, root) == [("a", "2026-01-01", 1), ("b2", "2026-01-02", 20)]


def test_replace_one_day_with_nothing(spark, tmp_path):
    root = str(tmp_path / "hotels")
    landing.replace_days(bookings(spark, [("a", "2026-01-01", 1), ("b", "2026-01-02", 2)]), root, HOTELS,
                         ["2026-01-01", "2026-01-02"])
    landing.replace_day(spark.createDataFrame([], HOTELS.schema), root, HOTELS, "2026-01-01")
    assert content(spark, root) == [("b", "2026-01-02", 2)]


def test_rows_outside_the_requested_days_are_not_landed(spark, tmp_path):
    root = str(tmp_path / "hotels")
    landing.replace_days(bookings(spark, [("a", "2026-01-01", 1), ("b", "2026-01-09", 2)]), root, HOTELS, ["2026-01-01"])
    assert content(spark, root) == [("a", "2026-01-01", 1)]


def test_append_stamps_and_counts(spark, tmp_path):
    root = str(tmp_path / "hotels")
    batch = bookings(spark, [("a", "2026-01-01", 1), ("b", "2026-01-01", 2)])
    assert landing.append(batch.drop("ingest_date"), root, HOTELS, "2026-02-02") == 2
    assert landing.append(batch.limit(0), root, HOTELS, "2026-02-02") == 0
    assert {d for _, d, _ in content(spark, root)} == {"2026-02-02"}


def test_day_file_reads_json_array_and_tolerates_a_missing_day(spark, tmp_path):
    tickets = [{"ticket_id": "T1", "customer_email": "a@b.c", "extra": 1}, {"ticket_id": "T2", "body": "x\ny"}]
    (tmp_path / "tickets_20260105.json").write_text(json.dumps(tickets, indent=1))
    got = landing.day_file(spark, str(tmp_path), TICKETS, "2026-01-05")
    assert [r["ticket_id"] for r in got.orderBy("ticket_id").collect()] == ["T1", "T2"]
    assert got.columns == TICKETS.payload
    assert landing.day_file(spark, str(tmp_path), TICKETS, "2026-01-06").count() == 0


def test_day_files_read_a_span_of_days_in_one_go(spark, tmp_path):
    for day, ids in (("20260105", ["T1", "T2"]), ("20260107", ["T3"]), ("20260201", ["T4"])):
        (tmp_path / f"tickets_{day}.json").write_text(json.dumps([{"ticket_id": i} for i in ids], indent=1))
    (tmp_path / "tickets_20260106.json.part").write_text("[")
    (tmp_path / "other_20260106.json").write_text("[")
    got = landing.day_files(spark, str(tmp_path), TICKETS, "2026-01-05", "2026-02-01")
    assert got.columns == [*TICKETS.payload, "ingest_date"]
    assert sorted((r["ticket_id"], str(r["ingest_date"])) for r in got.collect()) == [
        ("T1", "2026-01-05"), ("T2", "2026-01-05"), ("T3", "2026-01-07")]
    assert landing.day_files(spark, str(tmp_path), TICKETS, "2026-03-01", "2026-04-01").count() == 0
    assert landing.day_files(spark, str(tmp_path / "none"), TICKETS, "2026-01-01", "2026-04-01").count() == 0


def test_windows():
    assert landing.backfill_window(["2026-03-02", "2026-03-01"]) == (date(2026, 3, 1), date(2026, 3, 3))
    assert landing.backfill_window(["2026-03-01"], full_refresh=True) == (date(2026, 1, 1), date(2026, 3, 2))


def test_window_prunes_day_folders(spark, tmp_path):
    root = str(tmp_path / "hotels")
    landing.replace_days(bookings(spark, [("a", "2026-01-01", 1), ("b", "2026-01-02", 2)]), root, HOTELS,
                         ["2026-01-01", "2026-01-02"])
    df = landing.window(landing.read_landed(spark, root, HOTELS)).select("booking_id")
    assert [r[0] for r in df.collect()] == ["a"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "ReadSchema: struct<booking_id:string>" in plan


def test_missing_columns_become_null(spark):
    old = spark.createDataFrame([("C1", "a@b.c")], "customer_id string, email string")
    row = landing.conform(old, CUSTOMERS).first()
    assert row["customer_id"] == "C1" and row["loyalty_tier"] is None


def versions(spark, rows):
    return spark.createDataFrame(rows, "k string, v bigint")


def test_upsert_replaces_keeps_and_adds(spark):
    out = upsert(versions(spark, [("a", 1), ("b", 2)]), versions(spark, [("b", 3), ("c", 4)]), "k")
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1), ("b", 3), ("c", 4)]


def test_merge_is_idempotent_and_order_free_for_disjoint_batches(spark, tmp_path):
    one, two = versions(spark, [("a", 1), ("b", 2)]), versions(spark, [("c", 3)])
    results = []
    for i, order in enumerate([(one, two), (two, one), (one, two, two, one)]):
        table = SnapshotTable(spark, str(tmp_path / f"t{i}"))
        for batch in order:
            merge_into(table, batch, "k")
        results.append(sorted(tuple(r) for r in table.read().collect()))
    assert results[0] == results[1] == results[2]


def test_full_refresh_drops_absent_keys(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    merge_into(table, versions(spark, [("a", 1)]), "k")
    merge_into(table, versions(spark, [("b", 2)]), "k", full_refresh=True)
    assert [tuple(r) for r in table.read().collect()] == [("b", 2)]


def test_uncommitted_snapshot_is_ignored(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.write(versions(spark, [("a", 1)]))
    half = tmp_path / "t" / "snapshot=2"
    os.makedirs(half)
    (half / "part-00000.parquet").write_bytes(b"cut short")
    assert [tuple(r) for r in table.read().collect()] == [("a", 1)]
    table.write(versions(spark, [("b", 2)]))
    assert [tuple(r) for r in table.read().collect()] == [("b", 2)]
    with pytest.raises(FileNotFoundError):
        SnapshotTable(spark, str(tmp_path / "none")).read()


def test_gazetteer_csv(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text("city,lat,lng,province\nUbud,-8.5,115.3,Bali\n")
    assert tuple(gazetteer(spark, str(path)).first()) == ("Ubud", -8.5, 115.3, "Bali")
    assert gazetteer(spark).filter("city = 'Ubud'").count() == 1


def test_latest_version_of_a_customer_wins(spark):
    rows = [("C1", "old@x.id", "2026-01-01 00:00:00", "2026-01-02 00:00:00"),
            ("C1", "new@x.id", "2026-01-01 00:00:00", "2026-01-05 00:00:00"),
            ("C2", "only@x.id", "2026-01-03 00:00:00", None),
            ("C2", "older@x.id", "2026-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "customer_id string, email string, created_at string, updated_at string")
    out = silver.silver_customers(landing.conform(df, CUSTOMERS))
    assert sorted((r["customer_id"], r["email"]) for r in out.collect()) == [("C1", "new@x.id"), ("C2", "only@x.id")]


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    files, progress = tmp_path / "files", str(tmp_path / "progress")
    files.mkdir()
    table = SnapshotTable(spark, str(tmp_path / "table"))

    def deliver(name, rows):
        (files / name).write_text("\n".join(json.dumps(r) for r in rows))
        stream = ingest.file_stream(spark, str(files), TICKETS)
        write = lambda rows: merge_into(table, rows, "ticket_id")
        ingest.upsert_stream(stream, silver.silver_tickets, write, progress).awaitTermination()
        return {r["ticket_id"]: r["status"] for r in table.read().collect()}

    assert deliver("a.json", [{"ticket_id": "T1", "status": "Open", "created_at": "2026-01-01T00:00:00+07:00"}]) == {
        "T1": "open"}
    later = [{"ticket_id": "T1", "status": "closed", "created_at": "2026-01-01T00:00:00+07:00"},
             {"ticket_id": "T2", "status": "open", "created_at": "2026-01-02T00:00:00+07:00"}]
    assert deliver("b.json", later) == {"T1": "closed", "T2": "open"}


def test_late_older_version_does_not_replace_the_newer_one(spark, tmp_path):
    table = MonthlyTable(spark, str(tmp_path / "table"), "ticket_id", "created_at",
                         silver.silver_tickets(spark.createDataFrame([], TICKETS.schema)).schema)

    def deliver(name, status, day):
        files = tmp_path / name
        files.mkdir()
        row = {"ticket_id": "T1", "status": status, "created_at": f"2026-03-0{day}T08:00:00+07:00"}
        (files / "x.json").write_text(json.dumps(row))
        write = lambda rows: table.upsert(rows, newest="created_at")
        stream = ingest.file_stream(spark, str(files), TICKETS)
        ingest.upsert_stream(stream, silver.silver_tickets, write, str(tmp_path / f"progress-{name}")).awaitTermination()
        return [r["status"] for r in table.read().collect()]

    assert deliver("a", "closed", 2) == ["closed"]
    assert deliver("b", "open", 1) == ["closed"]
    assert deliver("c", "reopened", 3) == ["reopened"]


def test_late_rows_are_counted(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    for i, day in enumerate(("2026-01-01", "2026-06-01", "2026-06-02", "2026-01-02")):
        row = {"booking_ref": f"F{i}", "email": f"{i}@x.id", "flight_number": "ga1", "amount_idr": 1_000,
               "departure_ts": "2026-03-01T00:00:00+07:00", "booking_ts": f"{day}T00:00:00+07:00"}
        (files / f"{i}.json").write_text(json.dumps(row))
        os.utime(files / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = ingest.flight_keys(ingest.file_stream(spark, str(files), FLIGHTS, files_per_batch=1))
    kept = ingest.first_seen_stream(stream, "booking_ts", ["email"], "10 days")
    query = (
        kept.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3 and ingest.late_rows(query) == 1


def test_resubmissions_are_dropped_across_micro_batches(spark, tmp_path):
    files, progress, out = tmp_path / "files", str(tmp_path / "progress"), str(tmp_path / "out")
    files.mkdir()
    keys = ["email", "flight_number", "departure_ts", "amount_idr"]

    def deliver(name, *rows):
        body = [
            {"booking_ref": ref, "email": email, "flight_number": "ga1", "amount_idr": amount,
             "departure_ts": "2026-03-01T00:00:00+07:00", "booking_ts": f"2026-02-0{day}T00:00:00+07:00"}
            for ref, email, amount, day in rows
        ]
        (files / name).write_text("\n".join(json.dumps(r) for r in body))
        stream = ingest.flight_keys(ingest.file_stream(spark, str(files), FLIGHTS))
        kept = ingest.first_seen_stream(stream, "booking_ts", keys, "30 days")
        (
            kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
            .trigger(availableNow=True).start().awaitTermination()
        )
        return spark.read.parquet(out).count()

    assert deliver("a.json", ("F1", "a@x.id", 150_000, 1), ("F2", "b@x.id", 150_000, 1)) == 2
    # The same flight again, a few rupiah off: rounding puts it on the same key.
    assert deliver("b.json", ("F3", "A@x.id ", 150_030, 2), ("F4", "c@x.id", 150_000, 2)) == 3


def test_only_folders_of_the_window_are_listed(spark, tmp_path):
    from tripweave.plans.daily import DailyJob

    job = DailyJob(spark, str(tmp_path), "2026-12-31")
    rows = spark.createDataFrame([(f"T{d}", f"2026-05-{d:02d}") for d in range(1, 10)] + [("T0", None)], "ticket_id string, ingest_date string")
    landed = landing.conform(rows.withColumn("ingest_date", F.col("ingest_date").cast("date")), TICKETS)
    landed.write.partitionBy("ingest_date").parquet(job.bronze_path("tickets"))
    some = job.bronze("tickets", landing.as_day("2026-05-03"), landing.as_day("2026-05-05"))
    assert some.schema == job.bronze("tickets").schema
    assert sorted((r["ticket_id"], str(r["ingest_date"])) for r in some.collect()) == [("T3", "2026-05-03"), ("T4", "2026-05-04")]
    assert {f.split("/")[-2] for f in some.inputFiles()} == {"ingest_date=2026-05-03", "ingest_date=2026-05-04"}
    assert job.bronze("tickets", landing.as_day("2027-01-01"), landing.as_day("2027-02-01")).count() == 0
