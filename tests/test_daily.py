from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tripweave.functions import cleanse as C
from tripweave.functions import sql as sql_functions
from tripweave.functions.identity import resolved_id
from tripweave.operators.upsert import upsert
from tripweave.operators.reconcile import latest_scan, total_mismatches
from tripweave.plans import facts
from tripweave.plans.daily import DailyJob
from tripweave.schema import FLIGHTS, GOLD_KEYS, LANDED, SILVER_KEYS
from tripweave.sources import landing
from tripweave.sources import tables as stored_tables
from tripweave.sources.files import move_path
from tripweave.sources.tables import MonthlyTable, SnapshotTable, delete_path, path_exists
from test_functions import CASES

DAYS = ["2026-03-01", "2026-03-02", "2026-03-03", "2026-04-01"]
AS_OF = "2026-12-31"


def job_with_landed_days(spark, tables, root):
    job = DailyJob(spark, root, AS_OF)
    for name in LANDED:
        job.land(name, landing.partitions(tables.landed(name), DAYS), DAYS)
    return job


def content(df):
    return sorted(json.dumps(r.asDict(True), default=str, sort_keys=True) for r in df.collect())


@pytest.fixture(scope="module")
def backfilled(spark, tables, tmp_path_factory):
    job = job_with_landed_days(spark, tables, str(tmp_path_factory.mktemp("whole")))
    return job, {name: content(df) for name, df in job.run(DAYS).items()}


def test_backfill_equals_rerun_and_checks_report(backfilled):
    job, before = backfilled
    again = job.run(DAYS)
    assert {name: content(df) for name, df in again.items()} == before
    rows = job.checks(again, DAYS).collect()
    assert {r["check_name"] for r in rows} == {
        "not_empty", "not_null", "unique", "email_valid", "phone_e164", "no_sentinels", "amount_positive"}
    failed = {(r["check_name"], r["table_name"], r["severity"]) for r in rows if not r["passed"]}
    assert all(severity == "warn" for check, table, severity in failed if table in GOLD_KEYS)


def test_day_by_day_equals_backfill(spark, tables, tmp_path, backfilled):
    _, whole = backfilled
    job = job_with_landed_days(spark, tables, str(tmp_path))
    job.run(DAYS[:2])
    parts = job.run(DAYS[2:])
    # Near-duplicates are dropped inside one run only, and none spans days in these tables.
    for name in SILVER_KEYS:
        assert content(parts[name]) == whole[name], name
    for name in GOLD_KEYS:
        assert content(parts[name]) == whole[name], name


def test_only_moved_keys_are_resolved_again(spark):
    columns = "source_customer_id string, resolved_customer_id string, identity_confidence string"
    before = spark.createDataFrame([("app:1", "r1", "high"), ("vendor:a", "ra", "email"), ("app:3", "r3", "high")], columns)
    after = spark.createDataFrame([("app:1", "r1", "high"), ("vendor:a", "ra", "high"), ("app:2", "r2", "high")], columns)
    moved = facts.moved_keys(before, after)
    assert {r[0] for r in moved.collect()} == {"vendor:a", "app:3", "app:2"}
    shape = "booking_id string, source_customer_id string, v int"
    stored = spark.createDataFrame([("b1", "app:1", 1), ("b2", "vendor:a", 1), ("b3", "app:2", 1), ("b4", None, 1)], shape)
    delivered = spark.createDataFrame([("b3", "app:2", 1), ("b5", "app:1", 1)], shape)
    again = facts.bookings_to_resolve(stored, delivered, moved)
    assert sorted(r["booking_id"] for r in again.collect()) == ["b2", "b3", "b5"]


def test_late_customer_resolves_earlier_bookings(spark, tables, tmp_path):
    """A customer who lands after the booking takes it over, as a run over everything would do."""
    job = job_with_landed_days(spark, tables, str(tmp_path))
    hotels = tables.landed("hotel_bookings")
    owner = landing.partitions(hotels, DAYS[:1]).orderBy("booking_id").first()["customer_id"]
    late = (
        tables.landed("customers").filter(F.col("customer_id") == owner)
        .withColumn("email", F.lit("late@x.id")).withColumn("ingest_date", F.lit(DAYS[1]).cast("date"))
    )
    for name in ("customers", "flights", "experiences", "tickets"):
        job.land(name, tables.landed(name).limit(0), DAYS)
    first = job.run(DAYS[:1])
    assert first["fact_bookings"].filter("resolved_customer_id is not null").count() == 0
    job.land("customers", late, [DAYS[1]])
    second = job.run(DAYS[1:2])
    mine = landing.partitions(hotels, DAYS[:2]).filter(F.col("customer_id") == owner)
    assert second["fact_bookings"].filter("resolved_customer_id is not null").count() == mine.count() > 0


def test_rows_without_key_are_replaced_by_equal_rows_only(spark):
    shape = "k string, v int"
    rows = spark.createDataFrame([(None, 1), (None, 5), (None, None), ("a", 2)], shape)
    assert content(upsert(rows, rows, "k")) == content(rows)
    batch = spark.createDataFrame([(None, 1), (None, 7), ("a", 3)], shape)
    got = sorted((tuple(r) for r in upsert(rows, batch, "k").collect()), key=str)
    assert got == [("a", 3), (None, 1), (None, 5), (None, 7), (None, None)]


def test_several_key_columns_identify_a_row_together(spark):
    shape = "kind string, city string, v int"
    rows = spark.createDataFrame([("hotel", None, 1), ("hotel", "Ubud", 2), (None, None, 3)], shape)
    batch = spark.createDataFrame([("hotel", None, 10)], shape)
    got = sorted((tuple(r) for r in upsert(rows, batch, ["kind", "city"]).collect()), key=str)
    assert got == [("hotel", "Ubud", 2), ("hotel", None, 10), (None, None, 3)]


def test_older_versions_do_not_replace_newer_ones(spark):
    shape = "k string, at int, v int"
    rows = spark.createDataFrame([("a", 5, 1), ("b", 1, 2), ("c", 9, 3), (None, 1, 4)], shape)
    batch = spark.createDataFrame([("a", 4, 10), ("b", 2, 20), ("c", 9, 30), ("d", 1, 40), (None, 1, 4)], shape)
    got = sorted((tuple(r) for r in upsert(rows, batch, "k", newest="at").collect()), key=str)
    assert got == [("a", 5, 1), ("b", 2, 20), ("c", 9, 30), ("d", 1, 40), (None, 1, 4)]


def test_monthly_table_keeps_rows_without_key(spark, tmp_path):
    first, table = months(spark, str(tmp_path / "t"), [(None, "2026-01-05", 1), (None, None, 2), ("a", "2026-01-06", 3)])
    table.upsert(first)
    batch, _ = months(spark, str(tmp_path / "t"), [(None, "2026-02-05", 4), (None, "2026-01-05", 1)])
    for _ in range(2):
        table.upsert(batch)
        assert sorted((r["v"] for r in table.read().collect())) == [1, 2, 3, 4]


def test_killed_write_is_completed_by_the_next_reader(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first, table = months(spark, path, [("a", "2026-01-05", 1), ("b", "2026-01-06", 2), ("c", "2026-02-05", 3)])
    table.upsert(first)
    batch, again = months(spark, path, [("a", "2026-02-07", 10)])

    def die(self):
        # As if the job had died after clearing the month it was about to fill.
        if path_exists(self.spark, f"{self._pending_months}/_SUCCESS"):
            delete_path(self.spark, f"{self.path}/stored_month=2026-01")
            raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(MonthlyTable, "_finish", die)
        with pytest.raises(RuntimeError):
            again.upsert(batch)
    _, reader = months(spark, path, [])
    assert sorted((r["k"], r["v"]) for r in reader.read().collect()) == [("a", 10), ("b", 2), ("c", 3)]
    assert not path_exists(spark, f"{path}__pending")


def test_only_two_snapshots_stay(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    for i in range(4):
        table.write(spark.createDataFrame([(i,)], "v int"))
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["snapshot=3", "snapshot=4"]
    assert table.read().first()["v"] == 3


def test_two_runs_with_missing_keys_equal_one_build(spark, tables, tmp_path):
    """Bookings without an id, city or time of the first run survive the second one."""

    def job(name):
        out = DailyJob(spark, str(tmp_path / name), AS_OF)
        for table in LANDED:
            rows = landing.partitions(tables.landed(table), DAYS)
            if table == "hotel_bookings":
                odd = F.crc32("booking_id") % 4
                rows = rows.withColumns({
                    "booking_id": F.when(odd != 0, F.col("booking_id")), "hotel_city": F.when(odd != 1, F.col("hotel_city")),
                    "booking_ts": F.when(odd != 2, F.col("booking_ts")),
                })
            out.land(table, rows, DAYS)
        return out

    whole = {name: content(df) for name, df in job("whole").run(DAYS).items()}
    parts = job("parts")
    parts.run(DAYS[:2])
    after = parts.run(DAYS[2:])
    for name in ("silver_hotel_bookings", "fact_bookings", "mart_route_monthly", "mart_customer_clv"):
        assert content(after[name]) == whole[name], name
    assert after["mart_route_monthly"].filter("_pk is null").count() > 0


def months(spark, path, rows):
    df = spark.createDataFrame(rows, "k string, at string, v bigint").withColumn("at", F.col("at").cast("timestamp"))
    return df, MonthlyTable(spark, path, "k", "at", df.schema)


def test_monthly_table_rewrites_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "t")
    first, table = months(spark, path, [("a", "2026-01-05", 1), ("b", "2026-02-05", 2), ("c", "2026-03-05", 3),
                                        ("d", None, 4)])
    table.upsert(first)
    untouched = sorted((tmp_path / "t" / "stored_month=2026-03").iterdir())
    # b moves from February to January, e is new, a changes in place.
    batch, _ = months(spark, path, [("b", "2026-01-09", 20), ("e", "2026-01-10", 5), ("a", "2026-01-05", 10)])
    for _ in range(2):
        table.upsert(batch)
        got = sorted((r["k"], r["v"]) for r in table.read().collect())
        assert got == [("a", 10), ("b", 20), ("c", 3), ("d", 4), ("e", 5)]
    assert sorted((tmp_path / "t" / "stored_month=2026-03").iterdir()) == untouched
    table.replace_all(batch)
    assert table.read().count() == 3


def test_page_files(spark, tmp_path):
    for i, refs in enumerate([["F1", "F2"], ["F3"], []]):
        body = {"total": 3, "limit": 2, "offset": 2 * i, "data": [{"booking_ref": r, "amount_idr": 5} for r in refs]}
        (tmp_path / f"page{i}.json").write_text(json.dumps(body, indent=1))
    rows = landing.page_files(spark, str(tmp_path), FLIGHTS)
    assert rows.columns == FLIGHTS.payload
    assert sorted(r["booking_ref"] for r in rows.collect()) == ["F1", "F2", "F3"]


def test_sql_functions_agree_with_columns(spark):
    sql_functions.register(spark)
    pairs = {
        "normalize_email": ("email", C.email), "normalize_phone": ("phone", C.phone),
        "strip_honorifics": ("name", C.person_name), "normalize_payment": ("payment", C.payment_method),
        "normalize_status": ("status", C.booking_status), "normalize_amount_idr": ("hundreds", C.whole_hundreds),
        "title_case": ("name", C.title_case), "resolved_customer_id": ("email", resolved_id),
    }
    assert set(pairs) == set(sql_functions.functions())
    for name, (cases, fn) in pairs.items():
        _, kind, inputs = CASES[cases]
        df = spark.createDataFrame([(v,) for v, _ in inputs], f"x {kind}")
        both = df.select(F.expr(f"{name}(x)").alias("a"), fn(F.col("x")).alias("b"))
        assert both.filter("not (a <=> b)").count() == 0, name


def test_views_serve_sql_users(spark, tables):
    tables.create_views()
    total = spark.sql("select count(*) n from mart_customer_clv m join dim_customer d using (resolved_customer_id)")
    assert total.first()["n"] == tables.table("dim_customer").count()


def test_reconciliation(spark):
    orders = spark.createDataFrame([(1, 100), (2, 50), (3, 7)], "o bigint, total bigint")
    lines = spark.createDataFrame([(1, 60), (1, 40), (2, 49)], "o bigint, v bigint")
    out = total_mismatches(orders, lines, "o", F.col("total"), F.col("v"))
    assert sorted((r["o"], r["difference"]) for r in out.collect()) == [(2, 1), (3, 7)]
    assert total_mismatches(orders, lines, "o", F.col("total"), F.col("v"), 1).count() == 1


def test_latest_scan(spark):
    lines = spark.createDataFrame([("r", "p", 1, 10, 1), ("r", "p", 1, 12, 2), ("r", "p", 2, 9, 3)],
                                  "receipt string, product string, qty int, at int, line int")
    kept = latest_scan(lines, ["receipt", "product", "qty"], "at", "line").collect()
    assert sorted(r["line"] for r in kept) == [2, 3]


def test_months_are_moved_into_place_and_not_written_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first, table = months(spark, path, [("a", "2026-01-05", 1), ("b", "2026-02-05", 2), ("c", "2026-03-05", 3)])
    table.upsert(first)
    batch, again = months(spark, path, [("a", "2026-02-07", 10)])
    whole, seen = MonthlyTable._finish, {}

    def files(folder):
        return {p.name for p in folder.glob("stored_month=*/*.parquet")}

    def watched(self):
        made = files(tmp_path / "t__pending" / "rows")
        whole(self)
        if made:
            seen["made"], seen["placed"] = made, files(tmp_path / "t")

    with monkeypatch.context() as m:
        m.setattr(MonthlyTable, "_finish", watched)
        again.upsert(batch)
    assert seen["made"] and seen["made"] <= seen["placed"]
    # The month that lost its only row is gone, the one not touched stays.
    assert sorted((r["k"], r["v"]) for r in again.read().collect()) == [("a", 10), ("b", 2), ("c", 3)]
    assert not (tmp_path / "t" / "stored_month=2026-01").exists()
    again.replace_all(first.limit(0))
    assert again.exists() and again.read().count() == 0


def test_a_run_lost_while_months_are_moved(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first, table = months(spark, path, [("a", "2026-01-05", 1), ("b", "2026-02-05", 2)])
    table.upsert(first)
    batch, again = months(spark, path, [("a", "2026-01-07", 10), ("b", "2026-02-07", 20)])
    moved = []

    def die_at_the_second(spark_, source, target):
        if moved:
            raise RuntimeError("lost")
        moved.append(target)
        move_path(spark_, source, target)

    with monkeypatch.context() as m:
        m.setattr(stored_tables, "move_path", die_at_the_second)
        with pytest.raises(RuntimeError):
            again.upsert(batch)
    assert sorted((r["k"], r["v"]) for r in again.read().collect()) == [("a", 10), ("b", 20)]


def test_stored_rows_of_keys_that_the_batch_does_not_have_all_stay(spark):
    shape = "k string, at int, v int"
    rows = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 1, 3), ("b", 2, 4)], shape)
    batch = spark.createDataFrame([("b", 2, 5)], shape)
    got = sorted(tuple(r) for r in upsert(rows, batch, "k", newest="at").collect())
    assert got == [("a", 1, 1), ("a", 1, 2), ("b", 2, 5)]


def test_delivered_keys_are_not_collected_for_a_broadcast(spark):
    rows = spark.range(100).selectExpr("cast(id as string) k", "id at", "id v")
    for newest in (None, "at"):
        plan = upsert(rows, rows.limit(5), "k", newest)._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and ("SortMergeJoin" if newest is None else "Window") in plan
