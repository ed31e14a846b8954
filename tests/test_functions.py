"""Golden cases of the column functions, the awkward ones included."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripweave.functions import cleanse as C
from tripweave.functions import display, identity, scoring, temporal


def values(spark, fn, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("x")).collect()]


CASES = {
    "email": (C.email, "string", [
        (" Budi+x@GNAIL.com ", "budi@gmail.com"), ("a@yaho.co.id", "a@yahoo.co.id"), ("", None), ("  ", None),
        (None, None), ("a+b@c+d@e", "a@c+d@e"), ("x@gmaill.com", "x@gmail.com"), ("x@gnailcom", "x@gnailcom"),
        ("a+b", "a+b"), ("p@gnail.x@gnail.y", "p@gmail.x@gnail.y"),
    ]),
    "phone": (C.phone, "string", [
        ("0812-3456-7890", "+6281234567890"), ("+62 812 3456 7890", "+6281234567890"),
        ("81234567890", "+6281234567890"), ("021-1234567", "+62211234567"), ("12345", None), ("TIDAK ADA", None),
        ("tidak diketahui", None), ("000-000-0000", None), ("0", None), ("", None), (None, None), ("62", "+62"),
        ("123456789", None), ("1234567890", "+621234567890"), ("abc", None), ("00", "+620"),
    ]),
    "amount": (C.amount_text, "string", [
        ("150050", 150000), ("150150", 150200), ("149999", 150000), ("0", None), ("49", 0), ("50", 0),
        ("Rp 1.500.000", 1500000), ("Rp 9.999,50", 10000), ("1500000.00", 150000000), ("IDR 1500000", None),
        (None, None), ("", None), (" Rp2.000 ", 2000), ("12 ,50", None), ("-150", -200),
    ]),
    "hundreds": (C.whole_hundreds, "bigint", [
        (150050, 150000), (150150, 150200), (149999, 150000), (0, None), (49, 0), (None, None), (-250, -200),
    ]),
    "name": (C.person_name, "string", [
        ("Bpk. BUDI santoso", "Budi Santoso"), ("siti, S.Kom.", "Siti"), ("bpk budi", "Bpk Budi"), ("", None),
        (None, None), ("IBU ani", "Ani"), ("R.A. kartini", "Kartini"), ("dr.  budi, M.M.", "Budi"),
        ("budi  santoso", "Budi  Santoso"), ("d.ive-x", "D.ive-x"), ("bpk. h. umar", "H. Umar"),
    ]),
    "payment": (C.payment_method, "string", [
        ("bank transfer bca", "Bank Transfer (BCA)"), ("Bank Transfer (BCA)", "Bank Transfer (bca)"),
        ("QRIS", "Qris"), (" GoPay ", "Gopay"), (None, None),
    ]),
    "payment_lenient": (lambda c: C.payment_method(c, strict=False), "string", [
        ("Bank Transfer (BCA)", "Bank Transfer (BCA)"), ("bank transfer (mandiri)", "Bank Transfer (Mandiri)"),
    ]),
    "status": (C.booking_status, "string", [
        ("batal", "cancelled"), ("selesai", "completed"), ("tidak_hadir", "no_show"), (" Confirmed ", "confirmed"),
        (None, None),
    ]),
    "guests": (C.guests, "bigint", [(None, 1), (0, 0), (3, 3)]),
    "participants": (C.participants, "bigint", [(None, 1), (0, 1), (3, 3)]),
    "tier": (C.tier_or_default, "string", [(" GOLD", "gold"), ("", "basic"), (None, "basic")]),
    "postal": (C.postal_code, "string", [(" 1234567", "12345"), ("123", "123"), (None, None)]),
    "mojibake": (C.without_mojibake, "string", [("JosÃ kamar ", "Jos kamar"), (None, None)]),
    "idr": (display.idr, "bigint", [
        (98820000, "Rp 98.820.000"), (1250000, "Rp 1.250.000"), (0, "Rp 0"), (None, "Rp 0"),
        (250000000, "Rp 250.000.000"), (3800, "Rp 3.800"), (-3800, "Rp -3.800"),
    ]),
    "phone_text": (display.phone, "string", [
        ("+6281725996882", "+62 817-2599-6882"), ("+6281234567890", "+62 812-3456-7890"), ("", ""), (None, ""),
        ("+62123", "+62123"),
    ]),
    "phone_masked": (display.phone_masked, "string", [
        ("+6281725996882", "+62...6882"), ("1234", "1234"), ("", ""), (None, ""),
    ]),
    "timestamp": (temporal.timestamp, "string", [
        ("2026-01-02T03:04:05+07:00", datetime(2026, 1, 1, 20, 4, 5)),
        ("2026-01-02T03:04:05Z", datetime(2026, 1, 2, 3, 4, 5)),
        ("2026-01-02 03:04:05.987", datetime(2026, 1, 2, 3, 4, 5)), ("2026-01-02", datetime(2026, 1, 2)),
        ("02/01/2026", datetime(2026, 1, 2)), ("2/1/2026 4:05:06", datetime(2026, 1, 2, 4, 5, 6)),
        ("20260102", datetime(2026, 1, 2)), ("20260102030405", datetime(2026, 1, 2, 3, 4, 5)),
        ("5 Jan 2026", datetime(2026, 1, 5)), ("1767322800", datetime(2026, 1, 2, 3, 0, 0)),
        ("03:04:05", None), ("2026", None), ("besok", None), ("", None), (None, None), ("31/02/2026", None),
    ]),
    "timestamp_id": (temporal.timestamp_id, "string", [
        ("15 Agt 2024", datetime(2024, 8, 15)), ("3 Jan 2025", datetime(2025, 1, 3)),
        ("1 Mei 2024", datetime(2024, 5, 1)), ("9 Okt 2024", datetime(2024, 10, 9)),
        ("25 Des 2024", datetime(2024, 12, 25)),
    ]),
    "timestamp_local": (lambda c: temporal.timestamp(c, "Asia/Jakarta"), "string", [
        ("2026-01-02 07:00:00", datetime(2026, 1, 2)), ("2026-01-02T07:00:00+07:00", datetime(2026, 1, 2)),
    ]),
}


@pytest.mark.parametrize("name", CASES)
def test_golden(spark, name):
    fn, kind, cases = CASES[name]
    got = values(spark, fn, [c[0] for c in cases], kind)
    assert dict(zip(range(len(cases)), got)) == {i: want for i, (_, want) in enumerate(cases)}


def test_extra_sentinels(spark):
    assert values(spark, lambda c: C.phone(c, extra_sentinels=True), ["N/A", "unknown", "-1"]) == [None] * 3
    assert values(spark, lambda c: C.person_name(c, extra_sentinels=True), ["N/A", "ani"]) == [None, "Ani"]


def test_hours_count_boundaries(spark):
    row = spark.sql("select timestamp'2026-01-01 10:59:00' a, timestamp'2026-01-01 11:00:00' b")
    assert row.select(temporal.hours_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_days_since_never_negative(spark):
    got = values(spark, lambda c: temporal.days_since(c.cast("timestamp"), "2026-06-01"), ["2026-05-31 23:59:59", "2026-07-01"])
    assert got == [1, 0]


def test_ids(spark):
    [rid] = values(spark, identity.resolved_id, [" Ani@X.id "])
    [hexed] = values(spark, identity.hex_id, [rid])
    assert len(rid) == 27 and len(hexed) == 30 and hexed.startswith("72635F")
    assert identity.id_from_hex(hexed) == rid
    assert identity.id_from_hex(hexed.lower()) == rid
    assert identity.id_from_hex("zz") is None


def test_tier_order(spark):
    df = spark.createDataFrame(
        [(20_000_000, 91), (10_000_000, 90), (9_999_999, 0), (2_000_000, 0), (1_999_999, 0)], "clv bigint, d bigint"
    )
    got = [r[0] for r in df.select(scoring.loyalty_tier(F.col("clv"), F.col("d"))).collect()]
    assert got == ["churn_risk", "gold", "silver", "silver", "churn_risk"]


def test_churn_score_bounds_and_middle(spark):
    df = spark.createDataFrame(
        [(0, 400, 5, 0, 9), (10_000_000, 0, 0, 4, 0), (6_000_000, 90, 1, 2, 0)],
        "clv bigint, d bigint, lost bigint, n bigint, c bigint",
    )
    score = scoring.churn_score(*[F.col(c) for c in ("clv", "d", "lost", "n", "c")])
    got = [round(r[0], 6) for r in df.select(score).collect()]
    assert got == [1.0, 0.0, round(0.2 + 0.2 + 0.075, 6)]
