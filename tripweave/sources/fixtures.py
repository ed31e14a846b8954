"""Dirty travel inputs derived from the star-schema test tables.

The SQL text runs unchanged in Spark SQL and DuckDB. It names its inputs ``{customer}``, ``{orders}``
and so on: Spark binds DataFrames to them, the oracle binds plain table names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _text(expr: str) -> str:
    return f"cast({expr} as varchar(20))"


def _padded(expr: str, width: int) -> str:
    # Never cuts digits off, so ids stay unique when the tables outgrow the width.
    text = _text(expr)
    return f"lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


_MOMENT = "timestamp '2026-01-01 00:00:00' + d * interval '1' day + s * interval '1' second"


def _iso(expr: str) -> str:
    return f"replace(substr(cast({expr} as varchar(30)), 1, 19), ' ', 'T') || '+07:00'"


def _cases(on: str, values: list[str], otherwise: str) -> str:
    """The n-th value where ``on`` is n."""
    return f"case {on} " + " ".join(f"when {i} then {v}" for i, v in enumerate(values)) + f" else {otherwise} end"


# The booking type is k modulo 3, so values are chosen by the whole part of k / 3: every type meets every value.
_J = "cast(floor(k / 3) as bigint)"
_PAYMENT = _cases(f"{_J} % 10", [
    "'bank transfer bca'", "'Bank Transfer Mandiri'", "' bank transfer BRI'", "'BANK TRANSFER BNI'", "'Bank Transfer (BRI)'",
    "'bank transfer (bca)'", "'Bank Transfer (Mandiri)'", "'QRIS'", "' GoPay '",
], "'COD'") + " as payment_method"
_TITLED = [f"'{t} ' || c_name" for t in (
    "Bpk.", "IBU", "sdr.", "H.", "drs.", "Dr.", "DRG.", "Ir.", "tgk.", "Dt.", "R.", "r.a."
)] + [f"c_name || ', {d}'" for d in (
    "S.Kom.", "s.ip.", "S.FARM.", "S.Ked.", "s.sos.", "S.Psi.", "S.H.", "S.E.", "M.Kom.", "m.m.", "M.T. "
)]
_NAME = _cases("c_custkey % 32", [
    *_TITLED, "''", "' dr.  ' || c_name || ' wijaya'", "' dr.  ' || c_name || ' wijaya'", "upper(c_name)", "'bpk ' || c_name",
], "c_name")
_BODY = _cases("event_id % 5", ["'JosÃ kamar bau rokok '", "' Ânda telat Å'", "'ÄäãÃ'", "'bersih'"], "null")
_STATUS = (
    "case k % 8 when 0 then 'batal' when 1 then 'selesai' when 2 then 'tidak_hadir' when 3 then ' Completed ' "
    "when 4 then 'cancelled' when 5 then 'COMPLETED' when 6 then 'confirmed' else 'selesai' end as booking_status"
)
_VENDOR_EMAIL = f"""case o_custkey % 10 when 4 then 'user' || {_text('o_custkey')} || '@yahoo.co.id'
       when 5 then 'vendor' || {_text('o_custkey')} || '@outlook.com'
       when 2 then 'User' || {_text('o_custkey')} || '+trip@GMAIL.com'
       else 'user' || {_text('o_custkey')} || '@gmail.com' end as email"""
_BOOKING_REF = f"{_padded('k', 8)} || '-' || cast(dup as varchar(20))"
_CREATED = "timestamp '2026-01-01 06:00:00' + (c_custkey % 300) * interval '1' day"
_UPDATED = f"{_CREATED} + (c_custkey % 40) * interval '1' hour"
_TICKET_AT = (
    "timestamp '2026-01-01 00:00:00' + ((event_id * 7919) % 365) * interval '1' day "
    "+ ((event_id * 104729) % 86400) * interval '1' second"
)

_ORDERS = """
select o_orderkey, o_custkey, o_orderkey as k, 0 as dup,
  cast(floor(o_totalprice) as bigint) * 50 as amount_idr,
  (o_orderkey * 7919) % 365 as d, (o_orderkey * 104729) % 86400 as s from {orders}
union all
select o_orderkey, o_custkey, o_orderkey as k, 1 as dup,
  cast(floor(o_totalprice) as bigint) * 50 + (o_orderkey % 5) - 2 as amount_idr,
  (o_orderkey * 7919) % 365 as d, (o_orderkey * 104729) % 86400 as s from {orders} where o_orderkey % 20 < 3
"""

SQL = {
    "customers": f"""
select 'CST-' || {_padded('c_custkey', 6)} as customer_id,
  case when c_custkey % 50 = 17 then 'user' || {_text('c_custkey - 1')} || '@gmail.com'
       when c_custkey % 10 = 0 then 'USER' || {_text('c_custkey')} || '@Gmail.COM'
       when c_custkey % 10 = 1 then 'user' || {_text('c_custkey')} || '+promo@gmail.com'
       when c_custkey % 10 = 2 then ' user' || {_text('c_custkey')} || '@gnail.com'
       when c_custkey % 10 = 3 then 'user' || {_text('c_custkey')} || '@gmaill.com '
       when c_custkey % 10 = 4 then 'user' || {_text('c_custkey')} || '@yaho.co.id'
       when c_custkey % 10 = 5 then ''
       else 'user' || {_text('c_custkey')} || '@gmail.com' end as email,
  case c_custkey % 9
       when 0 then '+62 812-' || {_padded('c_custkey', 8)}
       when 1 then '0812-' || {_padded('c_custkey', 8)}
       when 2 then '62812' || {_padded('c_custkey', 8)}
       when 3 then '812' || {_padded('c_custkey', 8)}
       when 4 then 'TIDAK ADA' when 5 then '000-000-0000' when 6 then '12345' when 7 then ''
       else '0812 ' || {_padded('c_custkey', 8)} end as phone,
  {_NAME} as full_name,
  ' Jl. Merdeka No. ' || {_text('c_custkey')} || ' ' as address,
  lower(n_name) as city, upper(r_name) as province,
  lpad({_text('c_custkey')}, 7, '1') as postal_code,
  case c_custkey % 4 when 0 then 'Gold' when 1 then ' silver ' when 2 then '' else null end as loyalty_tier,
  case c_custkey % 3 when 0 then ' Garuda ' when 1 then '' else null end as preferred_airline,
  {_CREATED} as created_at, {_UPDATED} as updated_at, cast({_UPDATED} as date) as ingest_date
from {{customer}} join {{nation}} on c_nationkey = n_nationkey join {{region}} on n_regionkey = r_regionkey
""",
    "hotel_bookings": f"""
select 'HTL-' || {_BOOKING_REF} as booking_id, 'CST-' || {_padded('o_custkey', 6)} as customer_id,
  ' grand HOTEL ' || {_text('o_custkey % 20')} as hotel_name,
  case k % 4 when 0 then 'kuta' when 1 then 'LABUAN bajo' when 2 then 'Ubud' else 'yogyakarta ' end as hotel_city,
  cast({_MOMENT} as date) as check_in_date, cast({_MOMENT} + interval '2' day as date) as check_out_date,
  'deluxe ROOM' as room_type, cast(case when k % 11 = 0 then null else k % 4 + 1 end as bigint) as guests,
  amount_idr, {_PAYMENT}, {_STATUS}, {_MOMENT} as booking_ts, cast({_MOMENT} as date) as ingest_date
from ({_ORDERS}) fx_orders where k % 3 = 0
""",
    "flights": f"""
select 'FLT-' || {_BOOKING_REF} as booking_ref, {_VENDOR_EMAIL},
  case {_J} % 3 when 0 then 'garuda INDONESIA' when 1 then 'lion air' else 'Citilink' end as airline,
  'ga' || {_text('100 + k % 900')} as flight_number,
  case k % 5 when 0 then 'cgk' when 1 then 'SUB' when 2 then 'kno ' when 3 then 'UPG' else 'CGK' end as origin,
  case k % 4 when 0 then 'DPS' when 1 then 'jog' when 2 then 'SIN' else ' dps' end as destination,
  {_iso(_MOMENT)} as departure_ts, {_iso(_MOMENT)} as arrival_ts,
  'Sdr. passenger ' || {_text('o_custkey')} as passenger_name,
  case k % 10 when 0 then 'Business' when 1 then 'first' else 'economy' end as seat_class,
  amount_idr, {_PAYMENT}, {_STATUS}, {_iso(_MOMENT)} as booking_ts, cast({_MOMENT} as date) as ingest_date
from ({_ORDERS}) fx_orders where k % 3 = 1
""",
    "experiences": f"""
select 'EXP-' || {_BOOKING_REF} as booking_ref, {_VENDOR_EMAIL},
  'cooking CLASS ' || {_text('k % 12')} as experience_name,
  case {_J} % 4 when 0 then 'ubud' when 1 then 'LOMBOK' when 2 then ' Yogyakarta' else 'labuan bajo' end as city,
  case k % 4 when 0 then ' Culinary' when 1 then 'DIVING' when 2 then 'trek' else null end as category,
  substr(cast({_MOMENT} + interval '3' day as varchar(30)), 1, 10) as activity_date,
  cast(case when k % 13 = 0 then 0 else k % 4 + 1 end as bigint) as participants,
  amount_idr, {_PAYMENT}, {_STATUS}, {_iso(_MOMENT)} as booking_ts, cast({_MOMENT} as date) as ingest_date
from ({_ORDERS}) fx_orders where k % 3 = 2
""",
    "tickets": f"""
select 'TKT-' || {_padded('event_id', 8)} as ticket_id,
  case event_id % 6 when 0 then '' when 1 then 'work' || {_text('user_id')} || '@cv-makmur.co.id'
       else 'user' || {_text('user_id')} || '@gmail.com' end as customer_email,
  case event_id % 5 when 0 then 'tidak diketahui' when 1 then '0'
       else '0812-' || {_padded('user_id', 8)} end as customer_phone,
  'Ibu Customer ' || {_text('user_id')} as customer_name,
  ' ' || event_type || ' hotel ' as subject, {_BODY} as body,
  case event_id % 4 when 0 then 'Open' when 1 then 'in_progress' when 2 then 'resolved' else ' closed' end as status,
  case event_id % 7 when 0 then 'Critical' when 1 then 'high' when 2 then 'low' else 'medium' end as priority,
  'WhatsApp' as channel, {_iso(_TICKET_AT)} as created_at,
  case when event_id % 4 >= 2
       then {_iso(_TICKET_AT + " + (event_id % 72) * interval '1' hour + interval '30' minute")}
       else null end as resolved_at,
  upper(event_type) || ' ' as category, 'agent SATU' as agent_name, cast({_TICKET_AT} as date) as ingest_date
from {{events}}
""",
}

_INPUTS = {
    "customers": ["customer", "nation", "region"],
    "hotel_bookings": ["orders"],
    "flights": ["orders"],
    "experiences": ["orders"],
    "tickets": ["events"],
}


# Narrow inputs of wide rows: their file has fewer splits than there are cores, so rows are dealt by id before the
# columns are derived. Inputs that streams write to files are not dealt, it would change the number of those files.
_SPREAD = {"customer": "c_custkey"}


def landed(spark: SparkSession, source_dir: str, name: str) -> DataFrame:
    """One landed table, derived lazily from the Parquet tables under ``source_dir``."""
    inputs = {t: spark.read.parquet(f"{source_dir}/{t}.parquet") for t in _INPUTS[name]}
    for t, key in _SPREAD.items():
        if t in inputs:
            inputs[t] = inputs[t].repartition(key)
    return spark.sql(SQL[name], **inputs)
