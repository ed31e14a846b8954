"""The check SQL of every registered query."""

from __future__ import annotations

from oracle.ctes import (
    HOLIDAY, at7, arr, customers_from, day, dec, email, first_by, hexid, hotels_from, name, num, phone, query, rcid,
    status, payment, hundreds, title, ts,
)

CHECKS: dict[str, str] = {}


def check(key: str, sql: str, **extra: str) -> None:
    CHECKS[key] = query(sql, **extra)


# ---- landing ------------------------------------------------------------------------------

LOW, HIGH = "2026-02-01", "2026-11-01"

_CUSTOMER_ROW = f"""customer_id, email, phone, full_name, address, city, province, postal_code, loyalty_tier,
  preferred_airline, {ts('created_at')}, {ts('updated_at')}"""
_HOTEL_ROW = f"""booking_id, customer_id, hotel_name, hotel_city, {day('check_in_date')}, {day('check_out_date')},
  room_type, {num('guests')}, {num('amount_idr')}, payment_method, booking_status, {ts('booking_ts')}"""
_FLIGHT_RAW = f"""booking_ref, email, airline, flight_number, origin, destination, departure_ts, arrival_ts,
  passenger_name, seat_class, {num('amount_idr')}, payment_method, booking_status, booking_ts"""
_EXPERIENCE_RAW = f"""booking_ref, email, experience_name, city, category, activity_date, {num('participants')},
  {num('amount_idr')}, payment_method, booking_status, booking_ts"""
_TICKET_RAW = f"""ticket_id, customer_email, customer_phone, customer_name, subject, body, status, priority, channel,
  created_at, resolved_at, category, agent_name, {day('ingest_date')}"""
_TICKET_ROW = f"""ticket_id, customer_email, customer_phone, customer_name, subject, body, status, priority, channel,
  {ts('created_at')}, {ts('resolved_at')}, category, agent_name"""

check("land_customers_slice", f"""select {_CUSTOMER_ROW} from fx_customers
where updated_at >= timestamp '{LOW} 00:00:00' and updated_at < timestamp '{HIGH} 00:00:00'""")
check("land_hotel_slice", f"""select {_HOTEL_ROW} from fx_hotel_bookings
where booking_ts >= timestamp '{LOW} 00:00:00' and booking_ts < timestamp '{HIGH} 00:00:00'""")
for _key, _table, _row in (
    ("land_flights_slice", "fx_flights", _FLIGHT_RAW), ("land_experiences_slice", "fx_experiences", _EXPERIENCE_RAW)
):
    # The text carries local time at +07:00, so dropping the offset compares the same local clock.
    check(_key, f"""select {_row} from {_table}
where cast(substr(booking_ts, 1, 19) as timestamp) >= timestamp '{LOW} 00:00:00'
  and cast(substr(booking_ts, 1, 19) as timestamp) < timestamp '{HIGH} 00:00:00'""")
check("paged_bookings", f"""select {_FLIGHT_RAW}, {day('ingest_date')} from fx_flights f
order by f.booking_ts desc, f.booking_ref limit 100 offset 200""")
check("paged_bookings_total", "select count(*) as total from fx_flights")
check("source_row_counts", " union all ".join(
    f"select '{t}' as table_name, count(*) as row_count from fx_{t}"
    for t in ("customers", "hotel_bookings", "flights", "experiences", "tickets")
))
check("land_tickets_file", f"select {_TICKET_RAW} from fx_tickets")
check("land_api_pages", f"select {_FLIGHT_RAW} from fx_flights")
check("bronze_typed_scan", f"select {_HOTEL_ROW}, {day('ingest_date')} from fx_hotel_bookings")
check("clustered_write_readback", f"select {_CUSTOMER_ROW}, {day('ingest_date')} from fx_customers")
check("land_replace_partition", f"""select {day('ingest_date')}, count(*) as row_count,
  cast(sum(amount_idr + case when month(ingest_date) = 4 then 100 else 0 end) as bigint) as amount_idr
from fx_hotel_bookings where ingest_date <> date '2026-04-15' group by ingest_date""")
check("land_append_stamped", f"""select {day('d', 'ingest_date')}, count(*) as row_count,
  2 * (select count(*) from fx_experiences) as reported_rows
from (select ingest_date as d from fx_experiences union all select date '2026-12-31' from fx_experiences) group by d""")
check("read_partitions", """select 'all' as table_name, count(*) as row_count from fx_hotel_bookings
union all select 'one', count(*) from fx_hotel_bookings where ingest_date = date '2026-05-05'
union all select 'list', count(*) from fx_hotel_bookings
  where ingest_date in (date '2026-05-05', date '2026-06-06', date '2026-07-07')
union all select 'none', 0""")
check("bronze_window_scan", f"""select {_TICKET_RAW} from fx_tickets t
where t.ingest_date >= date '{LOW}' and t.ingest_date < date '{HIGH}'""")

_SAME_STAY = "customer_id, lower(trim(hotel_name)), check_in_date, amount_idr"


def _hotel_window(low: str, high: str) -> str:
    return f"select * from fx_hotel_bookings where ingest_date >= date '{low}' and ingest_date < date '{high}'"


for _key, _low, _high in (
    ("backfill_range", "2026-03-01", "2026-10-01"), ("backfill_full_refresh", "2026-01-01", "2026-10-01")
):
    check(_key, f"select {_HOTEL_ROW} from kept",
          landed=_hotel_window(_low, _high), cleansed=hotels_from("landed"),
          kept=first_by("cleansed", _SAME_STAY, "booking_id"))

check("upsert_customers", f"""select {_CUSTOMER_ROW} from newer
union all select {_CUSTOMER_ROW} from older o where not exists (select 1 from newer n where n.customer_id = o.customer_id)""",
      older=customers_from("(select * from fx_customers where ingest_date < date '2026-08-01')"),
      newer=customers_from("(select * replace (' PLATINUM' as loyalty_tier) from fx_customers "
                           "where ingest_date >= date '2026-06-01')"))
check("late_amendments", f"""select {_HOTEL_ROW} from kept
union all select {_HOTEL_ROW} from s_hotels s where not exists (select 1 from kept k where k.booking_id = s.booking_id)""",
      landed=f"select * replace ('BATAL' as booking_status) from ({_hotel_window('2026-05-01', '2026-07-01')})",
      cleansed=hotels_from("landed"), kept=first_by("cleansed", _SAME_STAY, "booking_id"))
check("land_schema_drift", f"select {_CUSTOMER_ROW} from cleansed",
      drifted="""select * replace (case when ingest_date < date '2026-04-01' then null else loyalty_tier end as loyalty_tier,
  case when ingest_date < date '2026-04-01' then null else preferred_airline end as preferred_airline) from fx_customers""",
      cleansed=customers_from("drifted"))

_COLUMNS = {
    "customers": "customer_id email phone full_name address city province postal_code loyalty_tier preferred_airline "
                 "created_at:datetime updated_at:datetime ingest_date:datetime",
    "hotel_bookings": "booking_id customer_id hotel_name hotel_city check_in_date:datetime check_out_date:datetime "
                      "room_type guests:integer amount_idr:integer payment_method booking_status booking_ts:datetime "
                      "ingest_date:datetime",
    "flights": "booking_ref email airline flight_number origin destination departure_ts arrival_ts passenger_name "
               "seat_class amount_idr:integer payment_method booking_status booking_ts ingest_date:datetime",
    "experiences": "booking_ref email experience_name city category activity_date participants:integer "
                   "amount_idr:integer payment_method booking_status booking_ts ingest_date:datetime",
    "tickets": "ticket_id customer_email customer_phone customer_name subject body status priority channel created_at "
               "resolved_at category agent_name ingest_date:datetime",
}
check("landing_profile", " union all ".join(
    f"select '{t}' as table_name, count(*) as row_count, count(distinct ingest_date) as partitions, {i} as position, "
    f"'{c.split(':')[0]}' as column_name, '{(c.split(':') + ['string'])[1]}' as column_type, "
    f"count(*) - count({c.split(':')[0]}) as null_count from fx_{t}"
    for t, columns in _COLUMNS.items() for i, c in enumerate(columns.split())
))
check("daily_booking_counts", " union all ".join(
    f"""select * from (select '{t}' as table_name, strftime({at}, '%Y-%m-%d') as day, count(*) as bookings
from fx_{t} group by 2 order by 2 desc limit 5)"""
    for t, at in (("hotel_bookings", "booking_ts"), ("flights", at7("booking_ts")), ("experiences", at7("booking_ts")))
))

# ---- checks -------------------------------------------------------------------------------

_KEYS = {"customers": "customer_id", "hotel_bookings": "booking_id", "flights": "booking_ref",
         "experiences": "booking_ref", "tickets": "ticket_id"}
_SILVER = {"silver_customers": ("s_customers", "customer_id"), "silver_hotel_bookings": ("s_hotels", "booking_id"),
           "silver_flight_bookings": ("s_flights", "booking_ref"),
           "silver_experience_bookings": ("s_experiences", "booking_ref"), "silver_tickets": ("s_tickets", "ticket_id")}
_GOLD = {"dim_customer": ("dim", "resolved_customer_id"), "fact_bookings": ("fact", "booking_id"),
         "mart_customer_clv": ("mart", "resolved_customer_id"), "mart_route_monthly": ("routes", "_pk")}


def _summary(kind: str, table: str, rows: str, fail: str, passed: str, source: str, severity: str = "error",
             message: str = "cast(null as varchar)") -> str:
    return (
        f"select '{kind}' as check_name, '{table}' as table_name, '{severity}' as severity, {num(rows, 'n_rows')}, "
        f"{num(fail, 'n_fail')}, cast({passed} as bigint) as passed, {message} as message from {source}"
    )


check("check_not_empty", " union all ".join(
    _summary("not_empty", t, "count(*)", "count(*) = 0", "count(*) > 0", f"fx_{t}") for t in _KEYS
))
check("check_no_null_keys", " union all ".join(
    [_summary("not_null", t, "count(*)", f"count(*) - count({k})", f"count(*) = count({k})", f"fx_{t}")
     for t, k in _KEYS.items() if t != "tickets"]
    + [_summary("not_null", "tickets", "count(*)", "count(*)", "false", "fx_tickets",
                message="'column ticket_id not found'")]
))
check("check_unique_keys", " union all ".join(
    _summary("unique", t, "count(*)", f"count(*) - count(distinct (ingest_date, {k}))",
             f"count(*) = count(distinct (ingest_date, {k}))",
             f"fx_{t}" if t != "customers" else "(select * from fx_customers union all select * from fx_customers)")
    for t, k in _KEYS.items()
))


def _key_checks(tables: dict[str, tuple[str, str]]) -> list[str]:
    out = []
    for t, (source, k) in tables.items():
        out.append(_summary("not_null", t, "count(*)", f"count(*) - count({k})", f"count(*) = count({k})", source))
        out.append(_summary("unique", t, f"count({k})", f"count({k}) - count(distinct {k})",
                            f"count({k}) = count(distinct {k})", source))
    return out


check("check_silver_keys", " union all ".join(_key_checks(_SILVER)))
check("check_gold_keys", " union all ".join(_key_checks(_GOLD) + [
    _summary("not_null", "fact_bookings", "count(*)", "count(*) - count(resolved_customer_id)",
             "count(*) = count(resolved_customer_id)", "fact", severity="warn")
]))

_BAD = {
    "email_valid": ("{c} is not null and ({c} = '' or {c} not like '%@%.%')",
                    [("silver_customers", "email"), ("silver_flight_bookings", "email"),
                     ("silver_experience_bookings", "email"), ("silver_tickets", "customer_email")]),
    "phone_e164": ("{c} is not null and not regexp_full_match({c}, '\\+62[0-9]+')",
                   [("silver_customers", "phone"), ("silver_tickets", "customer_phone")]),
    "no_sentinels": ("{c} in ('TIDAK ADA', '000-000-0000', '')",
                     [("silver_customers", "phone"), ("silver_tickets", "customer_phone")]),
    "amount_positive": ("{c} <= 0",
                        [("silver_hotel_bookings", "amount_idr"), ("silver_flight_bookings", "amount_idr"),
                         ("silver_experience_bookings", "amount_idr")]),
}
for _kind, (_rule, _targets) in _BAD.items():
    check(f"check_{_kind}", " union all ".join(
        f"""select '{_kind}' as check_name, '{t}' as table_name, count(*) as n_rows,
  count(*) filter (where {_rule.format(c=c)}) as n_fail,
  cast(count(*) filter (where {_rule.format(c=c)}) = 0 as bigint) as passed from {_SILVER[t][0]}"""
        for t, c in _targets
    ))
_DIRTY = {"silver_customers": "fx_customers", "silver_tickets": "fx_tickets", "silver_hotel_bookings": "negated"}
check("check_failures_all", " union all ".join(
    f"select '{kind}' as check_name, {_SILVER[t][1]} as entity_id, '{t}' as source, cast({c} as varchar) as bad_value "
    f"from {_DIRTY.get(t, _SILVER[t][0])} where {rule.format(c=c)}"
    for kind, (rule, targets) in _BAD.items() for t, c in targets
), negated="select * replace (case when booking_status = 'batal' then -amount_idr else amount_idr end as amount_idr) "
           "from fx_hotel_bookings")
check("check_identity_fan_out", " union all ".join(
    f"""select '{c}' as link, max(n) as largest, count(*) filter (where n > 1) as shared_values
from (select {c}, count(*) as n from people where {c} is not null group by {c})""" for c in ("email", "phone")
))
check("check_unresolved_tickets", "select count(*) as tickets from records where owner is null and ticket_id is not null")
check("check_postal_city", f"""select s.customer_id, s.city, s.postal_code from s_customers s
join (select {title('n_name')} as city, '1' || (n_nationkey % 10) as prefix from nation) p on p.city = s.city
where not starts_with(s.postal_code, p.prefix)""")

# ---- scalar cleansing ---------------------------------------------------------------------

check("norm_email", " union all ".join(
    f"select {k} as record_id, {email(c)} as email from {t}"
    for t, k, c in (("fx_customers", "customer_id", "email"), ("fx_flights", "booking_ref", "email"),
                    ("fx_experiences", "booking_ref", "email"), ("fx_tickets", "ticket_id", "customer_email"))
))
check("norm_phone", " union all ".join(
    f"select {k} as record_id, {phone(c)} as phone from {t}"
    for t, k, c in (("fx_customers", "customer_id", "phone"), ("fx_tickets", "ticket_id", "customer_phone"))
))
more_sentinels = ", 'N/A', 'unknown', '-1'"
check("norm_extra_sentinels", f"""select customer_id, {phone('raw', more_sentinels)} as phone,
  {name('full_name')} as full_name from (
  select customer_id, full_name, case phone when 'TIDAK ADA' then 'N/A' when '000-000-0000' then 'unknown' else phone end as raw
  from fx_customers)""")
_EVERY = """select booking_id, amount_idr, payment_method, booking_status from fx_hotel_bookings
  union all select booking_ref, amount_idr, payment_method, booking_status from fx_flights
  union all select booking_ref, amount_idr, payment_method, booking_status from fx_experiences"""
check("norm_amount", f"""select booking_id, {hundreds('amount_idr')} as from_number,
  case booking_status when 'tidak_hadir' then null when 'confirmed' then {hundreds('amount_idr * 100')}
    else {hundreds('amount_idr')} end as from_text from every_booking""", every_booking=_EVERY)
check("norm_name", f"select customer_id, {name('full_name')} as full_name from fx_customers")
check("title_case", " union all ".join(
    f"select {k} as booking_id, '{c}' as field, {title(c)} as text from {t}"
    for t, k, columns in (("fx_hotel_bookings", "booking_id", "hotel_name hotel_city room_type"), ("fx_flights", "booking_ref", "airline"),
                          ("fx_experiences", "booking_ref", "experience_name city")) for c in columns.split()
))
check("parse_ts", """select booking_id, strftime(case month(booking_ts) when 1 then booking_ts - interval 7 hour
  when 4 then date_trunc('day', booking_ts) when 5 then date_trunc('day', booking_ts)
  when 6 then date_trunc('day', booking_ts) when 8 then null else booking_ts end, '%Y-%m-%d %H:%M:%S') as parsed_ts
from fx_hotel_bookings""")
check("parse_ts_id", "select booking_id, strftime(check_in_date, '%Y-%m-%d') as parsed_day from fx_hotel_bookings")
check("norm_payment", f"""select booking_id, {payment('payment_method')} as payment_method,
  case when lower(payment_method) in ('bank transfer (bca)', 'bank transfer (mandiri)', 'bank transfer (bri)', 'bank transfer (bni)')
    then {payment("replace(replace(payment_method, '(', ''), ')', '')")} else {payment('payment_method')} end
    as payment_lenient from every_booking""", every_booking=_EVERY)
check("norm_status", f"select booking_id, {status('booking_status')} as booking_status from every_booking", every_booking=_EVERY)
check("norm_counts", """select booking_id, coalesce(guests, 1) as people from fx_hotel_bookings
union all select booking_ref, case when participants > 0 then participants else 1 end from fx_experiences""")
check("strip_mojibake", """select ticket_id, trim(regexp_replace(body, '[ÂâÃãÄäÅå]', '', 'g')) as body
from fx_tickets""")
check("identity_hash", f"""select customer_id, {rcid('email')} as resolved_customer_id,
  {hexid(rcid('email'))} as rcid_hex from s_customers where email is not null and email <> ''""")
check("format_idr", """select booking_id, case when amount_idr is null or amount_idr = 0 then 'Rp 0'
  else 'Rp ' || replace(format('{:,}', amount_idr), ',', '.') end as amount_text from fact""")
check("format_phone", """select customer_id, case when phone is null then ''
    when phone like '+62%' and length(phone) >= 12
    then phone[1:3] || ' ' || phone[4:6] || '-' || phone[7:10] || '-' || phone[11:] else phone end as phone_text,
  case when phone is null then '' when length(phone) >= 8 then '+62...' || right(phone, 4) else phone end as phone_masked
from s_customers""")
check("holiday_window", f"""select booking_id, {day('year_month')}, {HOLIDAY} as holiday_window from (
  select booking_id, cast(date_trunc('month', booking_ts) as date) as year_month from fact)""")

# ---- models -------------------------------------------------------------------------------

_HOTEL_SILVER = _HOTEL_ROW
_FLIGHT_ROW = f"""booking_ref, email, airline, flight_number, origin, destination, {ts('departure_ts')},
  {ts('arrival_ts')}, passenger_name, seat_class, {num('amount_idr')}, payment_method, booking_status, {ts('booking_ts')}"""
_EXPERIENCE_ROW = f"""booking_ref, email, experience_name, city, category, {day('activity_date')}, {num('participants')},
  {num('amount_idr')}, payment_method, booking_status, {ts('booking_ts')}"""
check("silver_customers", f"select {_CUSTOMER_ROW} from s_customers")
check("silver_hotel_bookings", f"select {_HOTEL_SILVER} from s_hotels")
check("silver_flight_bookings", f"select {_FLIGHT_ROW} from s_flights")
check("silver_experience_bookings", f"select {_EXPERIENCE_ROW} from s_experiences")
check("silver_tickets", f"select {_TICKET_ROW} from s_tickets")

_DIM_ROW = f"""resolved_customer_id, {arr('emails')}, {arr('phones')}, name_std, address_city, address_province,
  address_postal_code, {arr('source_customer_ids')}, {arr('source_systems')}, {ts('first_seen')}, {ts('last_seen')},
  {num('dormant_days')}, identity_confidence, {num('clv_idr')}, loyalty_tier"""
_BOOKING_ROW = f"""booking_type, provider, city, origin, destination, {num('amount_idr')}, payment_method,
  {ts('booking_ts')}, status, {day('check_in_date')}, {day('check_out_date')}, {ts('departure_ts')}, {ts('arrival_ts')},
  {day('activity_date')}, seat_class, category, {num('guests')}, {num('participants')}"""
_MART_ROW = f"""resolved_customer_id, {num('clv_idr')}, {num('aov_idr')}, {num('booking_count')}, {num('completed_count')},
  {num('cancelled_count')}, {num('no_show_count')}, {ts('last_booking_ts')}, {num('dormant_days')}, loyalty_tier,
  {dec('churn_risk_score')}, {num('has_support_ticket')}, {num('critical_ticket_count')}, {dec('avg_resolution_hours')},
  {num('distinct_booking_types')}, recommended_action"""
_ROUTE_ROW = f"""_pk, route_type, route_key, origin, destination, city, {day('year_month')}, {num('booking_count')},
  {num('unique_travelers')}, {num('amount_idr_total')}, {num('amount_idr_avg')}, {dec('business_class_share')},
  {dec('cancel_rate')}, {dec('no_show_rate')}, holiday_window"""
check("dim_customer", f"select {_DIM_ROW} from dim")
check("fact_bookings", f"""select booking_id, resolved_customer_id, identity_confidence, source, {_BOOKING_ROW}
from fact""")
check("mart_customer_clv", f"select {_MART_ROW} from mart")
check("mart_route_monthly", f"select {_ROUTE_ROW} from routes")
check("route_travelers_approx", "select _pk, booking_count, 1 as within from routes")
check("route_travelers_merged", """select booking_type as route_type,
  if(booking_type = 'flight', origin || '-' || destination, city) as route_key,
  count(distinct date_trunc('month', booking_ts)) as months, count(*) as booking_count,
  count(distinct resolved_customer_id) as unique_travelers, 1 as within from fact group by all""")

check("email_universe", f"""select distinct email, {rcid('email')} as resolved_customer_id from (
  select email from people union all select email from vendor_feed union all select customer_email from s_tickets)
where email <> ''""")
_STAMPS = f"{ts('first_at', 'first_seen')}, {ts('last_at', 'last_seen')}"
_ADDRESS = "person as name_std, city as address_city, province as address_province, postal_code as address_postal_code"
check("app_anchors", f"""select owner as resolved_customer_id, substr(source_key, 5) as customer_id, email, phone, {_ADDRESS},
  {_STAMPS}, source_key as source_customer_id, system as source_system, {num('strength', 'confidence_rank')}
from records where system = 'app_oltp'""")
check("vendor_grouped", f"""select email, {ts('min(booking_ts)', 'first_seen')}, {ts('max(booking_ts)', 'last_seen')}
from vendor_feed group by email""")
_IDENTITY_ROW = f"""owner as resolved_customer_id, source_key as source_customer_id, system as source_system,
  {num('strength', 'confidence_rank')}, {_STAMPS}, email, phone, {_ADDRESS}"""
check("vendor_identities", f"select {_IDENTITY_ROW} from records where system = 'vendor_api' and strength = 1")
check("vendor_links", f"select {_IDENTITY_ROW} from records where system = 'vendor_api' and strength = 3")
check("identity_rows", f"select {_IDENTITY_ROW} from records")
check("crm_candidates", f"""select owner as resolved_customer_id, ticket_id, email as customer_email, phone as customer_phone,
  person as name_std, {_STAMPS}, source_key as source_customer_id, system as source_system,
  {num('strength', 'confidence_rank')} from records where system = 'crm'""")
check("phone_owners", "select phone, owner as resolved_customer_id from phone_book")
check("ticket_links", f"""select * exclude (p) from (select strength = 2 as p, case when strength = 2 then 'phone' when email <> '' then 'email' end as link,
  case when strength = 2 then phone when email <> '' then email end as link_value, strength as confidence_rank,
  {ts('min(first_at)', 'first_seen')}, {ts('max(last_at)', 'last_seen')}, count(*) as tickets,
  count(*) filter (t.priority = 'critical') as critical,
  {num("sum(date_diff('hour', t.created_at, t.resolved_at))", 'hours')}, count(t.resolved_at) as timed
from one_each join s_tickets t using (ticket_id) group by all)""",
      one_each="select distinct ticket_id, strength, email, phone, first_at, last_at from records where system = 'crm'")
check("clv_by_resolved", f"select resolved_customer_id, {num('clv_idr')} from dim")
check("clv_by_resolved_faithful", f"""select d.resolved_customer_id, {num('coalesce(sum(idr), 0)', 'clv_idr')} from dim d left join (
  select {rcid('v.email')} as owner, amount_idr as idr from vendor_feed v left join people p on p.email = v.email
  where booking_status = 'completed'
  union all select p.owner, h.amount_idr from s_hotels h join people p using (customer_id) where booking_status = 'completed') x
on x.owner = d.resolved_customer_id group by d.resolved_customer_id""")
check("customer_keys", """select distinct r.source_key as source_customer_id, r.owner as resolved_customer_id, d.identity_confidence
from records r join dim d on d.resolved_customer_id = r.owner where r.system <> 'crm'""")
check("loyalty_tier", f"""select resolved_customer_id, {num('clv_idr')}, {num('dormant_days')}, loyalty_tier from dim""")
check("bookings_unified", f"select source_customer_id, booking_id, source, {_BOOKING_ROW} from unified")
check("placeholder_ids", f"""select booking_id,
  coalesce(owner, 'ph_' || substr(md5(source_customer_id), 1, 24)) as resolved_customer_id,
  case when owner in (select owner from people) then 'high' when owner is not null then 'email'
    when source_customer_id is not null then 'placeholder' end as identity_confidence
from (select u.booking_id, u.source_customer_id,
    if(u.source = 'app_oltp', p.owner, {rcid('substr(u.source_customer_id, 8)')}) as owner
  from unified u left join people p on u.source_customer_id = 'app:' || p.customer_id)""")
check("bookings_agg", f"""select resolved_customer_id, {num('clv_idr')}, completed_count, cancelled_count, no_show_count,
  booking_count, {ts('last_booking_ts')}, distinct_booking_types, newest.kind as most_recent_booking_type
from figures where booking_count > 0""")
check("support_agg", f"""select resolved_customer_id, critical_ticket_count, {dec('avg_resolution_hours')},
  {num('has_support_ticket')} from figures where has_support_ticket = 1 and resolved_customer_id is not null""")
check("churn_score", f"select resolved_customer_id, {dec('churn_risk_score')} from mart")
check("recommended_action", "select resolved_customer_id, recommended_action from mart")

_LISTS = """select resolved_customer_id, 'emails' as list, emails as v from dim
union all select resolved_customer_id, 'phones', phones from dim
union all select resolved_customer_id, 'source_customer_ids', source_customer_ids from dim"""
check("customer_list_chunks", """select resolved_customer_id, list, chunk, len(v[3 * chunk + 1 : 3 * chunk + 3]) as n_values,
  array_to_string(v[3 * chunk + 1 : 3 * chunk + 3], '|') as values
from (select *, unnest(range(0, cast(ceil(len(v) / 3.0) as bigint))) as chunk from lists)""", lists=_LISTS)
check("customer_short_lists", """select resolved_customer_id, list, len(v) as n_values,
  case when len(v) <= 1000 then array_to_string(v, '|') else '' end as values from lists where len(v) > 0""", lists=_LISTS)

# Reachability over shared phones; UNION drops repeated pairs, so the recursion ends.
CHECKS["identity_components"] = CHECKS["identity_components_daily"] = query(
    """select e.email, coalesce(min(r.reached), e.email) as component_email from every_email e
left join reach r on r.origin = e.email group by e.email""",
    every_email="""select email from people union select email from vendor_feed
  union select customer_email from s_tickets where customer_email <> ''""",
    pairs="""select distinct email, phone from (select email, phone from s_customers
  union all select customer_email, customer_phone from s_tickets)
  where email is not null and email <> '' and phone is not null and phone <> ''""",
    links="select distinct a.email as a, b.email as b from pairs a join pairs b on a.phone = b.phone",
    reach="""select a as origin, b as reached from links
  union select r.origin, l.b from reach r join links l on l.a = r.reached""",
).replace("with ", "with recursive ", 1)

# ---- order reconciliation and re-scans ----------------------------------------------------

check("order_reconciliation", f"""select o_orderkey, {dec('stated', 'stated_total')}, {dec('lines', 'line_total')},
  {dec('stated - coalesce(lines, 0)', 'difference')} from (
  select o_orderkey, cast(o_totalprice as decimal(18,2)) as stated, (select sum(cast(
      cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(6,4)))
      * (1 + cast(l_tax as decimal(6,4))) as decimal(24,2)))
    from lineitem where l_orderkey = o_orderkey) as lines from orders)
where abs(stated - coalesce(lines, 0)) > 100""")
check("latest_rescan", f"""select l_orderkey, l_partkey, {num('l_linenumber')}, {ts('l_shipdate')} from lineitem
qualify row_number() over (partition by l_orderkey, l_partkey order by l_shipdate desc, l_linenumber desc) = 1""")

# ---- executive overview -------------------------------------------------------------------

# Tickets that wait, by priority; customers and bookings each give their own figures, one row in all.
_KPIS = """select total_customers, avg_clv, churn_risk_count, total_revenue, coalesce(sum(n), 0) as open_tickets,
    coalesce(sum(n) filter (priority = 'critical'), 0) as critical_tickets
  from (select count(*) as total_customers, round_even(avg(nullif(greatest(clv_idr, 0), 0)), 0) as avg_clv,
      count_if(loyalty_tier = 'churn_risk') as churn_risk_count from dim)
  cross join (select coalesce(sum(idr), 0) as total_revenue from (select sum(amount_idr) as idr from fact where status = 'completed'))
  left join (select priority, count(*) as n from s_tickets where status in ('open', 'in_progress') group by priority) on true
  group by all"""
check("exec_kpi_summary", f"""select total_customers, {dec('avg_clv')}, {num('total_revenue')}, churn_risk_count, open_tickets,
  critical_tickets from kpis""", kpis=_KPIS)
check("exec_churn_pct", f"""select total_customers, churn_risk_count,
  {dec('churn_risk_count / greatest(total_customers, 1) * 100.0', 'churn_pct')} from kpis""", kpis=_KPIS)
check("exec_identity_funnel", """select array_to_string(source_systems, ', ') as combo, count(*) as cnt from dim group by 1""")
check("exec_tier_mix", f"""select loyalty_tier, count(*) as cnt, {dec('round_even(avg(clv_idr), 0)', 'avg_clv')}
from dim group by loyalty_tier""")
check("exec_revenue_by_type", f"""select booking_type, count(*) as cnt, {num('sum(amount_idr)', 'total_revenue')}
from fact where status = 'completed' group by booking_type""")
check("exec_monthly_revenue", f"""select {day('year_month')}, {num('total', 'total_revenue')} from (
  select year_month, sum(amount_idr_total) as total from routes group by year_month)""")
_CITY = "from routes where city is not null and city <> '' group by city"
check("exec_top_destinations", f"""select city, {num('sum(amount_idr_total)', 'total_revenue')},
  {num('sum(booking_count)', 'booking_count')}, min(holiday_window) as peak_holiday {_CITY}
order by 2 desc, 1 limit 10""")
check("exec_top_customers", f"""select resolved_customer_id, {hexid()} as rcid_hex, name_std, loyalty_tier,
  {num('clv_idr')}, {arr('emails')}, {arr('phones')}, {num('dormant_days')}, {arr('source_systems')}
from dim d order by d.clv_idr desc, d.resolved_customer_id limit 10""")
_CITY_SUMS = f"""select city, {num('sum(amount_idr_total)', 'total_revenue')},
  {num('sum(booking_count)', 'booking_count')} {_CITY}"""
check("exec_city_revenue", _CITY_SUMS)
check("city_revenue_map", f"""select c.city, province, lat, lng, total_revenue, booking_count,
  {dec('total_revenue / (select max(total_revenue) from city_sums where city in (select city from places))::double', 'relative_revenue')}
from city_sums c join places p on p.city = c.city""", city_sums=_CITY_SUMS,
      places="""select * from (values ('Kuta', -8.7::double, 115.2::double, 'Bali'), ('Ubud', -8.5, 115.3, 'Bali'),
  ('Lombok', -8.6, 116.3, 'Nusa Tenggara Barat'), ('Labuan Bajo', -8.5, 119.9, 'Nusa Tenggara Timur'),
  ('Jakarta', -6.2, 106.8, 'DKI Jakarta'), ('Surabaya', -7.3, 112.8, 'Jawa Timur'),
  ('Yogyakarta', -7.8, 110.4, 'DI Yogyakarta')) as p(city, lat, lng, province)""")

# ---- customer explorer --------------------------------------------------------------------

_SEARCH_ROW = f"""resolved_customer_id, {hexid()} as rcid_hex, name_std, loyalty_tier, {num('clv_idr')},
  {dec('churn_risk_score')}, {num('booking_count')}, {num('completed_count')}, {num('cancelled_count')},
  {num('dormant_days')}, {ts('last_booking_ts')}, recommended_action, {num('has_support_ticket')},
  {num('critical_ticket_count')}, {num('distinct_booking_types')}, {arr('emails')}, {arr('phones')},
  {arr('source_systems')}, identity_confidence"""


def _found(where: str = "true", order: str = "clv_idr", limit: int = 100) -> str:
    return f"""select {_SEARCH_ROW} from explorer e where {where}
order by e.{order} desc nulls last, e.resolved_customer_id limit {limit}"""


def _term(term: str) -> str:
    low = term.lower()
    return (
        f"(name_std ilike '%{term}%' or len(list_filter(emails, lambda x: contains(lower(x), '{low}'))) > 0 "
        f"or len(list_filter(phones, lambda x: contains(lower(x), '{low}'))) > 0 "
        f"or contains(lower({hexid()}), '{low}'))"
    )


check("customer_search", _found())
check("customer_search_term", _found(_term("R1")))
for _key, _words in (("indexed", "wijaya"), ("indexed_pattern", "wi%aya"), ("indexed_digits", "628"), ("indexed_short", "R1")):
    check(f"customer_search_{_key}", _found(_term(_words)))
check("customer_search_tiers", _found("loyalty_tier in ('silver', 'churn_risk')"))
check("customer_search_churn", _found("churn_risk_score >= 0.2 and churn_risk_score <= 0.6"))
check("customer_search_actions", _found("recommended_action in ('reactivate', 'cross_sell')"))
check("customer_search_ticket", _found("has_support_ticket = 1"))
check("customer_search_types", _found("distinct_booking_types >= 1 and distinct_booking_types <= 2"))
check("customer_search_omnichannel", _found("len(source_systems) = 3"))
check("customer_sort_clv", _found())
check("customer_sort_churn", _found(order="churn_risk_score"))
check("customer_sort_dormant", _found(order="dormant_days"))
check("customer_sort_last_booking", _found(order="last_booking_ts"))
check("customer_search_count", """select count(*) as total from explorer
where loyalty_tier = 'gold' and has_support_ticket = 1 and distinct_booking_types >= 2""")
check("template_tier_mix", "select loyalty_tier, count(*) as cnt from dim group by loyalty_tier")
check("template_top_customers", f"""select resolved_customer_id, name_std, {num('clv_idr')} from dim d
order by d.clv_idr desc, d.resolved_customer_id limit 10""")
check("template_customer_search", _found(_term("wijaya"), limit=5))

# ---- one customer -------------------------------------------------------------------------

check("customer_360_profile", f"""select {_DIM_ROW}, {hexid()} as rcid_hex, {num('mart_clv_idr')}, {num('aov_idr')},
  {num('booking_count')}, {num('completed_count')}, {num('cancelled_count')}, {num('no_show_count')},
  {ts('last_booking_ts')}, {dec('churn_risk_score')}, {num('has_support_ticket')}, {num('critical_ticket_count')},
  {dec('avg_resolution_hours')}, {num('distinct_booking_types')}, recommended_action
from (select d.*, m.clv_idr as mart_clv_idr, m.* exclude (resolved_customer_id, clv_idr, dormant_days, loyalty_tier)
  from dim d left join mart m on m.resolved_customer_id = d.resolved_customer_id)""")
check("customer_360_bookings", f"""select resolved_customer_id, booking_id, {_BOOKING_ROW} from fact
where resolved_customer_id is not null""")
_CONTACT_HITS = """select c.resolved_customer_id, t.* from (select resolved_customer_id, unnest(emails) as e from dim) c
    join s_tickets t on t.customer_email = c.e
  union select c.resolved_customer_id, t.* from (select resolved_customer_id, unnest(phones) as p from dim) c
    join s_tickets t on t.customer_phone = c.p"""
check("customer_360_tickets", f"select resolved_customer_id, {_TICKET_ROW} from hits", hits=_CONTACT_HITS)
_PER_TYPE = """select resolved_customer_id, booking_type, count(*) as n from fact
  where resolved_customer_id is not null group by resolved_customer_id, booking_type"""
check("customer_type_gap", """select resolved_customer_id, count(*) as distinct_booking_types,
  first(booking_type order by n desc, booking_type desc) as booking_type_mode from per_type group by resolved_customer_id""",
      per_type=_PER_TYPE)
check("cross_sell_gap", """select resolved_customer_id, min(booking_type) as booked_type,
  array_to_string(list_filter(['hotel', 'flight', 'experience'], lambda x: x <> min(booking_type)), '|') as missing_types
from per_type group by resolved_customer_id having count(*) = 1""", per_type=_PER_TYPE)
check("customer_booking_mix", "select resolved_customer_id, booking_type, n as bookings from per_type", per_type=_PER_TYPE)
check("booking_timeline", f"""select resolved_customer_id, booking_type, status, {ts('booking_ts')}, {num('amount_idr')},
  provider, city, payment_method, booking_id from fact where resolved_customer_id is not null""")
check("customer_recent_bookings", f"""select resolved_customer_id, booking_id, booking_type, provider, city, origin,
  destination, {num('amount_idr')}, status, payment_method, {ts('booking_ts')} from (select * from fact
  where resolved_customer_id is not null qualify row_number() over (
    partition by resolved_customer_id order by booking_ts desc nulls last, booking_id) <= 10)""")
check("customer_recent_tickets", f"""select resolved_customer_id, ticket_id, subject, status, priority, category, channel,
  {ts('created_at')}, {ts('resolved_at')}, agent_name, body from (select * from hits qualify row_number() over (
    partition by resolved_customer_id order by created_at desc nulls last, ticket_id) <= 20)""",
      hits=_CONTACT_HITS)
check("identity_panel", """select resolved_customer_id, i - 1 as position, emails[i] as email, phones[i] as phone,
  source_customer_ids[i] as source_customer_id, source_systems[i] as source_system from (
  select *, unnest(range(1, len(emails) + 1)) as i from dim)""")

# ---- routes -------------------------------------------------------------------------------


# Figures of a route over its months: whole numbers add up, rates are means.
_ADDED = {n: num(f"sum({n})", n) for n in ("booking_count", "unique_travelers", "amount_idr_total")}
_MEANS = {n: dec(f"avg({n})", n) for n in ("cancel_rate", "no_show_rate", "business_class_share")}
_ROUTE_IDS = "route_type, route_key, origin, destination, city"


def _routes_table(kind: str = "%") -> str:
    sums = f"""select {_ROUTE_IDS}, min(holiday_window) as peak_holiday, {', '.join([*_ADDED.values(), *_MEANS.values()])}
from routes where route_type like '{kind}' group by all"""
    return f"""select *, amount_idr_total // greatest(booking_count, 1) as amount_idr_avg from ({sums})
qualify row_number() over (order by amount_idr_total desc nulls last, route_type, route_key) <= 50"""


check("route_table", _routes_table())
check("route_table_flights", _routes_table("flight"))
check("route_monthly_trend", f"""select {day('year_month')}, if(place <= 5, route_key, 'Other') as route_key,
  {_ADDED['amount_idr_total']}, {_ADDED['booking_count']}
from (select *, dense_rank() over (order by whole desc nulls last, route_key) as place
  from (select *, sum(amount_idr_total) over (partition by route_key) as whole from routes)) group by all""")
check("route_holiday_comparison", f"""select holiday_window, {num('sum(amount_idr_total)', 'total_revenue')},
  {num('sum(booking_count)', 'booking_count')} from routes where holiday_window <> '' group by holiday_window""")
check("route_business_class", f"""select route_key, {dec('avg(business_class_share)', 'business_class_share')},
  {num('sum(booking_count)', 'booking_count')} from routes r
where route_type = 'flight' and r.business_class_share is not null group by route_key
order by avg(r.business_class_share) desc, route_key limit 15""")

# ---- streams ------------------------------------------------------------------------------

check("stream_land_tickets", f"select {_TICKET_RAW} from fx_tickets")
check("stream_upsert_silver", f"select {_TICKET_ROW} from s_tickets")
check("stream_replay", f"select {_TICKET_ROW} from s_tickets")
check("stream_dedupe", f"""select distinct email, flight_number, {ts('departure_ts')}, {num('amount_idr')}, 1 as kept_rows
from c_flights""")
check("stream_dedupe_hotels", f"""select distinct customer_id, lower(hotel_name) as hotel_name, {day('check_in_date')},
  {num('amount_idr')}, 1 as kept_rows from c_hotels""")
check("stream_dedupe_experiences", f"""select distinct email, lower(experience_name) as experience_name, {day('activity_date')},
  {num('amount_idr')}, 1 as kept_rows from c_experiences""")

# ---- near-duplicates across runs ----------------------------------------------------------

check("dedupe_across_runs", f"select {_HOTEL_SILVER} from s_hotels")
check("dedupe_across_stream", f"select {_FLIGHT_ROW} from s_flights")
check("dedupe_accounts", """select 'came' as what, count(*) as row_count from came
union all select 'kept', count(*) from s_experiences
union all select 'others', (select count(*) from came) - (select count(*) from s_experiences)""",
      came="select distinct booking_ref, email, lower(trim(experience_name)), activity_date, amount_idr from c_experiences")

# ---- SQL functions ------------------------------------------------------------------------

check("sql_functions_people", f"""select customer_id, {email('email')} as email, {phone('phone')} as phone,
  {name('full_name')} as full_name, {title('city')} as city, {rcid(email('email'))} as resolved_customer_id
from fx_customers""")
check("sql_functions_bookings", f"""select booking_id, cast({hundreds('amount_idr')} as bigint) as amount_idr,
  {payment('payment_method')} as payment_method, {status('booking_status')} as booking_status from fx_hotel_bookings""")

# ---- daily runs ---------------------------------------------------------------------------

check("daily_run_gold", f"select {_MART_ROW} from mart")
check("daily_run_amended", f"""select f.booking_id, f.resolved_customer_id, f.identity_confidence, f.booking_type,
  if(l.booking_id is null, f.status, 'cancelled') as status, {num('f.amount_idr', 'amount_idr')}
from fact f left join (select booking_id from fx_hotel_bookings
  where ingest_date between date '2026-05-01' and date '2026-05-31') l on l.booking_id = f.booking_id""")
