"""Named building blocks of the check SQL, and the helper that puts the needed ones in front of a query."""

from __future__ import annotations

import re

from tripweave.sources import fixtures

AS_OF = "2026-12-31"


# ---- output formats shared by all check queries -----------------------------------------------


def ts(c: str, name: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {name or c}"


def day(c: str, name: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d') as {name or c}"


def arr(c: str, name: str | None = None) -> str:
    return f"array_to_string({c}, '|') as {name or c}"


def num(c: str, name: str | None = None) -> str:
    return f"cast({c} as bigint) as {name or c}"


def dec(c: str, name: str | None = None) -> str:
    return f"round(cast({c} as double), 6) as {name or c}"


# ---- scalar rules -----------------------------------------------------------------------------


def email(c: str) -> str:
    s = f"regexp_replace(lower(trim({c})), '\\+[^@]*@', '@')"
    for wrong, right in (("gnail", "gmail"), ("gmaill", "gmail"), ("yaho", "yahoo")):
        s = f"regexp_replace({s}, '@{wrong}\\.', '@{right}.')"
    return f"case when {c} is null or trim({c}) = '' then null else {s} end"


def phone(c: str, more: str = "") -> str:
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return (
        f"case when {c} is null or {c} in ('TIDAK ADA', 'tidak diketahui', '000-000-0000', '', '0'{more}) then null "
        f"when {d} like '62%' then '+' || {d} when {d} like '0%' then '+62' || substr({d}, 2) "
        f"when length({d}) >= 10 then '+62' || {d} else null end"
    )


def title(c: str) -> str:
    words = f"string_split(lower(trim({c})), ' ')"
    return f"trim(array_to_string(list_transform({words}, lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' '))"


def name(c: str) -> str:
    bare = (
        f"regexp_replace(lower(trim({c})), "
        "'^(bpk\\.|ibu|sdr\\.|h\\.|drs\\.|dr\\.|drg\\.|ir\\.|tgk\\.|dt\\.|r\\.|r\\.a\\.)\\s+', '')"
    )
    bare = f"regexp_replace({bare}, ',\\s*(s\\.(kom|ip|farm|ked|sos|psi|h|e)\\.|m\\.(kom|m|t)\\.)\\s*$', '')"
    return f"case when {c} is null or trim({c}) = '' then null else {title(bare)} end"


def hundreds(c: str) -> str:
    return f"case when {c} = 0 then null else cast(round_even(cast({c} as double) / 100, 0) * 100 as bigint) end"


def payment(c: str) -> str:
    cases = " ".join(
        f"when 'bank transfer {b.lower()}' then 'Bank Transfer ({b})'" for b in ("BCA", "Mandiri", "BRI", "BNI")
    )
    return f"case lower(trim({c})) {cases} else {title(c)} end"


def status(c: str) -> str:
    return (
        f"case lower(trim({c})) when 'batal' then 'cancelled' when 'selesai' then 'completed' "
        f"when 'tidak_hadir' then 'no_show' else lower(trim({c})) end"
    )


def at7(c: str) -> str:
    return f"(strptime(substr({c}, 1, 19), '%Y-%m-%dT%H:%M:%S') - interval 7 hour)"


def rcid(c: str) -> str:
    return f"('rc_' || substr(md5(lower(trim({c}))), 1, 24))"


def hexid(c: str = "resolved_customer_id") -> str:
    return f"upper('72635F' || substr({c}, 4))"


def hours(a: str, b: str) -> str:
    return f"date_diff('hour', {a}, {b})"


TIER = (
    "case when dormant_days > 90 then 'churn_risk' when clv_idr >= 10000000 then 'gold' "
    "when clv_idr >= 2000000 then 'silver' else 'churn_risk' end"
)
HOLIDAY = (
    "case when strftime(year_month, '%Y-%m') in ('2026-03', '2026-04') then 'lebaran' "
    "when strftime(year_month, '%Y-%m') in ('2025-12', '2026-12') then 'natal' "
    "when strftime(year_month, '%Y-%m') = '2026-02' then 'imlek' "
    "when strftime(year_month, '%Y-%m') in ('2026-06', '2026-07') then 'school' else 'none' end"
)
SCORE = """greatest(0.0::double, least(1.0::double,
  0.40 * case when clv_idr < 2000000 then 1.0 when clv_idr >= 10000000 then 0.0
              else 1.0 - (clv_idr - 2000000) / 8000000.0::double end
  + 0.40 * least(dormant_days / 180.0::double, 1.0)
  + 0.15 * (cancelled_count + no_show_count) / greatest(booking_count, 1)::double
  + 0.05 * least(critical_ticket_count / 3.0::double, 1.0)))"""

_PLAIN = {t: t for t in ("customer", "nation", "region", "orders", "events")}

CTES: dict[str, str] = {
    f"fx_{key}": sql.format(**_PLAIN).strip() for key, sql in fixtures.SQL.items()
}


def first_by(source: str, keys: str, order: str, columns: str = "*") -> str:
    return (
        f"select {columns} from {source} qualify row_number() over (partition by {keys} order by {order}) = 1"
    )


def customers_from(source: str) -> str:
    return f"""select customer_id, {email('email')} as email, {phone('phone')} as phone,
  {name('full_name')} as full_name, trim(address) as address, {title('city')} as city, {title('province')} as province,
  substr(trim(postal_code), 1, 5) as postal_code, coalesce(nullif(lower(trim(loyalty_tier)), ''), 'basic') as loyalty_tier,
  nullif(trim(preferred_airline), '') as preferred_airline, created_at, updated_at from {source}"""


def hotels_from(source: str) -> str:
    return f"""select booking_id, customer_id, {title('hotel_name')} as hotel_name, {title('hotel_city')} as hotel_city,
  check_in_date, check_out_date, {title('room_type')} as room_type, coalesce(guests, 1) as guests,
  {hundreds('amount_idr')} as amount_idr, {payment('payment_method')} as payment_method,
  {status('booking_status')} as booking_status, booking_ts from {source}"""


def _strongest(c: str, as_name: str) -> str:
    """The value of the record with the strongest link, then the latest, then the last key; vendor rows only repeat."""
    return (
        f"max({{'s': strength, 'at': last_at, 'k': source_key, 'v': {c}}}) "
        f"filter ({c} is not null and system <> 'vendor_api') as {as_name}"
    )


def _zeros(names: str, of: str) -> str:
    return ", ".join(f"coalesce({of}.{n}, 0) as {n}" for n in names.split())


CTES.update(
    {
        "c_customers": customers_from("fx_customers"),
        "s_customers": first_by("c_customers", "customer_id", "coalesce(updated_at, created_at) desc nulls last"),
        "c_hotels": hotels_from("fx_hotel_bookings"),
        "s_hotels": first_by("c_hotels", "customer_id, lower(trim(hotel_name)), check_in_date, amount_idr", "booking_id"),
        "c_flights": f"""select booking_ref, {email('email')} as email, {title('airline')} as airline,
  upper(trim(flight_number)) as flight_number, upper(trim(origin)) as origin, upper(trim(destination)) as destination,
  {at7('departure_ts')} as departure_ts, {at7('arrival_ts')} as arrival_ts, {name('passenger_name')} as passenger_name,
  lower(trim(seat_class)) as seat_class, {hundreds('amount_idr')} as amount_idr,
  {payment('payment_method')} as payment_method, {status('booking_status')} as booking_status,
  {at7('booking_ts')} as booking_ts from fx_flights""",
        "s_flights": first_by("c_flights", "email, flight_number, departure_ts, amount_idr", "booking_ref"),
        "c_experiences": f"""select booking_ref, {email('email')} as email, {title('experience_name')} as experience_name,
  {title('city')} as city, lower(trim(category)) as category, cast(activity_date as date) as activity_date,
  coalesce(nullif(participants, 0), 1) as participants, {hundreds('amount_idr')} as amount_idr,
  {payment('payment_method')} as payment_method, {status('booking_status')} as booking_status,
  {at7('booking_ts')} as booking_ts from fx_experiences""",
        "s_experiences": first_by(
            "c_experiences", "email, lower(trim(experience_name)), activity_date, amount_idr", "booking_ref"
        ),
        "c_tickets": f"""select ticket_id, {email('customer_email')} as customer_email,
  {phone('customer_phone')} as customer_phone, {name('customer_name')} as customer_name, trim(subject) as subject,
  trim(regexp_replace(body, '[ÂâÃãÄäÅå]', '', 'g')) as body, lower(trim(status)) as status,
  lower(trim(priority)) as priority, lower(trim(channel)) as channel, {at7('created_at')} as created_at,
  {at7('resolved_at')} as resolved_at, lower(trim(category)) as category, {title('agent_name')} as agent_name
  from fx_tickets""",
        "s_tickets": first_by("c_tickets", "ticket_id", "created_at desc nulls last"),
        # ---- who is who: one relation of source records, each with its customer ---------------
        "people": f"select {rcid('email')} as owner, * from s_customers where email <> ''",
        "phone_book": "select distinct phone, owner from people where phone <> ''",
        "vendor_feed": """select email, booking_ts, booking_status, amount_idr from s_flights where email <> ''
  union all select email, booking_ts, booking_status, amount_idr from s_experiences where email <> ''""",
        "records": f"""select owner, 'app:' || customer_id as source_key, 'app_oltp' as system, 3 as strength,
    created_at as first_at, coalesce(updated_at, created_at) as last_at, email, phone, full_name as person, city, province,
    postal_code, null as ticket_id from people
  union all
  select {rcid('v.email')}, 'vendor:' || v.email, 'vendor_api', if(p.owner is null, 1, 3), v.first_at, v.last_at, v.email,
    '', p.full_name, p.city, p.province, p.postal_code, null
  from (select email, min(booking_ts) as first_at, max(booking_ts) as last_at from vendor_feed group by all) v
  left join people p on p.email = v.email
  union all
  select case when e.email is null and o.owner is not null then o.owner else {rcid('t.customer_email')} end,
    'crm:' || t.ticket_id, 'crm', case when e.email is not null then 3 when o.owner is not null then 2 else 1 end,
    t.created_at, t.created_at, t.customer_email, t.customer_phone, t.customer_name, null, null, null, t.ticket_id
  from s_tickets t
  left join (select distinct email from people) e on e.email = t.customer_email
  left join phone_book o on e.email is null and o.phone = t.customer_phone""",
        # ---- bookings with their customer, taken from the booking's own app id or email ----------
        "unified": """select booking_id, 'app:' || customer_id as source_customer_id, 'app_oltp' as source,
    'hotel' as booking_type, hotel_name as provider, hotel_city as city, booking_status as status,
    * exclude (booking_id, customer_id, hotel_name, hotel_city, room_type, booking_status) from s_hotels
  union all by name select booking_ref as booking_id, 'vendor:' || email as source_customer_id, 'vendor_api' as source,
    'flight' as booking_type, airline as provider, destination as city, booking_status as status,
    * exclude (booking_ref, email, airline, flight_number, passenger_name, booking_status) from s_flights
  union all by name select booking_ref as booking_id, 'vendor:' || email as source_customer_id, 'vendor_api' as source,
    'experience' as booking_type, experience_name as provider, booking_status as status,
    * exclude (booking_ref, email, experience_name, booking_status) from s_experiences""",
        "fact": f"""select u.* exclude (source_customer_id), u.resolved as resolved_customer_id,
    case when u.resolved in (select owner from people) then 'high' when u.resolved is not null then 'email' end
      as identity_confidence
  from (select b.*, if(b.source = 'app_oltp', p.owner, {rcid('substr(b.source_customer_id, 8)')}) as resolved
    from unified b left join people p on b.source_customer_id = 'app:' || p.customer_id) u""",
        "spent": """select resolved_customer_id as owner, sum(amount_idr) as idr from fact
  where status = 'completed' group by all""",
        # ---- one row per customer, every column an aggregate of its records -------------------
        "dim": f"""select owner as resolved_customer_id, emails, phones, who.v as name_std, where_city.v as address_city,
    where_province.v as address_province, where_code.v as address_postal_code, source_customer_ids, source_systems,
    first_seen, last_seen, dormant_days, ['email', 'phone_bridge', 'high'][strongest] as identity_confidence, clv_idr,
    {TIER} as loyalty_tier
  from (select owner,
      list_sort(list_filter(list(distinct email), lambda x: x <> '')) as emails,
      list_sort(list_filter(list(distinct phone), lambda x: x <> '')) as phones,
      list_sort(list(distinct source_key)) as source_customer_ids, list_sort(list(distinct system)) as source_systems,
      {_strongest('person', 'who')}, {_strongest('city', 'where_city')}, {_strongest('province', 'where_province')},
      {_strongest('postal_code', 'where_code')},
      min(first_at) as first_seen, max(last_at) as last_seen, max(strength) as strongest,
      greatest(date_diff('day', cast(max(last_at) as date), date '{AS_OF}'), 0) as dormant_days,
      coalesce(any_value(idr), 0) as clv_idr
    from records left join spent using (owner) where owner is not null group by owner)""",
        # ---- value mart: bookings and tickets of a customer are events of one list -----------------
        "events_of": f"""select resolved_customer_id as owner, booking_type as kind, status as outcome, amount_idr, booking_ts as moment,
    null as hours from fact
  union all
  select r.owner, 'ticket', t.priority, null, null, {hours('t.created_at', 't.resolved_at')}
  from records r join s_tickets t on r.ticket_id = t.ticket_id""",
        "figures": """select owner as resolved_customer_id,
    coalesce(sum(amount_idr) filter (outcome = 'completed'), 0) as clv_idr,
    count(*) filter (kind <> 'ticket' and outcome = 'completed') as completed_count,
    count(*) filter (kind <> 'ticket' and outcome = 'cancelled') as cancelled_count,
    count(*) filter (kind <> 'ticket' and outcome = 'no_show') as no_show_count,
    count(*) filter (kind <> 'ticket') as booking_count, max(moment) as last_booking_ts,
    count(distinct kind) filter (kind <> 'ticket') as distinct_booking_types,
    max({'moment': moment, 'kind': kind}) filter (moment is not null) as newest,
    count(*) filter (kind = 'ticket' and outcome = 'critical') as critical_ticket_count,
    avg(hours) as avg_resolution_hours, cast(bool_or(kind = 'ticket') as int) as has_support_ticket
  from events_of group by owner""",
        "mart": f"""select * exclude (newest, most_recent),
    case when churn_risk_score >= 0.7 then 'reactivate'
         when distinct_booking_types = 1 and most_recent = 'flight' then 'cross_sell'
         when loyalty_tier = 'gold' and churn_risk_score < 0.3 then 'retain' else 'reengage' end as recommended_action
  from (select *, if(completed_count > 0, clv_idr // completed_count, 0) as aov_idr, {SCORE} as churn_risk_score,
      newest.kind as most_recent
    from (select d.resolved_customer_id, d.dormant_days, d.loyalty_tier, last_booking_ts, avg_resolution_hours, newest,
        {_zeros('clv_idr completed_count cancelled_count no_show_count booking_count distinct_booking_types '
                'critical_ticket_count has_support_ticket', 'f')}
      from dim d left join figures f on f.resolved_customer_id = d.resolved_customer_id))""",
        # ---- routes by month ---------------------------------------------------------------------
        "routes": f"""select route_type || '|' || route_key || '|' || strftime(year_month, '%Y-%m-%d') as _pk, *, {HOLIDAY} as holiday_window
  from (select booking_type as route_type, if(booking_type = 'flight', origin || '-' || destination, city) as route_key,
      if(booking_type = 'flight', origin, null) as origin, if(booking_type = 'flight', destination, null) as destination,
      if(booking_type = 'flight', null, city) as city, cast(date_trunc('month', booking_ts) as date) as year_month,
      count(*) as booking_count, count(distinct resolved_customer_id) as unique_travelers,
      sum(amount_idr) as amount_idr_total, sum(amount_idr) // greatest(count(*), 1) as amount_idr_avg,
      avg(case when booking_type = 'flight' then coalesce(seat_class in ('business', 'first'), false)::int end) as business_class_share,
      avg((status = 'cancelled')::int) as cancel_rate, avg((status = 'no_show')::int) as no_show_rate
    from fact group by all)""",
        "explorer": """select m.*, d.name_std, d.emails, d.phones, d.source_systems, d.identity_confidence
  from mart m join dim d on d.resolved_customer_id = m.resolved_customer_id""",
    }
)

_ORDER = list(CTES)
_WORD = re.compile(r"\b(" + "|".join(sorted(_ORDER, key=len, reverse=True)) + r")\b")


def _needs(sql: str, own: str | None = None) -> set[str]:
    """Building blocks the text names after FROM or JOIN, with everything they need."""
    found = set()
    for match in _WORD.finditer(sql):
        before = sql[: match.start()].rstrip().lower()
        word = match.group(1)
        if word != own and (before.endswith("from") or before.endswith("join") or before.endswith(" in (table")):
            found.add(word)
    for word in list(found):
        found |= _needs(CTES[word], word)
    return found


def query(sql: str, **extra: str) -> str:
    """A complete statement: the needed building blocks, then ``extra`` ones, then the query."""
    needed = _needs(sql)
    for body in extra.values():
        needed |= _needs(body)
    parts = [f"{n} as (\n{CTES[n]}\n)" for n in _ORDER if n in needed]
    parts += [f"{n} as (\n{body}\n)" for n, body in extra.items()]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + sql.strip()
