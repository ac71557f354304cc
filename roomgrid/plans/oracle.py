"""An independent SQL answer for each job, for DuckDB.

Each query is written over the derived tables; ``with_fragments`` puts their definitions in
front. Where the oracle joins on a plain condition that grows with the square of a room's
rows, the library does not: that is the point of the comparison.
"""

from __future__ import annotations

from roomgrid.plans.catalog import AS_OF, PARAMETERS, SEMESTER, WINDOW
from roomgrid.plans.rules import domain_conditions
from roomgrid.schema import ALTERNATE_KEYS, FOREIGN_KEYS, NATURAL_KEYS, PRIMARY_KEYS, SCHEMAS, TABLES
from roomgrid.sources.fixtures import with_fragments

_FAR = "timestamp '9999-12-31 23:59:59'"
_AS_OF = f"timestamp '{AS_OF}'"
_FROM, _TO = (f"timestamp '{s}'" for s in SEMESTER)
_ACTIVE = "('Approved', 'CheckedIn')"
_HELD = "('Approved', 'CheckedIn', 'Completed')"
_USABLE = "('Approved', 'CheckedIn', 'Completed', 'NoShow')"
_REPAIR = "('Reported', 'Assigned', 'InProgress')"


def _cents(numerator: str, denominator: str) -> str:
    """Whole hundredths of a quotient, half up, as BIGINT."""
    return f"cast((({numerator}) * 200 + ({denominator})) // (({denominator}) * 2) as bigint)"


def _dec(numerator: str, denominator: str, precision: int) -> str:
    """A quotient with two digits: the hundredths are put together as text, so nothing is rounded twice."""
    c = _cents(numerator, denominator)
    return f"cast(concat(({c}) // 100, '.', lpad(cast(({c}) % 100 as varchar), 2, '0')) as decimal({precision}, 2))"


def _sum_dec(cents: str, precision: int) -> str:
    return f"cast(concat(({cents}) // 100, '.', lpad(cast(({cents}) % 100 as varchar), 2, '0')) as decimal({precision}, 2))"


def _minutes(a: str, b: str) -> str:
    return f"date_diff('minute', {a}, {b})"


_POLICY = """
  select {request}.booking_id as for_booking, p.*,
    row_number() over (partition by {request}.booking_id order by p.space_id is null, p.applicable_role is null,
      p.applicable_purpose is null, p.policy_id desc) as choice
  from {request} join app_user u on u.user_id = {request}.requester_user_id join booking_policy p
    on coalesce(p.space_id, {request}.space_id) = {request}.space_id
    and coalesce(p.applicable_role, u.role) = u.role
    and coalesce(p.applicable_purpose, {request}.purpose) = {request}.purpose
"""

QUERIES: dict[str, str] = {
    "r01_upcoming_bookings": f"""
select space_code, space_name, requested_start_time, requested_end_time, purpose, expected_participants, booking_status,
  full_name as requester_name, email as requester_email
from booking join space using (space_id) join app_user on user_id = requester_user_id
where booking_status in {_ACTIVE} and requested_end_time >= {_AS_OF} and requested_start_time < {_AS_OF} + interval 7 day
""",
    "r02_availability_search": f"""
select q.request_id, space_code, space_name, space_type, capacity, building, floor, room_number
from room_request q join space s on s.capacity >= q.participants and s.current_status in ('Available', 'InUse')
where (q.request_id, s.space_id) not in (
    select r.request_id, b.space_id from room_request r join booking b on b.booking_status in {_ACTIVE}
      and r.span_start < b.requested_end_time and r.span_end > b.requested_start_time)
  and (q.request_id, s.space_id) not in (
    select r.request_id, m.space_id from room_request r join maintenance m on m.maintenance_status in {_REPAIR}
      and r.span_start < coalesce(m.completion_time, {_FAR}) and r.span_end > m.start_time)
""",
    "r03_space_utilization": f"""
with h as (
  select space_id, booking_status, {_cents(_minutes('requested_start_time', 'requested_end_time'), '60')} as cents
  from booking where booking_status in ('Completed', 'NoShow')
    and requested_start_time >= {_AS_OF} - interval 90 day and requested_start_time < {_AS_OF}
), s as (
  select space_code, space_name,
    cast(coalesce(sum(cents) filter (booking_status = 'Completed'), 0) as bigint) as done,
    cast(coalesce(sum(cents) filter (booking_status = 'NoShow'), 0) as bigint) as missed
  from space left join h using (space_id) group by all
)
select space_code, space_name, {_sum_dec('done', 38)} as completed_hours, {_sum_dec('missed', 38)} as no_show_hours,
  {_dec('done + missed', '1080', 5)} as scheduled_utilization_pct
from s
""",
    "r04_peak_start_hours": f"""
with c as (
  select dayname(requested_start_time) as weekday_name, cast(hour(requested_start_time) as bigint) as start_hour,
    count(*) as booking_count
  from booking where booking_status in {_HELD} group by all
)
select *, cast(rank() over (order by booking_count desc) as bigint) as overall_peak_rank from c
""",
    "r05_capacity_demand": f"""
with d as (
  select space_code, space_name, capacity, count(booking_id) as active_or_completed_bookings,
    cast(coalesce(sum(expected_participants), 0) as bigint) as booked_participants
  from space left join booking on booking.space_id = space.space_id and booking_status in {_HELD}
  group by space.space_id, space_code, space_name, capacity
)
select *,
  case when active_or_completed_bookings > 0 then
    {_dec('booked_participants * 100', '(capacity * active_or_completed_bookings)', 5)} end as average_capacity_fill_pct,
  cast(rank() over (order by case when active_or_completed_bookings > 0
    then booked_participants / (capacity * active_or_completed_bookings) end desc nulls last) as bigint) as demand_rank
from d
""",
    "r06_session_variance": f"""
select booking_id, space_code, full_name as requester_name, requested_start_time, requested_end_time,
  actual_start_time, actual_end_time,
  {_minutes('requested_start_time', 'requested_end_time')} as planned_minutes,
  {_minutes('actual_start_time', 'actual_end_time')} as actual_minutes,
  {_minutes('requested_end_time', 'actual_end_time')} as checkout_variance_minutes
from usage_session join booking using (booking_id) join space using (space_id) join app_user on user_id = requester_user_id
where actual_end_time is not null
""",
    "r07_overlapping_bookings": f"""
with a as (select * from booking where booking_status in {_ACTIVE})
select space_code, x.booking_id as first_booking_id, y.booking_id as second_booking_id,
  x.requested_start_time as first_start, x.requested_end_time as first_end,
  y.requested_start_time as second_start, y.requested_end_time as second_end
from a x join a y on x.space_id = y.space_id and x.booking_id < y.booking_id
  and greatest(x.requested_start_time, y.requested_start_time) < least(x.requested_end_time, y.requested_end_time)
join space on space.space_id = x.space_id
""",
    "r08_booking_maintenance_conflicts": f"""
select space_code, booking_id, requested_start_time, requested_end_time, maintenance_id, problem_description,
  start_time as maintenance_start, completion_time as maintenance_end
from booking join maintenance using (space_id) join space using (space_id)
where booking_status in {_ACTIVE} and maintenance_status in {_REPAIR}
  and requested_end_time > start_time and (completion_time is null or requested_start_time < completion_time)
""",
    "r09_unavailable_spaces": f"""
select space_code, space_name, current_status, maintenance_id, maintenance_status, start_time, problem_description,
  coalesce(full_name, 'Unassigned') as assigned_staff, date_diff('hour', start_time, {_AS_OF}) as open_hours
from space left join (select * from maintenance where maintenance_status in {_REPAIR}) m using (space_id)
left join app_user on user_id = assigned_staff_user_id
where maintenance_id is not null or current_status not in ('Available', 'InUse')
""",
    "r10_booking_gaps": f"""
with o as (
  select space_id, booking_id, requested_start_time, lag(requested_end_time) over (
    partition by space_id order by requested_start_time, booking_id) as previous_end_time
  from booking where booking_status in {_USABLE}
)
select space_code, booking_id, previous_end_time, requested_start_time,
  {_minutes('previous_end_time', 'requested_start_time')} as gap_minutes
from o join space using (space_id) where previous_end_time is not null
""",
    "r11_role_outcomes": """
select role, count(*) as total_bookings, count(*) filter (booking_status = 'Approved') as approved_bookings,
  count(*) filter (booking_status = 'Rejected') as rejected_bookings,
  count(*) filter (booking_status = 'Cancelled') as cancelled_bookings,
  count(*) filter (booking_status = 'NoShow') as no_show_bookings
from booking join app_user on user_id = requester_user_id group by role
""",
    "r12_requester_reliability": f"""
with m as (
  select full_name, email, count(*) as total_bookings, count(*) filter (booking_status = 'Cancelled') as cancelled_bookings,
    count(*) filter (booking_status = 'NoShow') as no_show_bookings
  from booking join app_user on user_id = requester_user_id group by user_id, full_name, email
)
select *, {_dec('(cancelled_bookings + no_show_bookings) * 100', 'total_bookings', 5)} as non_use_rate_pct,
  cast(rank() over (order by (cancelled_bookings + no_show_bookings) / total_bookings desc) as bigint) as non_use_risk_rank
from m
""",
    "r13_decision_turnaround": f"""
with f as (
  select * from booking_decision
  qualify row_number() over (partition by booking_id order by decision_time, decision_id) = 1
), g as (
  select decision, full_name as decision_maker, count(*) as decisions,
    cast(sum({_minutes('submitted_at', 'decision_time')}) as bigint) as minutes,
    max(date_diff('hour', submitted_at, decision_time)) as longest_turnaround_hours
  from f join booking using (booking_id) join app_user on user_id = decision_maker_user_id group by all
)
select decision, decision_maker, decisions, {_dec('minutes', '(decisions * 60)', 10)} as average_turnaround_hours,
  longest_turnaround_hours
from g
""",
    "r14_monthly_workload": """
with w as (
  select full_name, cast(date_trunc('month', decision_time) as date) as decision_month, count(*) as decision_count
  from booking_decision join app_user on user_id = decision_maker_user_id group by all
)
select *, cast(rank() over (partition by decision_month order by decision_count desc) as bigint) as monthly_workload_rank from w
""",
    "r15_maintenance_turnaround": f"""
select space_code, maintenance_id, maintenance_status, problem_description, start_time, completion_time,
  date_diff('hour', start_time, coalesce(completion_time, {_AS_OF})) as elapsed_hours,
  if(completion_time is null, 'Open', 'Completed') as turnaround_state
from maintenance join space using (space_id)
""",
    "r16_facility_demand": f"""
with n as (select space_id, count(*) as n from booking where booking_status in {_HELD} group by space_id)
select space_code, facility_name, facility_type, quantity, coalesce(n, 0) as supported_booking_count,
  cast(rank() over (partition by facility_type order by coalesce(n, 0) desc, space_code) as bigint) as facility_demand_rank
from space_facility join space using (space_id) join facility using (facility_id) left join n using (space_id)
""",
    "r17_open_sessions": f"""
select space_code, booking_id, who.full_name as requester_name, actual_start_time,
  {_minutes('actual_start_time', _AS_OF)} as open_session_minutes, staff.full_name as checked_in_by,
  initial_condition, usage_notes
from usage_session join booking using (booking_id) join space using (space_id)
join app_user who on who.user_id = requester_user_id join app_user staff on staff.user_id = check_in_by_user_id
where actual_end_time is null
""",
    "r18_capacity_fit": f"""
select booking_id, space_code, purpose, booking_status, expected_participants, capacity,
  capacity - expected_participants as spare_seats,
  {_dec('expected_participants * 100', 'capacity', 5)} as capacity_fill_pct,
  case when expected_participants * 10 >= capacity * 9 then 'Near capacity'
    when expected_participants * 10 <= capacity * 3 then 'Potentially oversized' else 'Appropriate fit' end as fit_assessment
from booking join space using (space_id) where booking_status in ('Pending', 'Approved', 'CheckedIn')
""",
    "r19_effective_policy": f"""
with pending as (select * from booking where booking_status = 'Pending'),
best as (select * from ({_POLICY.format(request='pending')}) where choice = 1)
select booking_id, full_name as requester_name, role as requester_role, space_code, purpose, requested_start_time,
  policy_id, minimum_lead_minutes, cancellation_lead_minutes, pre_buffer_minutes, post_buffer_minutes,
  requested_start_time - pre_buffer_minutes * interval '1' minute as effective_start_time,
  requested_end_time + post_buffer_minutes * interval '1' minute as effective_end_time
from pending join app_user on user_id = requester_user_id join space s on s.space_id = pending.space_id
left join best on for_booking = booking_id
""",
    "r20_audit_timeline": f"""
with e as (
  select booking_id, submitted_at as event_time, 'Submitted' as event_type, requester_user_id as actor,
    'Purpose: ' || purpose || '; expected participants: ' || expected_participants as event_detail from booking
  union all select booking_id, decision_time, decision, decision_maker_user_id,
    coalesce(rejection_reason, decision_note) from booking_decision
  union all select booking_id, cancelled_at, 'Cancelled', cancelled_by_user_id, cancellation_note
    from booking where cancelled_at is not null
  union all select booking_id, actual_start_time, 'CheckedIn', check_in_by_user_id, initial_condition from usage_session
  union all select booking_id, actual_end_time, 'CheckedOut', check_out_by_user_id, coalesce(final_condition, usage_notes)
    from usage_session where actual_end_time is not null
)
select booking_id, event_time, event_type, full_name as actor_name, event_detail,
  date_diff('minute', lag(event_time) over (partition by booking_id
    order by event_time, event_type, full_name, event_detail nulls first), event_time) as minutes_since_previous_event
from e join app_user on user_id = actor
""",
    "a01_semester_hours": f"""
with h as (
  select space_id, cast(sum({_minutes('requested_start_time', 'requested_end_time')}) as bigint) as m, count(*) as n
  from booking where booking_status in {_USABLE} and requested_start_time >= {_FROM} and requested_start_time < {_TO}
  group by space_id
)
select space_code, space_name, space_type, {_dec('coalesce(m, 0)', '60', 12)} as approved_booking_hours,
  coalesce(n, 0) as approved_booking_count
from space left join h using (space_id)
""",
    "a02_usage_distribution": f"""
select cast(isodow(requested_start_time) as bigint) as weekday_number_monday_first,
  dayname(requested_start_time) as weekday_name, cast(hour(requested_start_time) as bigint) as start_hour,
  count(*) as approved_booking_count
from booking where booking_status in {_USABLE} and requested_start_time >= {_FROM} and requested_start_time < {_TO}
group by all
""",
    "a03_room_finder": f"""
with notice as (
  select q.request_id, m.space_id, count(*) as n, string_agg(problem_description, '; ' order by maintenance_id) as texts
  from room_request q join maintenance m on q.span_start < coalesce(m.completion_time, {_FAR}) and q.span_end > m.start_time
  where m.maintenance_status in {_REPAIR} and m.impact_level = 'advisory' group by all
)
select q.request_id, s.space_id, space_code, space_name, space_type, capacity, building, floor, room_number,
  coalesce(n, 0) as active_advisory_count, texts as active_advisories
from room_request q join space s on s.capacity >= q.participants and s.current_status in ('Available', 'InUse')
left join notice on notice.request_id = q.request_id and notice.space_id = s.space_id
where (q.request_id, s.space_id) not in (
    select r.request_id, b.space_id from room_request r join booking b on b.booking_status in {_ACTIVE}
      and r.span_start < b.requested_end_time and r.span_end > b.requested_start_time)
  and (q.request_id, s.space_id) not in (
    select r.request_id, m.space_id from room_request r join maintenance m on m.maintenance_status in {_REPAIR}
      and m.impact_level = 'out-of-service'
      and r.span_start < coalesce(m.completion_time, {_FAR}) and r.span_end > m.start_time)
  and not exists (
    select 1 from room_wish w where w.request_id = q.request_id and not exists (
      select 1 from space_facility sf join facility f using (facility_id)
      where sf.space_id = s.space_id and f.facility_name = w.facility_name and f.facility_type = w.facility_type))
""",
    "a04_maintenance_impact": """
select maintenance_id, space_code, space_name, problem_description, m.start_time as maintenance_start_time,
  m.completion_time as maintenance_end_time, i.identified_at as escalation_identified_at,
  finder.full_name as escalation_recorded_by, booking_id, booking_status as current_booking_status,
  requested_start_time, requested_end_time, who.full_name as requester_name, who.email as requester_email,
  who.phone_number as requester_phone, contact_status, contacted_at, resolution, resolved_at,
  solver.full_name as resolved_by, resolution_note
from booking_impact i join maintenance m using (maintenance_id) join space s on s.space_id = m.space_id
join booking b using (booking_id) join app_user who on who.user_id = b.requester_user_id
join app_user finder on finder.user_id = i.identified_by_user_id
left join app_user solver on solver.user_id = i.resolved_by_user_id
""",
}


# ---- rule checks


def _rule(name: str, code: int | None, key: str, detail: str) -> str:
    number = "null" if code is None else str(code)
    return f"'{name}' as rule, cast({number} as integer) as code, cast({key} as varchar) as key, cast({detail} as varchar) as detail"


_MEETS = f"b.requested_start_time < coalesce(m.completion_time, {_FAR}) and b.requested_end_time > m.start_time"


def _block(levels: str) -> str:
    return f"""
select {_rule('maintenance_block', 51003, 'booking_id', 'space_id')}
from booking b where booking_status in {_ACTIVE} and exists (
  select 1 from maintenance m where m.space_id = b.space_id and m.maintenance_status in {_REPAIR}
    and m.impact_level in {levels} and {_MEETS})
"""


def _ack_check(acks: str) -> str:
    return f"""
select * from (
  select {_rule('bad_ack', 51010, "concat(a.booking_id, ':', a.maintenance_id)", f'''case
    when b.space_id <> m.space_id then 'other space'
    when m.maintenance_status in ('Completed', 'Cancelled') then 'not active'
    when m.impact_level = 'out-of-service' then 'not an advisory'
    when not ({_MEETS}) then 'no overlap' end''')}
  from {acks} a join booking b on b.booking_id = a.booking_id join maintenance m on m.maintenance_id = a.maintenance_id
) where detail is not null
"""


def _session_check(sessions: str) -> str:
    return f"""
select * from (
  select {_rule('session_authority', 51004, 'usage_session_id', '''case
    when booking_status in ('Pending', 'Rejected', 'Cancelled', 'NoShow') then 'booking not approved'
    when opener.role not in ('FacilityStaff', 'FacilityManager') then 'check-in without authority'
    when closer.role not in ('FacilityStaff', 'FacilityManager') then 'check-out without authority' end''')}
  from {sessions} s join booking using (booking_id) join app_user opener on opener.user_id = check_in_by_user_id
  left join app_user closer on closer.user_id = check_out_by_user_id
) where detail is not null
"""


def _decision_check(decisions: str) -> str:
    return f"""
select {_rule('decision_authority', 51005, 'decision_id', "concat(role, ' ', account_status)")}
from {decisions} join app_user on user_id = decision_maker_user_id
where not (role in ('FacilityStaff', 'FacilityManager') and account_status = 'Active')
"""


def _key(table: str, columns: list[str]) -> str:
    return "concat_ws(':', " + ", ".join(f"coalesce(cast({c} as varchar), 'NULL')" for c in columns) + ")"


def _domain_check(tables: dict[str, str]) -> str:
    parts = []
    for table, source in tables.items():
        for name, condition in domain_conditions(table).items():
            parts.append(
                f"select {_rule(name, None, _key(table, PRIMARY_KEYS[table]), repr(table))} from {source} where not ({condition})"
            )
    return "\nunion all ".join(parts)


def _repeat(rule: str, source: str, columns: list[str]) -> str:
    return (
        f"select {_rule(rule, None, _key('', columns), 'count(*)')} from {source} group by {', '.join(columns)} having count(*) > 1"
    )


def _unique_check(tables: dict[str, str]) -> str:
    parts = []
    for table, source in tables.items():
        parts.append(_repeat(f"{table} primary key", source, PRIMARY_KEYS[table]))
        if table in ALTERNATE_KEYS:
            parts.append(_repeat(f"{table} alternate key", source, ALTERNATE_KEYS[table]))
        if table == "app_user":
            parts.append(_repeat("app_user email ignoring case", f"(select lower(email) as email from {source})", ["email"]))
    return "\nunion all ".join(parts)


def _orphan_check(sources: dict[str, str]) -> str:
    parts = []
    for table, column, parent, parent_key in FOREIGN_KEYS:
        if table in sources:
            parts.append(
                f"select {_rule(f'{table}.{column}', None, _key(table, PRIMARY_KEYS[table]), column)} from {sources[table]} c "
                f"where {column} is not null and not exists (select 1 from {parent} p where p.{parent_key} = c.{column})"
            )
    return "\nunion all ".join(parts)


# the oracle's booking has no advisory times
_FULL_BOOKING = (
    "(select *, cast(null as timestamp) as advisories_presented_at, cast(null as timestamp) as advisory_acknowledged_at from booking)"
)
_ALL = {table: _FULL_BOOKING if table == "booking" else table for table in TABLES}

QUERIES.update(
    {
        "v01_requester_active": f"""
select {_rule('requester_active', 51000, 'booking_id', "concat(requester_user_id, ' ', account_status)")}
from booking join app_user on user_id = requester_user_id where account_status <> 'Active'
""",
        "v02_space_usable": f"""
select {_rule('space_usable', 51001, 'booking_id', "concat(current_status, ' ', expected_participants, ' ', capacity)")}
from booking join space using (space_id) where expected_participants > capacity
  or (booking_status in ('Pending', 'Approved', 'CheckedIn') and current_status not in ('Available', 'InUse'))
""",
        "v03_booking_overlap": f"""
select {_rule('booking_overlap', 51002, 'booking_id', 'space_id')}
from booking a where booking_status in {_ACTIVE} and exists (
  select 1 from booking b where b.space_id = a.space_id and b.booking_id <> a.booking_id and b.booking_status in {_ACTIVE}
    and b.requested_start_time < a.requested_end_time and b.requested_end_time > a.requested_start_time)
""",
        "v04_maintenance_block": _block("('out-of-service')"),
        "v04_maintenance_block_phase1": _block("('out-of-service', 'advisory')"),
        "v05_missing_ack": f"""
select {_rule('missing_ack', 51011, "concat(b.booking_id, ':', m.maintenance_id)", 'problem_description')}
from booking b join maintenance m on m.space_id = b.space_id and {_MEETS}
where b.booking_status in {_ACTIVE} and m.maintenance_status in {_REPAIR} and m.impact_level = 'advisory'
  and not exists (select 1 from advisory_ack a where a.booking_id = b.booking_id and a.maintenance_id = m.maintenance_id)
""",
        "v06_bad_ack": _ack_check("advisory_ack"),
        "v06_bad_ack_batch": _ack_check("claimed_ack"),
        "v07_session_authority": _session_check("usage_session"),
        "v07_session_authority_batch": _session_check("claimed_session"),
        "v08_decision_authority": _decision_check("booking_decision"),
        "v08_decision_authority_batch": _decision_check("claimed_decision"),
        "v09_domain_checks": _domain_check(_ALL),
        "v09_domain_checks_batch": _domain_check({"booking": "broken_booking", "maintenance": "broken_maintenance"}),
        "v10_unique_keys": _unique_check(_ALL),
        "v10_unique_keys_batch": _unique_check({"app_user": "doubled_user"}),
        "v11_orphans": _orphan_check(_ALL),
        "v11_orphans_batch": _orphan_check({"booking": "stray_booking"}),
        "v12_ack_completeness": f"""
select b.booking_id, count(*) as overlapping_advisories, count(a.booking_id) as acknowledged_advisories,
  count(*) - count(a.booking_id) as missing_advisories
from booking b join maintenance m on m.space_id = b.space_id and {_MEETS}
left join advisory_ack a on a.booking_id = b.booking_id and a.maintenance_id = m.maintenance_id
where b.booking_status in {_ACTIVE} and m.maintenance_status in {_REPAIR} and m.impact_level = 'advisory'
group by b.booking_id
""",
    }
)

# ---- workflow

_IS_STAFF = "account_status = 'Active' and role in ('FacilityStaff', 'FacilityManager')"
_NOTE = "{kind} approval after transactional availability validation."


def _widened(source: str) -> str:
    """CTEs ``pending`` and ``wide``: requests with their policy and buffered interval."""
    return f"""pending as ({source}),
best as (select * from ({_POLICY.format(request='pending')}) where choice = 1),
wide as (
  select q.*, best.policy_id,
    q.requested_start_time - coalesce(best.pre_buffer_minutes, 0) * interval '1' minute as effective_start,
    q.requested_end_time + coalesce(best.post_buffer_minutes, 0) * interval '1' minute as effective_end
  from pending q left join best on for_booking = booking_id)"""


_PENDING = "select * from booking where booking_status = 'Pending'"


def _standing(levels: str) -> str:
    return (
        f"exists (select 1 from maintenance m where m.space_id = b.space_id and m.maintenance_status in {_REPAIR} "
        f"and m.impact_level = '{levels}' and {_MEETS})"
    )


# Serves the requests of each room one after the other, with the list of accepted intervals.
_SERVED = f"""with recursive
{_widened('select * from queue')},
allowed as (
  select q.booking_id from queue q join app_user u on u.user_id = q.requester_user_id join booking_policy p
    on p.auto_approval_enabled and coalesce(p.space_id, q.space_id) = q.space_id
    and coalesce(p.applicable_role, u.role) = u.role and coalesce(p.applicable_purpose, q.purpose) = q.purpose
  group by q.booking_id),
gate as (
  select a.*, b.* exclude (booking_id), case
      when b.booking_id is null then 51034
      when b.booking_status <> 'Pending' then 51036
      when a.decision_maker_user_id not in (select user_id from app_user where {_IS_STAFF}) then 51037
      when b.requester_user_id not in (select user_id from app_user where account_status = 'Active') then 51038
      when not exists (select 1 from space s where s.space_id = b.space_id and s.capacity >= b.expected_participants
        and s.current_status in ('Available', 'InUse')) then 51039
      when a.is_auto and b.booking_id not in (select booking_id from allowed) then 51040
      when exists (select 1 from queue o where o.space_id = b.space_id and o.booking_status in {_ACTIVE}
        and b.effective_start < o.requested_end_time and b.effective_end > o.requested_start_time) then 51041
    end as early,
    case when {_standing('out-of-service')} then 51042
      when not a.acknowledge and {_standing('advisory')} then 51043 end as late
  from approval a left join wide b on b.booking_id = a.booking_id),
line as (
  select *, row_number() over (partition by space_id order by submitted_at, booking_id) as turn from gate where early is null),
served as (
  select distinct space_id, cast(0 as bigint) as turn, cast(null as bigint) as booking_id, cast(null as integer) as code,
    cast([] as struct(a timestamp, b timestamp)[]) as held from line
  union all
  select space_id, turn, booking_id, verdict,
    case when verdict is null then list_append(held, {{'a': requested_start_time, 'b': requested_end_time}}) else held end
  from (
    select l.*, s.held, case
      when len(list_filter(s.held, lambda x: l.effective_start < x.b and l.effective_end > x.a)) > 0 then 51041
      else l.late end as verdict
    from served s join line l on l.space_id = s.space_id and l.turn = s.turn + 1)),
outcome as (
  select g.booking_id, g.decision_maker_user_id, cast(coalesce(g.early, s.code) as integer) as code,
    case when coalesce(g.early, s.code) is null then if(g.is_auto, 'AutoApproved', 'Approved') end as decision
  from gate g left join served s on s.booking_id = g.booking_id)
"""



def _replaced(text: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        if old not in text:
            raise ValueError(f"not there: {old}")
        text = text.replace(old, new)
    return text


# the same with several approvals of a booking, one after the other
_ATTEMPTED = _replaced(
    _SERVED,
    ("from approval a left join", "from attempt a left join"),
    ("order by submitted_at, booking_id) as turn", "order by submitted_at, booking_id, attempt) as turn"),
    ("cast(null as bigint) as booking_id, cast(null as integer) as code", "cast(null as bigint) as booking_id, cast(null as integer) as attempt, cast(null as integer) as code"),
    ("struct(a timestamp, b timestamp)", "struct(a timestamp, b timestamp, id bigint)"),
    ("select space_id, turn, booking_id, verdict,", "select space_id, turn, booking_id, attempt, verdict,"),
    ("'b': requested_end_time}", "'b': requested_end_time, 'id': booking_id}"),
    ("select l.*, s.held, case\n", "select l.*, s.held, case\n      when len(list_filter(s.held, lambda x: x.id = l.booking_id)) > 0 then 51036\n"),
    ("select g.booking_id, g.decision_maker_user_id, cast(coalesce(g.early, s.code) as integer) as code,", """select g.booking_id, g.attempt, g.decision_maker_user_id, cast(case when exists (
      select 1 from served x where x.booking_id = g.booking_id and x.attempt < g.attempt and x.code is null) then 51036 else coalesce(g.early, s.code) end as integer) as code,"""),
    ("on s.booking_id = g.booking_id)", "on s.booking_id = g.booking_id and s.attempt = g.attempt)"),
)

# The code of a new request. The table of requests and the room's columns are given by name.
_ASKED = """select r.*, cast(case when span_end <= span_start then 51030 when participants <= 0 then 51031
    when requester_user_id not in (select user_id from app_user where account_status = 'Active') then 51032
    when auto_approve and decision_maker_user_id is null then 51033
    when s.space_id is null or purpose is null or purpose not in ('Lecture', 'Examination', 'Seminar', 'Workshop', 'Meeting',
      'StudentActivity', 'AdministrativeEvent') then 547
    when current_status in ('UnderMaintenance', 'TemporarilyClosed', 'Retired') or participants > capacity then 51001 end as integer) as code
  from {requests} r left join space s on s.space_id = r.space_id"""

# the batch of approvals that comes of new requests, served like any other
_CREATED = (
    _SERVED.replace("with recursive", f"""with recursive asked as ({_ASKED.format(requests='fresh_request')}),
fresh as (
  select *, (select max(booking_id) from booking) + row_number() over (order by request_id) as booking_id from asked where code is null),
desk as (
  select booking_id, requester_user_id, space_id, requested_start_time, requested_end_time, purpose, expected_participants, booking_status,
    submitted_at from booking
  union all
  select booking_id, requester_user_id, space_id, span_start, span_end, purpose, participants, 'Pending', {_AS_OF} from fresh),
wanted as (select booking_id, decision_maker_user_id, true as is_auto, acknowledge from fresh where auto_approve),""", 1)
    .replace("from queue", "from desk")
    .replace("from approval a", "from wanted a")
)

_LEVELS = f"""with changed as (
  select c.maintenance_id, case when m.maintenance_status in {_REPAIR} then m.impact_level end as prior_impact_level,
    c.new_level as new_impact_level, c.user_id, c.note, cast(case
      when c.new_level not in ('advisory', 'out-of-service') then 51045
      when m.maintenance_id is null then 51046
      when m.maintenance_status not in {_REPAIR} then 51048
      when c.user_id not in (select user_id from app_user where {_IS_STAFF}) then 51049 end as integer) as code
  from level_change c left join maintenance m on m.maintenance_id = c.maintenance_id),
result as (select *, code is null and coalesce(prior_impact_level <> new_impact_level, false) as changed from changed)
"""

# two changes per record, the second after the first
_STREAMED = f"""with valid as (
  select c.*, m.impact_level, m.space_id, m.start_time, m.completion_time
  from timed_change c join maintenance m on m.maintenance_id = c.maintenance_id and m.maintenance_status in {_REPAIR}
  where c.user_id in (select user_id from app_user where {_IS_STAFF})),
moved as (
  select *, coalesce(lag(new_level) over (partition by maintenance_id order by "at", change_id), impact_level) as prior_level from valid)
"""

# approvals served with the levels that records have at their time, and what level changes report
_LEVEL_AT = (
    "coalesce((select arg_max(v.new_level, (v.\"at\", v.command_id)) from moved v where v.maintenance_id = m.maintenance_id "
    "and (v.\"at\", v.command_id) < (coalesce(b.submitted_at, date '1990-01-01' + INTERVAL '0' SECOND), a.booking_id)), m.impact_level)"
)


def _then(level: str) -> str:
    return (
        f"exists (select 1 from maintenance m where m.space_id = b.space_id and m.maintenance_status in {_REPAIR} "
        f"and {_LEVEL_AT} = '{level}' and {_MEETS})"
    )


_COMMANDED = (
    _SERVED.replace("with recursive", f"""with recursive judged as (
  select c.*, m.space_id, m.start_time, m.completion_time, m.impact_level, cast(case
      when c.new_level not in ('advisory', 'out-of-service') then 51045
      when m.maintenance_id is null then 51046
      when m.maintenance_status not in {_REPAIR} then 51048
      when c.decision_maker_user_id not in (select user_id from app_user where {_IS_STAFF}) then 51049 end as integer) as code
  from level_command c left join maintenance m on m.maintenance_id = c.maintenance_id),
moved as (
  select *, coalesce(lag(new_level) over (partition by maintenance_id order by "at", command_id), impact_level) as prior_level
  from judged where code is null),""", 1)
    .replace(_standing("out-of-service"), _then("out-of-service"))
    .replace(_standing("advisory"), _then("advisory"))
)

QUERIES.update(
    {
        "w01_validate_requests": f"""
select *, case when code is null then 'Pending' end as booking_status from ({_ASKED.format(requests='new_request')})
""",
        "w12_create_and_approve": f"""{_CREATED}
select a.request_id, f.booking_id, coalesce(a.code, o.code) as code, o.decision,
  case when a.code is null then if(o.decision is null, 'Pending', 'Approved') end as booking_status
from asked a left join fresh f on f.request_id = a.request_id left join outcome o on o.booking_id = f.booking_id
""",
        "w12_create_and_approve_decisions": f"""{_CREATED}
select (select max(decision_id) from booking_decision) + row_number() over (order by booking_id) as decision_id, booking_id,
  decision_maker_user_id, {_AS_OF} as decision_time, decision, '{_NOTE.format(kind='Automatic')}' as decision_note
from outcome where code is null
""",
        "w02_conflict_check": f"""with {_widened(_PENDING)}
select w.booking_id, o.booking_id as conflicting_booking_id
from wide w join booking o on o.space_id = w.space_id and o.booking_status in {_ACTIVE} and o.booking_id <> w.booking_id
  and w.effective_start < o.requested_end_time and w.effective_end > o.requested_start_time
""",
        "w03_resolve_policy": f"with {_widened(_PENDING)} select booking_id, policy_id, effective_start, effective_end from wide",
        "w04_auto_approval_allowed": f"""with {_widened(_PENDING)}
select booking_id, coalesce(bool_or(auto_approval_enabled), false) as allowed
from pending left join ({_POLICY.format(request='pending')}) on for_booking = booking_id group by booking_id
""",
        "w05_approve_batch": f"{_SERVED} select booking_id, decision_maker_user_id, code, decision from outcome",
        "w05_approve_attempts": f"{_ATTEMPTED} select booking_id, attempt, decision_maker_user_id, code, if(code is null, decision, null) as decision from outcome",
        "w06_record_acks": f"""{_SERVED}
select b.booking_id, m.maintenance_id, {_AS_OF} as acknowledged_at, m.problem_description as advisory_summary_at_acknowledgement
from outcome o join booking b on b.booking_id = o.booking_id join maintenance m on m.space_id = b.space_id and {_MEETS}
where o.code is null and m.maintenance_status in {_REPAIR} and m.impact_level = 'advisory'
  and not exists (select 1 from advisory_ack a where a.booking_id = b.booking_id and a.maintenance_id = m.maintenance_id)
""",
        "w07_record_decisions": f"""{_SERVED}
select (select max(decision_id) from booking_decision) + row_number() over (order by booking_id) as decision_id, booking_id,
  decision_maker_user_id, {_AS_OF} as decision_time, decision,
  if(decision = 'AutoApproved', '{_NOTE.format(kind='Automatic')}', '{_NOTE.format(kind='Manual')}') as decision_note,
  cast(null as varchar) as rejection_reason
from outcome where code is null
""",
        "w07_booking_snapshot": f"""{_SERVED},
noticed as (
  select distinct b.booking_id from outcome o join booking b on b.booking_id = o.booking_id
  join maintenance m on m.space_id = b.space_id and {_MEETS}
  where o.code is null and m.maintenance_status in {_REPAIR} and m.impact_level = 'advisory')
select q.* replace (if(q.booking_id in (select booking_id from outcome where code is null), 'Approved', booking_status) as booking_status),
  if(q.booking_id in (from noticed), {_AS_OF}, null) as advisories_presented_at,
  if(q.booking_id in (from noticed), {_AS_OF}, null) as advisory_acknowledged_at
from queue q
""",
        "w08_change_impact_level": f"{_LEVELS} select * from result",
        "w08_impact_history": f"""{_LEVELS}
select coalesce((select max(impact_history_id) from impact_history), 0) + row_number() over (order by maintenance_id) as impact_history_id,
  maintenance_id, prior_impact_level, new_impact_level, user_id as changed_by_user_id, {_AS_OF} as changed_at, note as change_note
from result where changed
""",
        "w08_maintenance_snapshot": f"""{_LEVELS}
select m.* replace (coalesce(new_impact_level, impact_level) as impact_level)
from maintenance m left join (select maintenance_id, new_impact_level from result where changed) using (maintenance_id)
""",
        "w09_escalation_impacts": f"""{_LEVELS}, hit as (
  select m.maintenance_id, b.booking_id, r.user_id
  from result r join maintenance m on m.maintenance_id = r.maintenance_id join booking b on b.space_id = m.space_id and {_MEETS}
  where r.changed and r.new_impact_level = 'out-of-service' and b.booking_status in {_ACTIVE}
    and not exists (select 1 from booking_impact i where i.maintenance_id = m.maintenance_id and i.booking_id = b.booking_id))
select coalesce((select max(maintenance_booking_impact_id) from booking_impact), 0)
    + row_number() over (order by maintenance_id, booking_id) as maintenance_booking_impact_id,
  maintenance_id, booking_id, {_AS_OF} as identified_at, user_id as identified_by_user_id, 'PendingContact' as contact_status,
  cast(null as timestamp) as contacted_at, cast(null as timestamp) as resolved_at, cast(null as bigint) as resolved_by_user_id,
  cast(null as varchar) as resolution, cast(null as varchar) as resolution_note
from hit
""",
        "w10_verify_approvals": f"""
select booking_id, booking_status, requested_start_time, requested_end_time from booking
where space_id = 1 and requested_start_time >= timestamp '{WINDOW[0]}' and requested_start_time < timestamp '{WINDOW[1]}'
""",
        "w10_verify_approvals_count": f"""
select count(*) as approved_booking_count from booking where space_id = 1 and booking_status = 'Approved'
  and requested_start_time >= timestamp '{WINDOW[0]}' and requested_start_time < timestamp '{WINDOW[1]}'
""",
        "w10_verify_approvals_pairs": f"""
select a.booking_id as first_booking_id, b.booking_id as second_booking_id from booking a join booking b on b.space_id = a.space_id
  and a.booking_id < b.booking_id and a.requested_start_time < b.requested_end_time and a.requested_end_time > b.requested_start_time
where a.space_id = 1 and a.booking_status in {_ACTIVE} and b.booking_status in {_ACTIVE}
""",
        "w11_verify_escalation": """
select p.booking_id, p.maintenance_id, count(a.booking_id) as advisory_acknowledgement_count
from traced_pair p left join advisory_ack a on a.booking_id = p.booking_id and a.maintenance_id = p.maintenance_id group by all
""",
        "w11_verify_escalation_impacts": """
select maintenance_id, booking_id, contact_status, impact_level from booking_impact join maintenance using (maintenance_id)
where (booking_id, maintenance_id) in (select (booking_id, maintenance_id) from traced_pair)
""",
        "s01_stream_approvals": f"{_SERVED} select booking_id, code, decision from outcome",
        "s01_stream_approvals_impacts": f"""{_COMMANDED}
select booking_id as command_id, booking_id, cast(null as bigint) as maintenance_id, code, decision as result, cast(null as bigint) as impacted_booking_id
from outcome
union all
select command_id, null, maintenance_id, code, null, null from judged where code is not null
union all
select command_id, null, maintenance_id, null, if(prior_level = new_level, 'Unchanged', 'Changed'), null from moved
union all
select arg_min(m.command_id, (m."at", m.command_id)), null, m.maintenance_id, null, 'Impact', b.booking_id
from moved m join queue b on b.space_id = m.space_id and {_MEETS}
join outcome o on o.booking_id = b.booking_id and o.decision is not null
where m.prior_level <> m.new_level and m.new_level = 'out-of-service'
  and (coalesce(b.submitted_at, date '1990-01-01' + INTERVAL '0' SECOND), b.booking_id) < (m."at", m.command_id)
group by m.maintenance_id, b.booking_id
""",
        "s02_stream_escalations": f"""{_STREAMED}
select m.maintenance_id, b.booking_id, min(m."at") as identified_at, arg_min(m.user_id, m."at") as identified_by_user_id,
  'PendingContact' as contact_status
from moved m join booking b on b.space_id = m.space_id and {_MEETS}
where m.prior_level = 'advisory' and m.new_level = 'out-of-service' and b.booking_status in {_ACTIVE}
  and not exists (select 1 from booking_impact i where i.maintenance_id = m.maintenance_id and i.booking_id = b.booking_id)
group by m.maintenance_id, b.booking_id
""",
        "s02_stream_escalations_history": f"""{_STREAMED}
select maintenance_id, prior_level as prior_impact_level, new_level as new_impact_level, user_id as changed_by_user_id,
  "at" as changed_at, note as change_note
from moved where prior_level <> new_level
""",
    }
)

# ---- tables and generators


def _summary(sources: dict[str, str]) -> str:
    parts = []
    for table, source in sources.items():
        optional = [f"count({f.name})" for f in SCHEMAS[table] if f.nullable] or ["0"]
        parts.append(
            f"select '{table}' as table_name, count(*) as row_count, cast({' + '.join(optional)} as bigint) as filled_optional_values "
            f"from {source}"
        )
    return "\nunion all ".join(parts)


_HISTORY_AFTER = (
    "(select prior_impact_level from impact_history union all select prior_impact_level from result where changed)"
)

_MADE = """made as (
  select n, n % (select count(*) from space) as room, n // (select count(*) from space) as slot,
    n % (select count(*) from app_user where role <> 'FacilityStaff') as person from booking_base),
day as (
  select booking_date, row_number() over (order by booking_date) - 1 as number from (select distinct booking_date from ship_day)
  where isodow(booking_date) < 6 and month(booking_date) not in (6, 7)),
generated as (
  select n + 1 as booking_id, p.user_id as requester_user_id, s.space_id,
    booking_date + to_hours(if(slot % 2 = 0, 9, 13)) as requested_start_time,
    booking_date + to_hours(if(slot % 2 = 0, 11, 15)) as requested_end_time,
    ['Lecture', 'Examination', 'Seminar', 'Workshop', 'Meeting', 'StudentActivity', 'AdministrativeEvent'][n % 7 + 1] as purpose,
    cast(if(capacity < 10, capacity, 5 + n % (capacity - 4)) as integer) as expected_participants,
    case when n % 100 < 70 then 'Approved' when n % 100 < 80 then 'Completed' when n % 100 < 85 then 'NoShow'
      when n % 100 < 93 then 'Cancelled' when n % 100 < 98 then 'Rejected' else 'Pending' end as booking_status,
    booking_date - to_days(cast(14 + n % 21 as integer)) as submitted_at,
    case when n % 100 between 85 and 92 then booking_date - to_days(3) end as cancelled_at,
    case when n % 100 between 85 and 92 then p.user_id end as cancelled_by_user_id,
    case when n % 100 between 85 and 92 then 'Made cancellation.' end as cancellation_note
  from made join day on day.number = slot // 2
  join (select space_id, capacity, row_number() over (order by space_id) - 1 as number from space) s on s.number = room
  join (select user_id, row_number() over (order by user_id) - 1 as number from app_user where role <> 'FacilityStaff') p
    on p.number = person),
staff as (select min(user_id) as staff_id from app_user where role = 'FacilityStaff'),
advisory as (
  select space_id * 2 as maintenance_id, space_id, max(requested_start_time) + interval 15 minute as start_time,
    concat('Made advisory on booking ', arg_max(booking_id, (requested_start_time, booking_id)), ': take care.') as problem_description
  from generated where booking_status = 'Approved' group by space_id),
ack as (
  select g.booking_id, maintenance_id, requested_start_time - interval 5 minute as acknowledged_at,
    problem_description as advisory_summary_at_acknowledgement
  from generated g join advisory a on a.space_id = g.space_id and requested_end_time > start_time where booking_status = 'Approved')
"""

QUERIES.update(
    {
        "o01_load_tables": _summary(_ALL),
        "o12_write_tables": _LEVELS + _summary({**_ALL, "impact_history": _HISTORY_AFTER}),
        "o12_version_maintenance": QUERIES["w08_maintenance_snapshot"],
        "o12_version_history": _LEVELS
        + "select * from impact_history union all by name select * from ("
        + QUERIES["w08_impact_history"].removeprefix(_LEVELS)
        + ")",
        "o02_insert_if_absent": """
select *, cast(null as timestamp) as advisories_presented_at, cast(null as timestamp) as advisory_acknowledged_at from (
  select * from booking where booking_status <> 'Completed'
  union all
  select * from booking s where not exists (select 1 from booking k where k.booking_status <> 'Completed'
    and k.requester_user_id = s.requester_user_id and k.requested_start_time = s.requested_start_time)
  qualify row_number() over (partition by requester_user_id, requested_start_time order by booking_id) = 1)
""",
        "o03_upgrade_phase1": "select *, 'out-of-service' as impact_level from plain_maintenance",
        "o03_upgrade_phase1_policy": "select * exclude (auto_approval_enabled), false as auto_approval_enabled from booking_policy",
        "o03_upgrade_phase1_booking": f"select * from {_FULL_BOOKING}",
        "o04_generate_users": """
select n as user_id, concat('Person ', n) as full_name, concat('bench.', if(n < 10000, right(concat('0000', n), 4), cast(n as varchar)), '@example.org') as email,
  concat('0908', if(n < 1000000, right(concat('000000', n), 6), cast(n as varchar))) as phone_number,
  case when n > 980 then 'FacilityStaff' when n % 10 = 0 then 'Lecturer' when n % 10 = 1 then 'TA' else 'Student' end as role,
  if(n > 980, 'Facilities', 'Computer Science') as department, 'Active' as account_status
from person_number
""",
        "o05_generate_spaces": """
select n as space_id, concat('BENCH-', if(n < 1000, right(concat('000', n), 3), cast(n as varchar))) as space_code, concat('Room ', n) as space_name,
  ['Classroom', 'MeetingRoom', 'ComputerLaboratory', 'ProjectLaboratory', 'StudentWorkspace'][n % 5 + 1] as space_type,
  concat('Wing ', (n - 1) % 8 + 1) as building, cast((n - 1) % 6 + 1 as varchar) as floor,
  concat('B', if(n < 1000, right(concat('000', n), 3), cast(n as varchar))) as room_number, cast(20 + (n * 7) % 181 as integer) as capacity,
  'Available' as current_status, 'Made room; open to all made people.' as usage_policy
from room_number_source
""",
        "o06_generate_calendar": f"with {_MADE} select booking_date, number as academic_day_number from day",
        "o07_generate_bookings": f"""with {_MADE}
select *, cast(null as timestamp) as advisories_presented_at, cast(null as timestamp) as advisory_acknowledged_at from generated
""",
        "o08_generate_decisions": f"""with {_MADE}
select booking_id as decision_id, booking_id, staff_id as decision_maker_user_id, submitted_at + interval 1 day as decision_time,
  if(booking_status = 'Rejected', 'Rejected', 'Approved') as decision, 'Made decision.' as decision_note,
  case when booking_status = 'Rejected' then 'Made refusal.' end as rejection_reason
from generated cross join staff where booking_status not in ('Pending', 'Cancelled')
""",
        "o09_generate_maintenance": f"""with {_MADE}
select space_id * 2 - 1 as maintenance_id, space_id, staff_id as reporter_user_id, staff_id as assigned_staff_user_id,
  'Made outage.' as problem_description, timestamp '2022-06-01 00:00:00' as start_time,
  timestamp '2022-06-01 04:00:00' as completion_time, 'Completed' as maintenance_status, 'out-of-service' as impact_level,
  'Over before the first booking.' as result_note
from space cross join staff
union all
select maintenance_id, space_id, staff_id, staff_id, problem_description, start_time, null, 'InProgress', 'advisory', null
from advisory cross join staff
""",
        "o10_generate_acks": f"with {_MADE} select * from ack",
        "o10_generate_ack_times": f"""with {_MADE}
select g.*,
  case when booking_id in (select booking_id from ack) then requested_start_time - interval 5 minute end as advisories_presented_at,
  case when booking_id in (select booking_id from ack) then requested_start_time - interval 4 minute end as advisory_acknowledged_at
from generated g
""",
        "o11_dataset_summary": """
select count(*) as generated_bookings, min(requested_start_time) as first_booking, max(requested_end_time) as last_booking from booking
""",
        "o11_dataset_summary_status": "select booking_status, count(*) as booking_count from booking group by booking_status",
        "o11_dataset_summary_maintenance": """
select impact_level, maintenance_status, count(*) as maintenance_count from maintenance group by all
""",
    }
)

# one event after the other
_WALK = """with recursive happened as (
  select booking_id, cancelled_at as event_time, booking_id as event_id, 'Cancelled' as new_status, 6 as place from booking where cancelled_at is not null
  union all select booking_id, decision_time, decision_id, if(decision = 'Rejected', 'Rejected', 'Approved'), if(decision = 'Rejected', 2, 1) from booking_decision
  union all select booking_id, actual_start_time, usage_session_id, 'CheckedIn', 3 from usage_session
  union all select booking_id, actual_end_time, usage_session_id, 'Completed', 4 from usage_session where actual_end_time is not null),
numbered as (select *, row_number() over (partition by booking_id order by event_time, place, event_id) as k from happened),
walk as (
  select booking_id, cast(0 as bigint) as k, 'Pending' as status, 'Pending' as status_before, false as refused from booking
  union all
  select booking_id, k, if(legal, new_status, status), status, not legal from (
    select n.booking_id, n.k, n.new_status, w.status, concat(w.status, '>', n.new_status) in ('Pending>Approved', 'Pending>Rejected',
      'Pending>Cancelled', 'Approved>Cancelled', 'Approved>CheckedIn', 'Approved>NoShow', 'CheckedIn>Completed') as legal
    from walk w join numbered n on n.booking_id = w.booking_id and n.k = w.k + 1))
"""
_REACHED = """
select b.booking_id, b.booking_status, e.status as reached_status from {booking} b
join (select booking_id, arg_max(status, k) as status from walk group by booking_id) e on e.booking_id = b.booking_id
where b.booking_status is distinct from e.status and not (b.booking_status = 'NoShow' and e.status = 'Approved')
"""

QUERIES.update(
    {
        "v13_status_changes": _WALK
        + "select booking_id, event_time, event_id, status_before, new_status from walk join numbered using (booking_id, k) where refused",
        "v13_status_reached": _WALK + _REACHED.format(booking="booking"),
        "v13_status_reached_batch": _WALK + _REACHED.format(booking="broken_booking"),
    }
)

_PENDING_FLAGS = f"""
select b.booking_id, m.maintenance_id, greatest(b.submitted_at, m.start_time) as flagged_at
from booking b join maintenance m on m.space_id = b.space_id and {_MEETS}
where b.booking_status = 'Pending' and m.maintenance_status in {_REPAIR} and m.impact_level = 'out-of-service'
"""
QUERIES.update({"w13_pending_flags": _PENDING_FLAGS, "s03_stream_pending_flags": _PENDING_FLAGS})

_LOADED_IDS = {name: key[0] for name, key in PRIMARY_KEYS.items() if name in NATURAL_KEYS and key != NATURAL_KEYS[name]}


def _load_steps(table: str) -> list[str]:
    """For a table and its parents: g_ (given, with the target's references), a_ (added), l_ (loaded), m_ (ids)."""
    parents = [(column, parent) for child, column, parent, _ in FOREIGN_KEYS if child == table]
    steps = [step for parent in dict.fromkeys(p for _, p in parents) for step in _load_steps(parent)]
    number, keys = _LOADED_IDS.get(table), NATURAL_KEYS[table]
    moved = "".join(f", m{k}.held as {column}" for k, (column, _) in enumerate(parents))
    joins = "".join(f" left join m_{parent} m{k} on m{k}.given = g.{column}" for k, (column, parent) in enumerate(parents))
    left_out = f"exclude ({', '.join(column for column, _ in parents)})" if parents else ""
    same = " and ".join(f"h.{k} is not distinct from g.{k}" for k in keys)
    new_id = f", (select coalesce(max({number}), 0) from held_{table}) + row_number() over (order by "
    new_id += ", ".join(f"{k} nulls first" for k in keys) + f") as {number}"
    steps += [
        f"g_{table} as (select g.* {left_out}{moved} from given_{table} g{joins})",
        f"f_{table} as (select * from g_{table} g where not exists (select 1 from held_{table} h where {same}) "
        f"qualify row_number() over (partition by {', '.join(keys)} order by {number or keys[0]}) = 1)",
        f"a_{table} as (select * {f'exclude ({number}) {new_id}' if number else ''} from f_{table})",
        f"l_{table} as (select * from held_{table} union all by name select * from a_{table})",
    ]
    if number:
        steps.append(f"m_{table} as (select g.{number} as given, min(h.{number}) as held from g_{table} g join l_{table} h on {same} group by 1)")
    return list(dict.fromkeys(steps))


for _table in NATURAL_KEYS:
    _times = ", cast(null as timestamp) as advisories_presented_at, cast(null as timestamp) as advisory_acknowledged_at"
    QUERIES[f"o02_load_{_table}"] = (
        "with " + ",\n".join(_load_steps(_table)) + f"\nselect *{_times if _table == 'booking' else ''} from l_{_table}"
    )


def oracle(name: str) -> str:
    return with_fragments(QUERIES[name].strip(), PARAMETERS)
