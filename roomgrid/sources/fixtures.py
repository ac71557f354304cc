"""The twelve tables derived from the test tables of an order business.

Every fragment is plain SQL that runs unchanged in Spark and in DuckDB, so the oracle uses
the same text as the head of its own query. ``FIXTURES.md`` explains the choices.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from roomgrid.schema import TABLES
from roomgrid.session import cut_lineage
from roomgrid.sources.tables import Tables, conform
from roomgrid.sources.upgrade import with_advisory_times

SOURCES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

FRAGMENTS: dict[str, str] = {
    "app_user": """
select c_custkey as user_id, c_name as full_name,
  concat('user', c_custkey, '@example.org') as email,
  case when c_custkey % 9 = 0 then null else concat('09', c_custkey) end as phone_number,
  case when c_custkey % 50 = 0 then 'FacilityStaff' when c_custkey % 50 = 1 then 'FacilityManager'
       when c_custkey % 50 = 2 then 'DeptAdmin' when c_custkey % 10 = 3 then 'Lecturer'
       when c_custkey % 10 = 4 then 'TA' else 'Student' end as role,
  c_mktsegment as department,
  case when c_custkey % 37 = 5 then 'Inactive' else 'Active' end as account_status
from customer
""",
    "space": """
select s_suppkey as space_id, concat('SP-', s_suppkey) as space_code, s_name as space_name,
  case s_suppkey % 6 when 0 then 'Classroom' when 1 then 'MeetingRoom' when 2 then 'ComputerLaboratory'
       when 3 then 'ProjectLaboratory' when 4 then 'StudentWorkspace' else 'Auditorium' end as space_type,
  concat('Block ', s_suppkey % 8 + 1) as building, concat('', s_suppkey % 6 + 1) as floor,
  concat('B', s_suppkey) as room_number,
  cast(20 + ((s_suppkey * 7) % 181) as int) as capacity,
  case when s_suppkey % 20 = 7 then 'UnderMaintenance' when s_suppkey % 20 = 13 then 'TemporarilyClosed'
       when s_suppkey % 20 = 19 then 'Retired' when s_suppkey % 4 = 1 then 'InUse' else 'Available' end as current_status,
  cast(null as varchar(1000)) as usage_policy
from supplier
""",
    "facility": """
select cast(n_nationkey as bigint) as facility_id, n_name as facility_name, r_name as facility_type,
  cast(null as varchar(500)) as description
from nation join region on r_regionkey = n_regionkey
""",
    "space_facility": """
select s_suppkey as space_id, cast(n_nationkey as bigint) as facility_id,
  cast(1 + (s_suppkey + n_nationkey) % 5 as int) as quantity, cast(null as varchar(500)) as notes
from supplier join nation on (4 - n_nationkey % 4) % 4 = (s_suppkey * 3) % 4
""",
    "booking_policy": """
select cast(1 as bigint) as policy_id, cast(null as bigint) as space_id, cast(null as varchar(30)) as applicable_role,
  cast(null as varchar(40)) as applicable_purpose, 60 as minimum_lead_minutes, 120 as cancellation_lead_minutes,
  0 as pre_buffer_minutes, 15 as post_buffer_minutes, false as auto_approval_enabled
union all select cast(2 as bigint), null, 'Lecturer', null, 30, 60, 0, 10, true
union all select cast(3 as bigint), null, null, 'Examination', 2880, 2880, 30, 30, false
union all select s_suppkey + 10, s_suppkey, null, 'Seminar', 1440, 1440, 30, 30, s_suppkey % 2 = 0 from supplier where s_suppkey % 5 = 0
union all select s_suppkey + 1000010, s_suppkey, 'Student', null, 120, 240, 5, 5, true from supplier where s_suppkey % 7 = 0
""",
    "booking_base": """
select l_orderkey * 7 + l_linenumber - 1 as n, l_orderkey, min(l_suppkey) as sk, min(l_shipdate) as d
from lineitem group by l_orderkey, l_linenumber
""",
    "booking": """
select n as booking_id, o_custkey as requester_user_id, sk as space_id,
  d + (480 + (n * 37 % 20) * 30) * INTERVAL '1' MINUTE as requested_start_time,
  d + (540 + (n * 37 % 20) * 30 + (n % 7) * 30) * INTERVAL '1' MINUTE as requested_end_time,
  case n % 7 when 0 then 'Lecture' when 1 then 'Examination' when 2 then 'Seminar' when 3 then 'Workshop'
       when 4 then 'Meeting' when 5 then 'StudentActivity' else 'AdministrativeEvent' end as purpose,
  cast(1 + n % (20 + ((sk * 7) % 181)) as int) as expected_participants,
  case when n % 100 < 60 then 'Approved' when n % 100 < 75 then 'Completed' when n % 100 < 80 then 'NoShow'
       when n % 100 < 88 then 'Cancelled' when n % 100 < 93 then 'Rejected' when n % 100 < 96 then 'CheckedIn'
       else 'Pending' end as booking_status,
  d - (14 + n % 21) * INTERVAL '1' DAY + (n * 53 % 86400) * INTERVAL '1' SECOND as submitted_at,
  case when n % 100 between 80 and 87 then d - INTERVAL '3' DAY end as cancelled_at,
  case when n % 100 between 80 and 87 then o_custkey end as cancelled_by_user_id,
  case when n % 100 between 80 and 87 then 'schedule changed' end as cancellation_note
from booking_base join orders on o_orderkey = l_orderkey
""",
    "booking_decision": """
select booking_id * 2 as decision_id, booking_id, (booking_id % 3) * 50 as decision_maker_user_id,
  submitted_at + (1 + booking_id % 2880) * INTERVAL '1' MINUTE + (booking_id % 60) * INTERVAL '1' SECOND as decision_time,
  case when booking_status = 'Rejected' then 'Rejected' when booking_id % 4 = 0 then 'AutoApproved' else 'Approved' end as decision,
  'first decision' as decision_note,
  case when booking_status = 'Rejected' then 'not suitable' end as rejection_reason
from booking where booking_status not in ('Pending', 'Cancelled')
union all
select booking_id * 2 + 1, booking_id, 50, submitted_at + (3000 + booking_id % 2880) * INTERVAL '1' MINUTE, 'Approved', 'confirmed later', null
from booking where booking_status = 'Completed' and booking_id % 10 = 0
""",
    "usage_session": """
select booking_id as usage_session_id, booking_id, (booking_id % 3) * 50 as check_in_by_user_id,
  requested_start_time + (booking_id % 15 - 5) * INTERVAL '1' MINUTE as actual_start_time,
  'clean' as initial_condition,
  case when booking_status = 'Completed' then ((booking_id + 1) % 3) * 50 end as check_out_by_user_id,
  case when booking_status = 'Completed' then requested_end_time + (booking_id % 41 - 10) * INTERVAL '1' MINUTE end as actual_end_time,
  case when booking_status = 'Completed' then 'clean' end as final_condition,
  case when booking_id % 4 = 0 then 'noted' end as usage_notes
from booking where booking_status in ('Completed', 'CheckedIn')
""",
    "maintenance": """
select event_id as maintenance_id, (event_id * 7 + user_id) % (select count(*) from supplier) as space_id,
  user_id as reporter_user_id, case when event_id % 3 = 0 then cast(50 as bigint) end as assigned_staff_user_id,
  concat('problem ', event_type, ' ', event_id) as problem_description,
  (select min(l_shipdate) from lineitem) + ((event_id * 11) % 2400) * INTERVAL '1' DAY + (event_id * 53 % 86400) * INTERVAL '1' SECOND as start_time,
  case when event_id % 50 <> 0 then (select min(l_shipdate) from lineitem) + ((event_id * 11) % 2400) * INTERVAL '1' DAY + (event_id * 53 % 86400) * INTERVAL '1' SECOND
       + (1 + event_id % 72) * INTERVAL '1' HOUR end as completion_time,
  case event_id % 200 when 0 then 'InProgress' when 100 then 'Assigned' when 50 then 'Reported' when 150 then 'Cancelled' else 'Completed' end as maintenance_status,
  case when user_id % 3 = 0 then 'out-of-service' else 'advisory' end as impact_level,
  case when event_id % 50 <> 0 then 'fixed' end as result_note
from events
""",
    "advisory_ack": """
select b.booking_id, m.maintenance_id, b.requested_start_time - INTERVAL '5' MINUTE as acknowledged_at,
  m.problem_description as advisory_summary_at_acknowledgement
from booking b join maintenance m on m.space_id = b.space_id and b.requested_end_time > m.start_time
where b.booking_status in ('Approved', 'CheckedIn') and m.impact_level = 'advisory'
  and m.maintenance_status in ('Reported', 'Assigned', 'InProgress') and b.booking_id % 3 <> 0
""",
    "impact_history": """
select maintenance_id as impact_history_id, maintenance_id, 'advisory' as prior_impact_level,
  impact_level as new_impact_level, cast(50 as bigint) as changed_by_user_id,
  start_time + INTERVAL '6' HOUR as changed_at, 'got worse' as change_note
from maintenance where impact_level = 'out-of-service' and maintenance_status in ('Reported', 'Assigned', 'InProgress')
""",
    "booking_impact": """
select b.booking_id * 1000000 + m.maintenance_id as maintenance_booking_impact_id, m.maintenance_id, b.booking_id,
  h.changed_at as identified_at, h.changed_by_user_id as identified_by_user_id,
  case b.booking_id % 3 when 0 then 'PendingContact' when 1 then 'Contacted' else 'Resolved' end as contact_status,
  case when b.booking_id % 3 <> 0 then h.changed_at + INTERVAL '1' HOUR end as contacted_at,
  case when b.booking_id % 3 = 2 then h.changed_at + INTERVAL '2' HOUR end as resolved_at,
  case when b.booking_id % 3 = 2 then cast(50 as bigint) end as resolved_by_user_id,
  case when b.booking_id % 3 = 2 then 'Relocated' end as resolution,
  cast(null as varchar(1000)) as resolution_note
from impact_history h join maintenance m on m.maintenance_id = h.maintenance_id
join booking b on b.space_id = m.space_id and b.requested_end_time > m.start_time
where b.booking_status in ('Approved', 'CheckedIn')
""",
}

_WORD = re.compile(r"[a-z_]+")


def fragments_for(text: str, extra: dict[str, str] | None = None) -> list[str]:
    """The fragments that a query needs, each after those it is built on."""
    known = {**FRAGMENTS, **(extra or {})}
    needed: list[str] = []

    def visit(sql: str) -> None:
        for word in _WORD.findall(sql):
            if word in known and word not in needed and sql is not known[word]:
                visit(known[word])
                if word not in needed:
                    needed.append(word)

    visit(text)
    return needed


def with_fragments(query: str, extra: dict[str, str] | None = None) -> str:
    """The query with the fragments it needs as common table expressions."""
    known = {**FRAGMENTS, **(extra or {})}
    heads = [f"{name} as ({known[name]})" for name in fragments_for(query, extra)]
    if not heads:
        return query
    recursive = query.lstrip().lower().startswith("with recursive")
    body = re.sub(r"^\s*with(\s+recursive)?\s", ", ", query, count=1, flags=re.I) if re.match(r"\s*with\s", query, re.I) else f"\n{query}"
    return f"with {'recursive ' if recursive else ''}" + ",\n".join(heads) + body


def _source_views(spark: SparkSession, folder: str) -> str:
    """Register the source files in the session, unless it knows them; returns the prefix of the view names."""
    prefix = f"src_{folder.encode().hex()}_"
    for name in SOURCES:
        if not spark.catalog.tableExists(prefix + name):
            spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(prefix + name)
    return prefix


#: Bytes of the lines' files that one task groups by order.
DEALT_BYTES = 8 << 20


def _by_order(spark: SparkSession, folder: str) -> dict[str, str]:
    """Spark deals the lines by order once: the grouping and the join with the orders both go on from there.

    A task's memory follows its share of the lines, so large files go to more places than the session asks for.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/lineitem.parquet")
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    parts = -(-size // DEALT_BYTES)
    dealt = "select * from lineitem distribute by l_orderkey"
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        dealt = f"select /*+ repartition({parts}, l_orderkey) */ * from lineitem"
    return {"booking_base": FRAGMENTS["booking_base"].replace("from lineitem", f"from ({dealt})")}


def derived(spark: SparkSession, folder: str, query: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Run a query over the derived tables of a folder."""
    prefix = _source_views(spark, folder)
    text = with_fragments(query, extra)
    if re.search(r"\bbooking_base\b", text):
        text = with_fragments(query, {**(extra or {}), **_by_order(spark, folder)})
    used = [s for s in SOURCES if re.search(rf"\b{s}\b", text)]
    if not used:
        return spark.sql(text)
    heads = ", ".join(f"{s} as (select * from {prefix}{s})" for s in used)
    return spark.sql(f"with {heads}, {text[5:]}" if text.startswith("with ") else f"with {heads} {text}")


def kept(spark: SparkSession, folder: str, name: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Store the rows of a fragment; returns the fragment that reads them, for jobs that meet it several times."""
    view = f"kept_{uuid.uuid4().hex}"
    cut_lineage(derived(spark, folder, f"select * from {name}", extra)).createOrReplaceTempView(view)
    return {name: f"select * from {view}"}


def derived_tables(spark: SparkSession, folder: str, extra: dict[str, str] | None = None) -> Tables:
    """The twelve tables over a folder of test tables. Nothing runs before a job reads them."""

    def table(name: str):
        def build() -> DataFrame:
            df = derived(spark, folder, f"select * from {name}", extra)
            return conform(with_advisory_times(df) if name == "booking" else df, name)

        return build

    return Tables({name: table(name) for name in TABLES})
