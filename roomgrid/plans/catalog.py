"""Every job under its name, with the parameters used for the check against the oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.functions.exprs import epoch_second
from roomgrid.operators.upsert import insert_if_absent
from roomgrid.plans import analytics, reports, rules, workflow
from roomgrid.schema import NATURAL_KEYS, SCHEMAS
from roomgrid.session import cut_lineage, drop_paths, release_shuffles, settle, shared_dir, shared_paths
from roomgrid.sources import generate
from roomgrid.sources.fixtures import derived, derived_tables, kept
from roomgrid.sources.load import LOADED, load_absent
from roomgrid.sources.snapshots import read_version, write_version
from roomgrid.sources.tables import Tables, append_rows, conform, load_tables, table_summary, write_tables
from roomgrid.sources.upgrade import upgrade_phase1, with_advisory_times
from roomgrid.streaming import approvals, commands, escalations, flags

AS_OF = "1998-07-01 00:00:00"
SEMESTER = ("1998-01-01 00:00:00", "1998-06-01 00:00:00")

# Parameter rows of the searches, as SQL that Spark and the oracle share.
PARAMETERS: dict[str, str] = {
    "room_request": """
select cast(1 as bigint) as request_id, cast('1998-03-04 09:00:00' as timestamp) as span_start,
  cast('1998-03-04 11:00:00' as timestamp) as span_end, 30 as participants
union all select 2, cast('1995-06-14 08:00:00' as timestamp), cast('1995-06-16 18:30:00' as timestamp), 120
union all select 3, cast('1992-01-01 00:00:00' as timestamp), cast('1992-01-01 00:00:01' as timestamp), 1
""",
    "room_wish": """
select cast(1 as bigint) as request_id, facility_name, facility_type from facility where facility_id = 3
union all select 2, facility_name, facility_type from facility where facility_id in (3, 7)
""",
}


def parameter(spark: SparkSession, folder: str, name: str, extra: dict[str, str] | None = None) -> DataFrame:
    df = derived(spark, folder, f"select * from {name}", {**PARAMETERS, **(extra or {})})
    times = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: df[c].cast("timestamp_ntz") for c in times})


def room_requests(spark: SparkSession, folder: str) -> DataFrame:
    return parameter(spark, folder, "room_request").withColumnsRenamed({"span_start": "start", "span_end": "end"})


Job = Callable[[SparkSession, str], DataFrame]


def _on_tables(job, *args, **options) -> Job:
    return lambda spark, folder: job(derived_tables(spark, folder), *args, **options)


JOBS: dict[str, Job] = {
    "r01_upcoming_bookings": _on_tables(reports.r01_upcoming_bookings, AS_OF),
    "r02_availability_search": lambda spark, folder: reports.r02_availability_search(
        derived_tables(spark, folder), room_requests(spark, folder)
    ),
    "r03_space_utilization": _on_tables(reports.r03_space_utilization, AS_OF),
    "r04_peak_start_hours": _on_tables(reports.r04_peak_start_hours),
    "r05_capacity_demand": _on_tables(reports.r05_capacity_demand),
    "r06_session_variance": _on_tables(reports.r06_session_variance),
    "r07_overlapping_bookings": _on_tables(reports.r07_overlapping_bookings),
    "r08_booking_maintenance_conflicts": _on_tables(reports.r08_booking_maintenance_conflicts),
    "r09_unavailable_spaces": _on_tables(reports.r09_unavailable_spaces, AS_OF),
    "r10_booking_gaps": _on_tables(reports.r10_booking_gaps),
    "r11_role_outcomes": _on_tables(reports.r11_role_outcomes),
    "r12_requester_reliability": _on_tables(reports.r12_requester_reliability),
    "r13_decision_turnaround": _on_tables(reports.r13_decision_turnaround),
    "r14_monthly_workload": _on_tables(reports.r14_monthly_workload),
    "r15_maintenance_turnaround": _on_tables(reports.r15_maintenance_turnaround, AS_OF),
    "r16_facility_demand": _on_tables(reports.r16_facility_demand),
    "r17_open_sessions": _on_tables(reports.r17_open_sessions, AS_OF),
    "r18_capacity_fit": _on_tables(reports.r18_capacity_fit),
    "r19_effective_policy": _on_tables(reports.r19_effective_policy),
    "r20_audit_timeline": _on_tables(reports.r20_audit_timeline),
    "a01_semester_hours": _on_tables(analytics.a01_semester_hours, *SEMESTER),
    "a02_usage_distribution": _on_tables(analytics.a02_usage_distribution, *SEMESTER),
    "a03_room_finder": lambda spark, folder: analytics.a03_room_finder(
        derived_tables(spark, folder), room_requests(spark, folder), parameter(spark, folder, "room_wish")
    ),
    "a04_maintenance_impact": _on_tables(analytics.a04_maintenance_impact),
}


# ---- rule checks and workflow

PARAMETERS["approval"] = """
select booking_id, case booking_id % 13 when 0 then cast(3 as bigint) when 1 then 100 else 50 end as decision_maker_user_id,
  booking_id % 3 = 0 as is_auto, booking_id % 2 = 0 as acknowledge
from queue where booking_status in ('Pending', 'Rejected')
union all select -1 - booking_id, 50, false, true from queue where booking_status = 'NoShow'
"""
# two to four approvals of a booking: by someone who may not, without an acknowledgement, with one, again
PARAMETERS["attempt"] = """
select booking_id, cast(k as integer) as attempt, case when k = booking_id % 4 then cast(100 as bigint) else 50 end as decision_maker_user_id,
  (booking_id + k) % 3 = 0 as is_auto, k > booking_id % 3 as acknowledge
from (select booking_id from queue where booking_status in ('Pending', 'Rejected') union all select -1 - booking_id from queue where booking_status = 'NoShow')
cross join (values (0), (1), (2), (3)) as tries(k) where k < 2 + booking_id % 3
"""
# every approved booking is put back into the queue, so that requests really compete
PARAMETERS["queue"] = """
select booking_id, requester_user_id, space_id, requested_start_time, requested_end_time, purpose, expected_participants,
  case when booking_status = 'Approved' then 'Pending' else booking_status end as booking_status,
  submitted_at, cancelled_at, cancelled_by_user_id, cancellation_note
from booking
"""
PARAMETERS["new_request"] = """
select booking_id as request_id, requester_user_id, space_id, requested_start_time as span_start,
  case when booking_id % 17 = 0 then requested_start_time else requested_end_time end as span_end, purpose,
  case when booking_id % 19 = 0 then 0 else expected_participants end as participants,
  booking_id % 5 = 0 as auto_approve, case when booking_id % 4 = 0 then cast(50 as bigint) end as decision_maker_user_id,
  booking_id % 2 = 0 as acknowledge
from booking
"""
# the same wishes ten years later, where only each other is in the way; some rooms and purposes are unknown
PARAMETERS["fresh_request"] = """
select request_id, requester_user_id, case when request_id % 23 = 0 then -1 - space_id else space_id end as space_id,
  span_start + INTERVAL '3652' DAY as span_start, span_end + INTERVAL '3652' DAY as span_end,
  case when request_id % 29 = 0 then 'Party' when request_id % 31 = 0 then null else purpose end as purpose, participants,
  auto_approve, case when request_id % 35 = 0 then null when request_id % 25 = 0 then cast(3 as bigint) else 50 end as decision_maker_user_id, acknowledge
from new_request
"""
PARAMETERS["level_change"] = """
select maintenance_id, case maintenance_id % 7 when 0 then 'broken' when 1 then 'advisory' else 'out-of-service' end as new_level,
  case maintenance_id % 11 when 0 then cast(3 as bigint) else 50 end as user_id, 'level review' as note
from maintenance
union all select -1 - maintenance_id, 'advisory', 50, 'unknown record' from maintenance
"""
PARAMETERS["traced_pair"] = """
select booking_id, maintenance_id from booking_impact union select booking_id, maintenance_id from advisory_ack
"""
PARAMETERS["plain_maintenance"] = """
select maintenance_id, space_id, reporter_user_id, assigned_staff_user_id, problem_description, start_time, completion_time,
  maintenance_status, result_note from maintenance
"""
PARAMETERS["person_number"] = "select user_id + 1 as n from app_user"
PARAMETERS["room_number_source"] = "select space_id + 1 as n from space"
PARAMETERS["ship_day"] = "select cast(l_shipdate as date) as booking_date from lineitem"
WINDOW = ("1995-01-01 00:00:00", "1996-01-01 00:00:00")


def queue_tables(spark: SparkSession, folder: str, extra: dict[str, str] | None = None):
    t = derived_tables(spark, folder, extra)
    return t.replace(booking=lambda: conform(with_advisory_times(parameter(spark, folder, "queue", extra)), "booking"))


def _kept_booking(spark: SparkSession, folder: str) -> dict[str, str]:
    """The bookings, derived once for a job that reads them, and what follows from them, several times."""
    return kept(spark, folder, "booking")


def _approved(spark: SparkSession, folder: str, extra: dict[str, str]) -> DataFrame:
    return workflow.w05_approve_batch(queue_tables(spark, folder, extra), parameter(spark, folder, "approval", extra))


def _attempted(spark: SparkSession, folder: str) -> DataFrame:
    extra = _kept_booking(spark, folder)
    return workflow.w05_approve_attempts(queue_tables(spark, folder, extra), parameter(spark, folder, "attempt", extra))


def _new_requests(spark: SparkSession, folder: str) -> DataFrame:
    df = parameter(spark, folder, "new_request")
    return df.withColumnsRenamed({"span_start": "start", "span_end": "end"})


def _created(spark: SparkSession, folder: str):
    extra = _kept_booking(spark, folder)
    requests = parameter(spark, folder, "fresh_request", extra).withColumnsRenamed({"span_start": "start", "span_end": "end"})
    given = derived_tables(spark, folder, extra)
    return *workflow.w12_create_and_approve(given, requests, AS_OF), given


def _created_decisions(spark: SparkSession, folder: str) -> DataFrame:
    _, after, given = _created(spark, folder)
    before = given["booking_decision"].agg(F.max("decision_id")).scalar()
    made = after["booking_decision"].where(F.col("decision_id") > before)
    return made.select("decision_id", "booking_id", "decision_maker_user_id", "decision_time", "decision", "decision_note")


def _on_pending(job) -> Job:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        t = derived_tables(spark, folder)
        return job(t, workflow.pending_bookings(t))

    return run


def _on_outcomes(job, *args) -> Job:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        extra = _kept_booking(spark, folder)
        return job(queue_tables(spark, folder, extra), cut_lineage(_approved(spark, folder, extra)), *args)

    return run


def _on_changes(job, *args) -> Job:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        t = derived_tables(spark, folder)
        return job(t, workflow.w08_change_impact_level(t, parameter(spark, folder, "level_change")), *args)

    return run


def _phase_one(spark: SparkSession, folder: str):
    t = derived_tables(spark, folder)
    return t.replace(
        maintenance=lambda: parameter(spark, folder, "plain_maintenance"),
        booking_policy=lambda: t["booking_policy"].drop("auto_approval_enabled"),
        booking=lambda: derived(spark, folder, "select * from booking"),
    )


def _inserted(spark: SparkSession, folder: str) -> DataFrame:
    booking = derived_tables(spark, folder)["booking"]
    return insert_if_absent(booking.where("booking_status <> 'Completed'"), booking, NATURAL_KEYS["booking"])


def _generated(spark: SparkSession, folder: str):
    """Generated bookings over the given rooms, people and days, one per given booking number."""
    t = derived_tables(spark, folder)
    requesters = t["app_user"].where("role <> 'FacilityStaff'")
    days = generate.academic_days_from(parameter(spark, folder, "ship_day"))
    made = generate.bookings_from(derived(spark, folder, "select n from booking_base"), t["space"], requesters, days)
    return t.replace(booking=made)


def _generated_maintenance(t) -> DataFrame:
    return generate.generate_maintenance(t["space"], t["booking"], t["app_user"])


def _stored(spark: SparkSession, folder: str) -> str:
    """Write the derived tables to a new folder that all executors reach."""
    target = shared_dir(spark, "tables")
    write_tables(derived_tables(spark, folder), target)
    return target


def _versioned(table: str) -> Job:
    """A table after level changes: records replaced and history added to as one version."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        target, read = shared_dir(spark, "versions"), ("maintenance", "app_user", "impact_history")
        given = derived_tables(spark, folder)
        first = write_version(spark, target, 0, "load", replaced={name: given[name] for name in read})
        t = read_version(spark, target, first)
        changes = workflow.w08_change_impact_level(t, parameter(spark, folder, "level_change"))
        second = write_version(
            spark,
            target,
            first,
            "level changes",
            replaced={"maintenance": workflow.w08_maintenance_snapshot(t, changes)},
            appended={"impact_history": workflow.w08_impact_history(t, changes, AS_OF)},
        )
        return read_version(spark, target, second)[table]

    return run


def _stored_and_appended(spark: SparkSession, folder: str) -> DataFrame:
    target = _stored(spark, folder)
    t = load_tables(spark, target)
    changes = workflow.w08_change_impact_level(t, parameter(spark, folder, "level_change"))
    # append-only history beside the tables as they were
    append_rows(cut_lineage(workflow.w08_impact_history(t, changes, AS_OF)), "impact_history", target)
    return table_summary(load_tables(spark, target))


JOBS.update(
    {
        **{
            name: _on_tables(getattr(rules, name))
            for name in (
                "v01_requester_active",
                "v02_space_usable",
                "v03_booking_overlap",
                "v04_maintenance_block",
                "v05_missing_ack",
                "v06_bad_ack",
                "v07_session_authority",
                "v08_decision_authority",
                "v09_domain_checks",
                "v10_unique_keys",
                "v11_orphans",
                "v12_ack_completeness",
                "v13_status_changes",
                "v13_status_reached",
            )
        },
        "v11_orphans": lambda s, f: rules.v11_orphans(derived_tables(s, f, _kept_booking(s, f))),
        "v10_unique_keys": lambda s, f: rules.v10_unique_keys(derived_tables(s, f, _kept_booking(s, f))),
        "v04_maintenance_block_phase1": _on_tables(rules.v04_maintenance_block, mode="phase1"),
        "w01_validate_requests": lambda spark, folder: workflow.w01_validate_requests(
            derived_tables(spark, folder), _new_requests(spark, folder)
        ).withColumnsRenamed({"start": "span_start", "end": "span_end"}),
        "w12_create_and_approve": lambda s, f: _created(s, f)[0],
        "w12_create_and_approve_decisions": lambda s, f: _created_decisions(s, f),
        "w02_conflict_check": _on_pending(workflow.w02_conflict_check),
        "w03_resolve_policy": _on_pending(
            lambda t, pending: workflow.w03_resolve_policy(t, pending).select(
                "booking_id", "policy_id", "effective_start", "effective_end"
            )
        ),
        "w04_auto_approval_allowed": _on_pending(workflow.w04_auto_approval_allowed),
        "w05_approve_batch": lambda s, f: _approved(s, f, _kept_booking(s, f)),
        "w05_approve_attempts": _attempted,
        "w06_record_acks": _on_outcomes(workflow.w06_record_acks, AS_OF),
        "w07_record_decisions": _on_outcomes(workflow.w07_record_decisions, AS_OF),
        "w07_booking_snapshot": _on_outcomes(workflow.w07_booking_snapshot, AS_OF),
        "w08_change_impact_level": _on_changes(lambda t, outcomes: outcomes),
        "w08_impact_history": _on_changes(workflow.w08_impact_history, AS_OF),
        "w08_maintenance_snapshot": _on_changes(workflow.w08_maintenance_snapshot),
        "w09_escalation_impacts": _on_changes(workflow.w09_escalation_impacts, AS_OF),
        "w10_verify_approvals": lambda s, f: workflow.w10_verify_approvals(derived_tables(s, f), 1, *WINDOW)[0],
        "w10_verify_approvals_count": lambda s, f: workflow.w10_verify_approvals(derived_tables(s, f), 1, *WINDOW)[1],
        "w10_verify_approvals_pairs": lambda s, f: workflow.w10_verify_approvals(derived_tables(s, f), 1, *WINDOW)[2],
        "w11_verify_escalation": lambda s, f: workflow.w11_verify_escalation(
            derived_tables(s, f), parameter(s, f, "traced_pair")
        )[0],
        "w11_verify_escalation_impacts": lambda s, f: workflow.w11_verify_escalation(
            derived_tables(s, f), parameter(s, f, "traced_pair")
        )[1],
        "o01_load_tables": lambda s, f: table_summary(load_tables(s, _stored(s, f))),
        "o02_insert_if_absent": _inserted,
        "o03_upgrade_phase1": lambda s, f: upgrade_phase1(_phase_one(s, f))["maintenance"],
        "o03_upgrade_phase1_policy": lambda s, f: upgrade_phase1(_phase_one(s, f))["booking_policy"],
        "o03_upgrade_phase1_booking": lambda s, f: upgrade_phase1(_phase_one(s, f))["booking"],
        "o04_generate_users": lambda s, f: generate.users_from(parameter(s, f, "person_number"), 980),
        "o05_generate_spaces": lambda s, f: generate.spaces_from(parameter(s, f, "room_number_source")),
        "o06_generate_calendar": lambda s, f: generate.academic_days_from(parameter(s, f, "ship_day")),
        "o07_generate_bookings": lambda s, f: _generated(s, f)["booking"],
        "o08_generate_decisions": lambda s, f: generate.generate_decisions(
            _generated(s, f)["booking"], derived_tables(s, f)["app_user"]
        ),
        "o09_generate_maintenance": lambda s, f: _generated_maintenance(_generated(s, f)),
        "o10_generate_acks": lambda s, f: (
            lambda t: generate.generate_acks(t["booking"], _generated_maintenance(t))
        )(_generated(s, f)),
        "o10_generate_ack_times": lambda s, f: (
            lambda t: generate.with_ack_times(t["booking"], generate.generate_acks(t["booking"], _generated_maintenance(t)))
        )(_generated(s, f)),
        "o11_dataset_summary": lambda s, f: generate.dataset_summary(derived_tables(s, f))[0],
        "o11_dataset_summary_status": lambda s, f: generate.dataset_summary(derived_tables(s, f))[1],
        "o11_dataset_summary_maintenance": lambda s, f: generate.dataset_summary(derived_tables(s, f))[2],
        "o12_write_tables": _stored_and_appended,
        "o12_version_maintenance": _versioned("maintenance"),
        "o12_version_history": _versioned("impact_history"),
    }
)


# ---- a load into tables that hold a part, from tables that number everything in their own way

_HELD_ROWS = {
    "app_user": "account_status = 'Active'",
    "space": "current_status <> 'Retired'",
    "facility": "facility_type <> 'ASIA'",
    "space_facility": "space_id in (select space_id from held_space) and facility_id in (select facility_id from held_facility)",
    "booking_policy": "not auto_approval_enabled and (space_id is null or space_id in (select space_id from held_space))",
    "booking": "booking_status <> 'Completed' and requester_user_id in (select user_id from held_app_user) "
    "and space_id in (select space_id from held_space)",
    "booking_decision": "decision <> 'AutoApproved' and booking_id in (select booking_id from held_booking) "
    "and decision_maker_user_id in (select user_id from held_app_user)",
    "usage_session": "booking_id in (select booking_id from held_booking) "
    "and check_in_by_user_id in (select user_id from held_app_user)",
    "maintenance": "impact_level = 'advisory' and space_id in (select space_id from held_space) "
    "and reporter_user_id in (select user_id from held_app_user)",
}
_ADVISORY_TIMES = ("advisories_presented_at", "advisory_acknowledged_at")


def _renumbered(name: str) -> str:
    columns = [f.name for f in SCHEMAS[name] if f.name not in _ADVISORY_TIMES]
    return ", ".join(f"{c} * 3 + 11 as {c}" if c.endswith("_id") else c for c in columns)


PARAMETERS.update({f"held_{name}": f"select * from {name} where {_HELD_ROWS[name]}" for name in LOADED})
PARAMETERS.update({f"given_{name}": f"select {_renumbered(name)} from {name}" for name in LOADED})


def _loaded(table: str) -> Job:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        extra = PARAMETERS | (_kept_booking(spark, folder) if table in ("booking", "booking_decision", "usage_session") else {})

        def part(kind: str) -> Tables:
            def build(name: str):
                def rows() -> DataFrame:
                    df = derived(spark, folder, f"select * from {kind}_{name}", extra)
                    return conform(with_advisory_times(df) if name == "booking" else df, name)

                return rows

            return Tables({name: build(name) for name in LOADED})

        return load_absent(part("held"), part("given"))[table]

    return run


JOBS.update({f"o02_load_{name}": _loaded(name) for name in LOADED})

# ---- streams

# the approvals of the batch job by submission time; those of unknown bookings come first
PARAMETERS["command"] = """
select booking_id as command_id, 'approve' as kind, coalesce(submitted_at, date '1990-01-01' + INTERVAL '0' SECOND) as at, booking_id, decision_maker_user_id, is_auto, acknowledge,
  cast(null as bigint) as maintenance_id, cast(null as varchar(20)) as new_level, cast(null as varchar(20)) as note
from approval left join queue using (booking_id)
"""
PARAMETERS["timed_change"] = """
select maintenance_id * 2 as change_id, start_time + INTERVAL '1' HOUR as at, maintenance_id,
  case when maintenance_id % 3 = 0 then 'advisory' else 'out-of-service' end as new_level,
  case maintenance_id % 11 when 0 then cast(3 as bigint) else 50 end as user_id, 'first look' as note
from maintenance
union all select maintenance_id * 2 + 1, start_time + INTERVAL '2' HOUR, maintenance_id, 'out-of-service', 50, 'second look'
from maintenance
"""
# level changes among the approvals, some by people who may not, some of records that are closed or not there
PARAMETERS["level_command"] = """
select 10000000000 + maintenance_id * 2 + k as command_id, 'level' as kind, start_time - INTERVAL '1' DAY * (maintenance_id % 40 - 10 * k) as at,
  cast(null as bigint) as booking_id, case maintenance_id % 11 when 0 then cast(3 as bigint) else 50 end as decision_maker_user_id, false as is_auto, false as acknowledge,
  case when maintenance_id % 17 = 0 then maintenance_id + 1000000 else maintenance_id end as maintenance_id,
  case when (maintenance_id + k) % 3 = 0 then 'advisory' when maintenance_id % 23 = 0 then 'closed' else 'out-of-service' end as new_level, 'look' as note
from maintenance cross join (values (0), (1)) as turns(k)
"""


def _halves(df: DataFrame, order: str) -> list[DataFrame]:
    """The earlier and the later rows, cut at the middle time."""
    middle = df.agg(F.percentile_approx(epoch_second(order), 0.5)).scalar()
    return [df.where(epoch_second(order) <= middle), df.where(epoch_second(order) > middle)]


def _in_two_runs(df: DataFrame, order: str, schema: str, run) -> None:
    """Feed a stream the earlier rows, let it stop, and start it again on its checkpoint with the later ones."""
    spark = df.sparkSession
    source, checkpoint = shared_dir(spark, "source"), shared_dir(spark, "stream")
    for part in _halves(df, order):
        part.write.mode("append").option("compression", "zstd").parquet(source)
        run(spark.readStream.schema(schema).parquet(source), checkpoint)


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def _streamed(spark: SparkSession, folder: str, sources: tuple[str, ...], start) -> DataFrame:
    """The outcomes of the commands of ``sources``; what only led to them is removed as soon as it is not read any more."""
    before = shared_paths(spark)
    extra = _kept_booking(spark, folder)
    release_shuffles(spark)
    t, names = queue_tables(spark, folder, extra), _names(approvals.COMMANDS)
    standing = settle(spark, lambda: workflow.standing_facts(t))
    parts = [parameter(spark, folder, name, extra).select(*names) for name in sources]
    given = settle(spark, lambda: reduce(DataFrame.union, parts))
    del parts
    drop_paths(spark, [path for path in shared_paths(spark)[:-2] if path not in before])  # all but the facts and the commands
    out = shared_dir(spark, "outcomes")

    def run(stream: DataFrame, checkpoint: str) -> None:
        release_shuffles(spark)
        start(stream, t, standing, out, checkpoint)
        release_shuffles(spark)

    _in_two_runs(given, "at", approvals.COMMANDS, run)
    drop_paths(spark, [path for path in shared_paths(spark) if path not in (*before, out)])
    return spark.read.schema(approvals.OUTCOMES).parquet(out)


def _streamed_approvals(spark: SparkSession, folder: str) -> DataFrame:
    def start(stream: DataFrame, t, standing: DataFrame, out: str, checkpoint: str) -> None:
        approvals.run_available(approvals.s01_stream_approvals(stream, t, standing), out, checkpoint)

    return _streamed(spark, folder, ("command",), start).select("booking_id", "code", F.col("result").alias("decision"))


def _streamed_commands(spark: SparkSession, folder: str) -> DataFrame:
    found = _streamed(spark, folder, ("command", "level_command"), commands.run_commands)
    return found.select("command_id", "booking_id", "maintenance_id", "code", "result", "impacted_booking_id")


def _streamed_escalations(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    # every micro-batch reads the stored bookings and the known impacts again
    t = derived_tables(spark, folder, _kept_booking(spark, folder))
    t = t.replace(booking_impact=cut_lineage(t["booking_impact"]))
    changes = parameter(spark, folder, "timed_change").select(*_names(escalations.CHANGES))
    out = shared_dir(spark, "escalations")
    _in_two_runs(
        changes, "at", escalations.CHANGES, lambda stream, checkpoint: escalations.s02_stream_escalations(stream, t, out, checkpoint)
    )
    return escalations.written(spark, "impact_history", out), escalations.written(spark, "booking_impact", out)


def _streamed_flags(spark: SparkSession, folder: str) -> DataFrame:
    given = flags.arrivals_of(derived_tables(spark, folder))
    out = shared_dir(spark, "flags")
    _in_two_runs(given, "at", flags.ARRIVALS, lambda stream, checkpoint: flags.s03_stream_pending_flags(stream, out, checkpoint))
    return spark.read.schema(flags.FLAGS).parquet(f"{out}/flags").select("booking_id", "maintenance_id", "flagged_at")


JOBS.update(
    {
        "s01_stream_approvals": _streamed_approvals,
        "s01_stream_approvals_impacts": _streamed_commands,
        "w13_pending_flags": lambda s, f: flags.w13_pending_flags(derived_tables(s, f)),
        "s03_stream_pending_flags": _streamed_flags,
        "s02_stream_escalations": lambda s, f: _streamed_escalations(s, f)[1].select(
            "maintenance_id", "booking_id", "identified_at", "identified_by_user_id", "contact_status"
        ),
        "s02_stream_escalations_history": lambda s, f: _streamed_escalations(s, f)[0].select(
            "maintenance_id", "prior_impact_level", "new_impact_level", "changed_by_user_id", "changed_at", "change_note"
        ),
    }
)

# ---- checks of rows about to be added, made wrong on purpose

PARAMETERS["claimed_ack"] = """
select booking_id, maintenance_id from booking join maintenance
  on maintenance_id = booking_id % (select count(*) from maintenance)
union all select booking_id, maintenance_id from booking_impact
union all select booking_id, maintenance_id from advisory_ack
"""
PARAMETERS["claimed_session"] = """
select booking_id as usage_session_id, booking_id, (booking_id % 4) * 25 as check_in_by_user_id,
  case when booking_id % 3 > 0 then (booking_id % 5) * 25 end as check_out_by_user_id from booking
"""
PARAMETERS["claimed_decision"] = """
select booking_id as decision_id, booking_id % 150 as decision_maker_user_id from booking
"""
PARAMETERS["broken_booking"] = """
select booking_id, requester_user_id, space_id, requested_start_time,
  case when booking_id % 11 = 0 then requested_start_time else requested_end_time end as requested_end_time,
  case when booking_id % 13 = 0 then 'Party' when booking_id % 17 = 0 then null else purpose end as purpose,
  case when booking_id % 7 = 0 then 0 else expected_participants end as expected_participants,
  case when booking_id % 19 = 0 then 'Lost' else booking_status end as booking_status, submitted_at,
  case when booking_id % 23 > 0 then cancelled_at end as cancelled_at, cancelled_by_user_id,
  case when booking_id % 29 = 0 then repeat('x', 1001) else cancellation_note end as cancellation_note,
  case when booking_id % 2 = 0 then submitted_at end as advisories_presented_at,
  case when booking_id % 31 = 0 then submitted_at - INTERVAL '1' DAY when booking_id % 37 = 0 then submitted_at end as advisory_acknowledged_at
from booking
"""
PARAMETERS["broken_maintenance"] = """
select maintenance_id, space_id, reporter_user_id, assigned_staff_user_id, problem_description, start_time,
  case when maintenance_id % 3 = 0 then start_time - INTERVAL '1' HOUR else completion_time end as completion_time,
  case when maintenance_id % 7 = 0 then 'Forgotten' else maintenance_status end as maintenance_status,
  case when maintenance_id % 11 = 0 then 'mild' else impact_level end as impact_level,
  case when maintenance_id % 13 > 0 then result_note end as result_note
from maintenance
"""
PARAMETERS["doubled_user"] = """
select user_id, email from app_user
union all select user_id, upper(email) from app_user where role <> 'Student'
union all select user_id + 1000000000, email from app_user where account_status <> 'Active'
"""
PARAMETERS["stray_booking"] = """
select booking_id, case when booking_id % 5 = 0 then requester_user_id + 1000000000 else requester_user_id end as requester_user_id,
  space_id - 1 as space_id, cancelled_by_user_id * 2 as cancelled_by_user_id from booking
"""


def _on_batch(job, *names: str, **tables: str) -> Job:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        extra = _kept_booking(spark, folder) if job in (rules.v06_bad_ack, rules.v11_orphans) else None
        batch = (
            parameter(spark, folder, names[0], extra) if names else {t: parameter(spark, folder, n, extra) for t, n in tables.items()}
        )
        return job(derived_tables(spark, folder, extra), batch)

    return run


JOBS.update(
    {
        "v06_bad_ack_batch": _on_batch(rules.v06_bad_ack, "claimed_ack"),
        "v07_session_authority_batch": _on_batch(rules.v07_session_authority, "claimed_session"),
        "v08_decision_authority_batch": _on_batch(rules.v08_decision_authority, "claimed_decision"),
        "v09_domain_checks_batch": _on_batch(rules.v09_domain_checks, booking="broken_booking", maintenance="broken_maintenance"),
        "v10_unique_keys_batch": _on_batch(rules.v10_unique_keys, app_user="doubled_user"),
        "v13_status_reached_batch": _on_batch(rules.v13_status_reached, booking="broken_booking"),
        "v11_orphans_batch": _on_batch(rules.v11_orphans, booking="stray_booking"),
    }
)
