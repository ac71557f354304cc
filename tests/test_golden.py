"""Hand-made cases with known answers: sample bookings, competing approvals, advisories and escalation."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roomgrid.plans import analytics, reports, rules, workflow
from roomgrid.schema import DOMAIN_RULES
from roomgrid.session import cut_lineage, shared_dir
from roomgrid.sources import generate
from roomgrid.sources.tables import load_tables, write_tables
from roomgrid.sources.upgrade import upgrade_phase1
from roomgrid.streaming import approvals as stream
from roomgrid.streaming.commands import run_commands
from small import approvals, at, booking, frame, got, person, policy, repair, room, tables

NOW = "2029-12-20 12:00:00"
PEOPLE = [person(1), person(2, "FacilityStaff"), person(3, "Lecturer"), person(4, status="Inactive"), person(5, "FacilityManager")]


def contest(spark, **more):
    """Two pending bookings that overlap, and one under an open advisory."""
    rows = dict(
        app_user=PEOPLE,
        space=[room(1), room(2, status="Retired")],
        booking=[
            booking(1, "2030-01-15 09:00:00", "2030-01-15 11:00:00", "Pending"),
            booking(2, "2030-01-15 10:00:00", "2030-01-15 12:00:00", "Pending"),
            booking(3, "2030-01-16 10:00:00", "2030-01-16 11:00:00", "Pending"),
        ],
        maintenance=[repair(1, "2030-01-16 09:00:00")],
    )
    rows.update(more)
    return tables(spark, **rows)


def codes(df):
    return {r.booking_id: r.code for r in df.collect()}


def test_one_of_two_competing_requests_wins(spark):
    t = contest(spark)
    out = workflow.w05_approve_batch(t, approvals(spark, (1, 2, False, False), (2, 2, False, False), (3, 2, False, False), (9, 2, False, False)))
    assert codes(out) == {1: None, 2: 51041, 3: 51043, 9: 51034}
    assert {r.booking_id: r.decision for r in out.collect()}[1] == "Approved"
    after = t.replace(booking=workflow.w07_booking_snapshot(t, out, NOW))
    listed, approved, pairs = workflow.w10_verify_approvals(after, 1, "2030-01-15 00:00:00", "2030-01-16 00:00:00")
    assert (listed.count(), approved.first()[0], pairs.count()) == (2, 1, 0)


def test_acknowledged_advisory_then_escalation(spark):
    t = contest(spark)
    out = cut_lineage(workflow.w05_approve_batch(t, approvals(spark, (3, 2, False, True))))
    assert codes(out) == {3: None}
    acks = workflow.w06_record_acks(t, out, NOW)
    assert got(acks.select("booking_id", "maintenance_id")) == [(3, 1)]
    after = t.replace(advisory_ack=cut_lineage(acks), booking=cut_lineage(workflow.w07_booking_snapshot(t, out, NOW)))
    kept = after["booking"].where("booking_id = 3").first()
    assert (kept.booking_status, kept.advisories_presented_at, kept.advisory_acknowledged_at) == ("Approved", at(NOW), at(NOW))
    assert workflow.w06_record_acks(after, out, NOW).count() == 0
    change = spark.createDataFrame([(1, "out-of-service", 2, "worse")], "maintenance_id bigint, new_level string, user_id bigint, note string")
    outcome = cut_lineage(workflow.w08_change_impact_level(after, change))
    impacts = cut_lineage(workflow.w09_escalation_impacts(after, outcome, NOW))
    assert got(impacts.select("maintenance_id", "booking_id", "contact_status")) == [(1, 3, "PendingContact")]
    again = after.replace(booking_impact=impacts)
    assert workflow.w09_escalation_impacts(again, outcome, NOW).count() == 0
    done = again.replace(maintenance=workflow.w08_maintenance_snapshot(after, outcome))
    counted, rows = workflow.w11_verify_escalation(done, impacts.select("booking_id", "maintenance_id"))
    assert got(counted) == [(3, 1, 1)] and got(rows) == [(1, 3, "PendingContact", "out-of-service")]


def test_gates_in_order(spark):
    day = "2030-02-0"
    rows = [
        booking(1, day + "1 09:00:00", day + "1 10:00:00", "Approved"),
        booking(2, day + "1 09:00:00", day + "1 10:00:00", "Pending"),
        booking(3, day + "2 09:00:00", day + "2 10:00:00", "Pending", who=4),
        booking(4, day + "2 09:00:00", day + "2 10:00:00", "Pending", people=99),
        booking(5, day + "2 09:00:00", day + "2 10:00:00", "Pending", space=2),
        booking(6, day + "3 09:00:00", day + "3 10:00:00", "Pending"),
        booking(7, day + "1 10:00:00", day + "1 10:30:00", "Pending"),
        booking(8, day + "4 09:00:00", day + "4 10:00:00", "Pending"),
        # under an outage it takes no time, and it hears first that 10 took it
        booking(9, day + "5 09:00:00", day + "5 11:00:00", "Pending", submitted="2029-12-02 08:00:00"),
        booking(10, day + "5 08:00:00", day + "5 10:00:00", "Pending"),
        booking(11, day + "5 10:30:00", day + "5 11:00:00", "Pending", submitted="2029-12-03 08:00:00"),
    ]
    t = contest(
        spark, booking=rows, maintenance=[repair(1, day + "5 10:30:00", level="out-of-service")], booking_policy=[policy(1, pre=15)]
    )
    asked = [(i, 3 if i == 8 else 2, i == 6, True) for i in range(1, 12)]
    assert codes(workflow.w05_approve_batch(t, approvals(spark, *asked))) == {
        1: 51036, 2: 51041, 3: 51038, 4: 51039, 5: 51039, 6: 51040, 7: 51041, 8: 51037, 9: 51041, 10: None, 11: 51042,
    }


def test_two_approvals_of_one_booking_are_an_error(spark):
    with pytest.raises(Exception, match="more than one row in the batch"):
        workflow.w05_approve_batch(contest(spark), approvals(spark, (1, 2, False, False), (1, 5, False, False)))


def test_several_approvals_of_one_booking(spark):
    """The first that breaks no rule approves; the booking counts for others from its own place on."""
    t = contest(spark)
    rows = [
        (3, 0, 3, False, True), (3, 1, 2, False, False), (3, 2, 2, False, True), (3, 3, 2, False, True), (3, 4, 3, False, True),
        (1, 1, 2, False, False), (2, 1, 3, False, False), (2, 2, 2, False, False), (77, 0, 2, False, False), (77, 5, 2, False, False), (None, 1, 2, False, False),
    ]
    schema = "booking_id long, attempt int, decision_maker_user_id long, is_auto boolean, acknowledge boolean"
    found = workflow.w05_approve_attempts(t, spark.createDataFrame(rows, schema)).collect()
    assert {(r.booking_id, r.attempt): r.code for r in found} == {
        (3, 0): 51037, (3, 1): 51043, (3, 2): None, (3, 3): 51036, (3, 4): 51036,
        (1, 1): None, (2, 1): 51037, (2, 2): 51041, (77, 0): 51034, (77, 5): 51034, (None, 1): 51034,
    }
    assert {(r.booking_id, r.attempt) for r in found if r.decision} == {(3, 2), (1, 1)} and len(found) == len(rows)


def _by_room(source, t, standing, out, checkpoint):
    stream.run_available(stream.s01_stream_approvals(source, t, standing), out, checkpoint)


@pytest.mark.parametrize("run", [_by_room, run_commands])
def test_stream_sees_escalation_and_earlier_approvals(spark, run):
    t = contest(spark)
    rows = [
        (1, "approve", at("2029-12-10 08:00:00"), 1, 2, False, False, None, None, None),
        (2, "approve", at("2029-12-10 09:00:00"), 2, 2, False, False, None, None, None),
        (3, "level", at("2029-12-10 09:30:00"), None, 2, None, None, 1, "out-of-service", "worse"),
        (4, "approve", at("2029-12-10 10:00:00"), 3, 2, False, True, None, None, None),
        (5, "level", at("2029-12-10 10:30:00"), None, 2, None, None, 1, "advisory", "better"),
        (6, "approve", at("2029-12-10 11:00:00"), 3, 2, False, True, None, None, None),
        (7, "level", at("2029-12-10 11:30:00"), None, 2, None, None, 1, "out-of-service", "worse"),
        (8, "approve", at("2029-12-10 12:00:00"), 1, 2, False, False, None, None, None),
    ]
    df = spark.createDataFrame(rows, stream.COMMANDS)
    source, out, checkpoint = (shared_dir(spark, n) for n in ("s", "o", "c"))
    standing = cut_lineage(workflow.standing_facts(t))
    for part in (df.where("command_id <= 5"), df.where("command_id > 5")):
        part.write.mode("append").parquet(source)
        run(spark.readStream.schema(stream.COMMANDS).parquet(source), t, standing, out, checkpoint)
    result = spark.read.parquet(out)
    assert {r.command_id: r.code for r in result.where("kind = 'approve'").collect()} == {1: None, 2: 51041, 4: 51042, 6: None, 8: 51036}
    assert got(result.where("result = 'Impact'").select("command_id", "impacted_booking_id")) == [(7, 3)]


def test_stream_reports_long_bookings_and_open_records_once(spark):
    """Intervals over many days and records without an end."""
    t = tables(
        spark, app_user=[person(1), person(2, "FacilityStaff")], space=[room(1)], booking_policy=[policy(1)],
        booking=[
            booking(1, "2030-01-05 09:00:00", "2030-01-25 10:00:00", "Pending"), booking(2, "2030-01-20 09:00:00", "2030-01-20 10:00:00", "Pending"),
            booking(3, "2030-02-05 09:00:00", "2030-02-05 10:00:00", "Pending"), booking(4, "2030-01-25 10:00:00", "2030-01-25 11:00:00", "Pending"),
        ],
        maintenance=[repair(1, "2030-01-25 09:30:00")],
    )
    rows = [(k, "approve", at(f"2029-12-10 0{k}:00:00"), k, 2, False, True, None, None, None) for k in (1, 2, 3, 4)]
    rows += [(k, "level", at(f"2029-12-11 0{k}:00:00"), None, 2, None, None, 1, level, "x") for k, level in ((5, "out-of-service"), (6, "advisory"), (7, "out-of-service"))]
    df = spark.createDataFrame(rows, stream.COMMANDS)
    source, out, checkpoint = (shared_dir(spark, n) for n in ("s", "o", "c"))
    standing = cut_lineage(workflow.standing_facts(t))
    for part in (df.where("command_id <= 3"), df.where("command_id in (4, 5)"), df.where("command_id > 5")):
        part.write.mode("append").parquet(source)
        run_commands(spark.readStream.schema(stream.COMMANDS).parquet(source), t, standing, out, checkpoint)
    result = spark.read.parquet(out)
    assert {r.command_id: r.code for r in result.where("kind = 'approve'").collect()} == {1: None, 2: 51041, 3: None, 4: None}
    assert got(result.where("kind = 'level'").select("command_id", "result", "impacted_booking_id")) == [
        (5, "Changed", None), (5, "Impact", 1), (5, "Impact", 3), (5, "Impact", 4), (6, "Changed", None), (7, "Changed", None),
    ]


def test_stream_with_lead_rule_forgets_what_is_past(spark):
    t = contest(spark, maintenance=[])
    columns = [c.split()[0] for c in stream.COMMANDS.split(", ")]

    def ask(command_id, when, booking_id):
        row = dict(command_id=command_id, kind="approve", at=at(when), booking_id=booking_id, decision_maker_user_id=2, is_auto=False, acknowledge=True)
        return tuple(row.get(c) for c in columns)

    runs = [
        [ask(1, "2029-12-10 08:00:00", 1), ask(2, "2030-01-16 10:30:00", 3)],  # the second reaches back
        [ask(3, "2030-01-16 11:00:00", 1), ask(4, "2030-01-15 09:59:00", 2)],
    ]
    source, out, checkpoint = (shared_dir(spark, n) for n in ("s", "o", "c"))
    standing = cut_lineage(workflow.standing_facts(t))
    for rows in runs:
        spark.createDataFrame(rows, stream.COMMANDS).write.mode("append").parquet(source)
        commands = spark.readStream.schema(stream.COMMANDS).parquet(source)
        outcomes = stream.s01_stream_approvals(commands, t, standing, lead_rule=True, delay="3 days")
        stream.run_available(outcomes, out, checkpoint)
    # booking 1 stays known as approved, and within the delay its time stays taken
    assert {r.command_id: r.code for r in spark.read.parquet(out).collect()} == {1: None, 2: stream.LEAD_CODE, 3: 51036, 4: 51041}


def test_session_and_room_reports(spark):
    start, end = "2026-07-25 13:00:00", "2026-07-25 17:00:00"
    t = tables(
        spark,
        app_user=PEOPLE,
        space=[room(1, 180), room(2, 18), room(3, 36, "UnderMaintenance")],
        booking=[booking(1, start, end, "Completed", people=120), booking(2, "2026-08-10 09:00:00", "2026-08-10 11:00:00")],
        usage_session=[
            dict(
                usage_session_id=1, booking_id=1, check_in_by_user_id=2, actual_start_time=at("2026-07-25 12:50:00"),
                initial_condition="good", check_out_by_user_id=2, actual_end_time=at("2026-07-25 17:20:00"), final_condition="clean",
            )
        ],
    )
    row = reports.r06_session_variance(t).first()
    assert (row.planned_minutes, row.actual_minutes, row.checkout_variance_minutes) == (240, 270, 20)
    used = {r.space_code: (r.completed_hours, r.scheduled_utilization_pct) for r in reports.r03_space_utilization(t, "2026-08-01 00:00:00").collect()}
    assert used == {"R1": (Decimal("4.00"), Decimal("0.37")), "R2": (0, 0), "R3": (0, 0)}
    asked = spark.createDataFrame(
        [(1, at("2026-08-10 10:00:00"), at("2026-08-10 12:00:00"), 10), (2, at("2026-08-10 11:00:00"), at("2026-08-10 12:00:00"), 10)],
        "request_id bigint, start timestamp_ntz, end timestamp_ntz, participants int",
    )
    assert [(r.request_id, r.space_code) for r in reports.r02_availability_search(t, asked).collect()] == [(1, "R2"), (2, "R2"), (2, "R1")]
    nothing = spark.createDataFrame([], "request_id bigint, facility_name string, facility_type string")
    found = analytics.a03_room_finder(t, asked, nothing).collect()
    assert [(r.request_id, r.space_code, r.active_advisory_count, r.active_advisories) for r in found] == [
        (1, "R2", 0, None), (2, "R2", 0, None), (2, "R1", 0, None),
    ]
    with pytest.raises(Exception, match="51300"):
        analytics.a03_room_finder(t, asked.withColumn("end", F.col("start")), nothing).collect()


def test_every_domain_rule_can_fail(spark):
    when = at("2030-01-01 09:00:00")
    before = when - dt.timedelta(days=1)
    broken = dict(
        app_user=[dict(user_id=1, role="King", account_status="Gone")],
        space=[dict(space_id=1, space_type="Cave", capacity=0, current_status="Lost")],
        space_facility=[dict(space_id=1, facility_id=1, quantity=0)],
        booking_policy=[dict(policy_id=1, applicable_role="King", applicable_purpose="Party", minimum_lead_minutes=-1)],
        booking=[
            dict(
                booking_id=1, requested_start_time=when, requested_end_time=when, expected_participants=0, purpose="Party",
                booking_status="Lost", cancelled_at=when, advisory_acknowledged_at=before, advisories_presented_at=when,
            )
        ],
        booking_decision=[dict(decision_id=1, decision="Maybe", rejection_reason="no")],
        usage_session=[dict(usage_session_id=1, actual_start_time=when, actual_end_time=before)],
        maintenance=[dict(maintenance_id=1, maintenance_status="Odd", impact_level="mild", start_time=when, completion_time=before)],
        impact_history=[dict(impact_history_id=1, prior_impact_level="mild", new_impact_level="mild")],
        booking_impact=[dict(maintenance_booking_impact_id=1, contact_status="Never", resolution="Ignored")],
    )
    t = tables(spark, **broken)
    found = {r.rule for r in rules.v09_domain_checks(t).collect()}
    named = {name for conditions in DOMAIN_RULES.values() for name in conditions}
    assert len(named) == 28 and named <= found
    assert "booking.purpose required" not in found and "booking.space_id required" in found


def test_upgrade_is_repeatable(spark):
    t = contest(spark)
    old = t.replace(maintenance=t["maintenance"].drop("impact_level"), booking=t["booking"].drop("advisories_presented_at"))
    once = upgrade_phase1(old)
    assert [r.impact_level for r in once["maintenance"].collect()] == ["out-of-service"]
    twice = upgrade_phase1(once)
    assert all(sorted(map(str, once[n].collect())) == sorted(map(str, twice[n].collect())) for n in ("maintenance", "booking", "booking_policy"))


def test_generated_year(spark):
    users, spaces = generate.generate_users(spark), generate.generate_spaces(spark, generate.space_count(100_000))
    with pytest.raises(ValueError, match="51200"):
        generate.generate_bookings(spark, 99_999, spaces, users, limits=generate.BENCHMARK)
    made = cut_lineage(generate.generate_bookings(spark, 100_000, spaces, users))
    shares = {r.booking_status: r["count"] for r in made.groupBy("booking_status").count().collect()}
    assert shares == {"Approved": 70000, "Completed": 10000, "NoShow": 5000, "Cancelled": 8000, "Rejected": 5000, "Pending": 2000}
    assert spaces.count() == 84 and generate.academic_days(spark).count() == 727
    whole = made.agg(F.min("requested_start_time"), F.max("requested_end_time")).first()
    assert whole[0] == dt.datetime(2023, 1, 2, 9) and whole[1].date() == dt.date(2025, 10, 13)
    repairs = generate.generate_maintenance(spaces, made, users)
    assert generate.generate_acks(made, repairs).count() == 84
    assert reports.r07_overlapping_bookings(tables(spark).replace(booking=made, space=spaces)).count() == 0


def test_tables_come_back_as_written(spark):
    t = contest(spark)
    folder = shared_dir(spark, "tables")
    write_tables(t, folder)
    back = load_tables(spark, folder)
    assert all(back[n].dtypes == frame(spark, n, []).dtypes for n in back)
    assert got(back["booking"]) == got(t["booking"])
    with pytest.raises(Exception, match="(?i)exists"):
        write_tables(t, folder)
