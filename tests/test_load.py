"""The rerunnable load, on hand-made tables."""

from __future__ import annotations

import pytest

from roomgrid.sources.load import LOADED, load_absent
from roomgrid.schema import NATURAL_KEYS
from small import at, booking, got, person, policy, repair, room, tables

DAY = "2030-01-07"


def _hour(h):
    return f"{DAY} {h:02}:00:00"


def held(spark):
    return tables(
        spark,
        app_user=[person(1), person(7, "FacilityStaff")],
        space=[room(4)],
        facility=[dict(facility_id=2, facility_name="Projector", facility_type="AV")],
        booking_policy=[policy(5)],
        booking=[booking(30, _hour(8), _hour(9), who=1, space=4), booking(31, _hour(8), _hour(10), who=1, space=4)],
    )


def given(spark, **changed):
    """The same people, rooms and things under other numbers, with some new ones."""
    rows = dict(
        app_user=[person(1) | dict(user_id=100), person(2) | dict(user_id=50), person(7) | dict(user_id=101)],
        space=[room(4) | dict(space_id=1), room(9) | dict(space_id=4)],
        facility=[
            dict(facility_id=8, facility_name="Projector", facility_type="AV", description="other text"),
            dict(facility_id=9, facility_name="Projector", facility_type="Loan"),
        ],
        space_facility=[dict(space_id=1, facility_id=8, quantity=1), dict(space_id=4, facility_id=9, quantity=2)],
        booking_policy=[policy(1), policy(2, space=1), policy(3, space=1, role="TA"), policy(4, role="TA"), policy(6, role="TA", post=9)],
        booking=[
            booking(1, _hour(8), _hour(9), who=100, space=1),
            booking(2, _hour(8), _hour(9), who=50, space=4),
            booking(3, _hour(11), _hour(12), who=100, space=4, status="Cancelled", cancelled_by_user_id=101, cancellation_note="ill"),
            booking(4, _hour(11), _hour(13), who=100, space=1),
        ],
        booking_decision=[
            dict(decision_id=k, booking_id=b, decision_maker_user_id=101, decision_time=at(_hour(7)), decision="Approved")
            for k, b in ((1, 3), (2, 1))
        ],
        usage_session=[
            dict(usage_session_id=1, booking_id=2, check_in_by_user_id=101, actual_start_time=at(_hour(8)), initial_condition="clean")
        ],
        maintenance=[repair(1, _hour(8), space=4) | dict(reporter_user_id=100)],
    )
    return tables(spark, **{**rows, **changed})


def test_rows_are_found_by_natural_key_and_references_follow(spark):
    t = load_absent(held(spark), given(spark))
    assert got(t["app_user"].select("user_id", "email")) == [(1, "p1@example.org"), (7, "p7@example.org"), (8, "p2@example.org")]
    assert got(t["space"].select("space_id", "space_code")) == [(4, "R4"), (5, "R9")]
    assert got(t["facility"].select("facility_id", "facility_type", "description")) == [(2, "AV", None), (3, "Loan", None)]
    assert got(t["space_facility"].select("space_id", "facility_id", "quantity")) == [(4, 2, 1), (5, 3, 2)]
    # the policy for everything is held; numbers follow the key, NULL first; of the two for TA the smaller id
    scopes = t["booking_policy"].where("policy_id > 5").orderBy("policy_id").select("policy_id", "space_id", "applicable_role", "post_buffer_minutes")
    assert [tuple(r) for r in scopes.collect()] == [(6, None, "TA", 0), (7, 4, None, 0), (8, 4, "TA", 0)]
    # the held booking that shares its key with another is known by the smaller id; a second start at eleven is the same booking
    new = t["booking"].where("booking_id > 31").select("booking_id", "requester_user_id", "space_id", "cancelled_by_user_id")
    assert got(new.na.fill(-1)) == [(32, 1, 5, 7), (33, 8, 5, -1)]
    assert got(t["booking_decision"].select("decision_id", "booking_id", "decision_maker_user_id")) == [(1, 30, 7), (2, 32, 7)]
    assert got(t["usage_session"].select("usage_session_id", "booking_id", "check_in_by_user_id")) == [(1, 33, 7)]
    assert got(t["maintenance"].select("maintenance_id", "space_id", "reporter_user_id")) == [(1, 5, 1)]


def test_a_second_run_adds_nothing(spark):
    once = load_absent(held(spark), given(spark))
    twice = load_absent(once, given(spark))
    assert all(got(twice[name]) == got(once[name]) for name in LOADED)
    assert set(LOADED) == set(NATURAL_KEYS)


def test_empty_sides(spark):
    t, nothing = given(spark), tables(spark)
    assert all(load_absent(nothing, nothing)[name].isEmpty() for name in LOADED)
    assert got(load_absent(held(spark), nothing)["booking"]) == got(held(spark)["booking"])
    assert got(load_absent(nothing, t)["booking"].select("booking_id", "requester_user_id", "space_id")) == [(1, 1, 1), (2, 1, 2), (3, 2, 2)]


def test_rows_without_their_parent_and_doubled_ids_are_errors(spark):
    lost = given(spark, booking=[booking(1, _hour(8), _hour(9), who=100, space=77)])
    with pytest.raises(Exception, match="booking.space_id names no row of the given space: 77"):
        load_absent(held(spark), lost)["booking"].collect()
    doubled = given(spark, space=[room(4) | dict(space_id=1), room(9) | dict(space_id=1)])
    with pytest.raises(Exception, match="space is given two natural keys under one id: 1"):
        load_absent(held(spark), doubled)["booking"].collect()


def test_one_person_and_room_hold_most_bookings(spark):
    starts = [f"2030-{m:02}-{d:02} {h:02}:00:00" for m in range(1, 13) for d in range(1, 29) for h in range(24)]
    rows = [booking(k, s, s, who=100 if k % 10 else 50, space=1) for k, s in enumerate(starts)]
    t = load_absent(held(spark), given(spark, booking=rows))
    whole = t["booking"].where("booking_id > 31").groupBy("requester_user_id").count()
    # the held booking at eight o'clock is among the 8,064, under its own person
    taken = sum(1 for k, s in enumerate(starts) if k % 10 and s == _hour(8))
    assert got(whole) == [(1, sum(1 for k in range(len(starts)) if k % 10) - taken), (8, sum(1 for k in range(len(starts)) if not k % 10))]
    assert t["booking"].select("booking_id").distinct().count() == t["booking"].count()
