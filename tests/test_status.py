"""Status changes against a replay, event by event."""

from __future__ import annotations

import datetime as dt
import random

from roomgrid.plans import rules
from roomgrid.schema import STATUS_CHANGES
from small import at, booking, got, tables

ORDER = ["Approved", "Rejected", "CheckedIn", "Completed", "NoShow", "Cancelled"]
START = at("2030-01-07 08:00:00")


def replay(events):
    status, refused = "Pending", []
    for time, _, number, new in sorted((time, ORDER.index(new), number, new) for time, number, new in events):
        if new in STATUS_CHANGES.get(status, ()):
            status = new
        else:
            refused.append((time, number, status, new))
    return status, refused


def made(rng, bookings, instants, decisions):
    """Tables and, by booking, the events in them."""
    rows = {"booking": [], "booking_decision": [], "usage_session": []}
    events = {}
    when = lambda: START + dt.timedelta(minutes=rng.randrange(instants))
    for b in range(bookings):
        events[b] = own = []
        more = dict(cancelled_at=when(), cancelled_by_user_id=1) if rng.random() < 0.4 else {}
        rows["booking"].append(booking(b, "2030-02-01 08:00:00", "2030-02-01 09:00:00", status=rng.choice([*ORDER, "Pending"]), **more))
        own += [(more["cancelled_at"], b, "Cancelled")] if more else []
        for k in range(rng.randrange(decisions)):
            said, number, time = rng.choice(["Approved", "AutoApproved", "Rejected"]), b * 1000 + k, when()
            rows["booking_decision"].append(dict(decision_id=number, booking_id=b, decision_maker_user_id=1, decision_time=time, decision=said))
            own.append((time, number, "Rejected" if said == "Rejected" else "Approved"))
        for k in range(rng.randrange(3)):
            number, start, end = b * 1000 + 500 + k, when(), when() if rng.random() < 0.7 else None
            rows["usage_session"].append(
                dict(usage_session_id=number, booking_id=b, check_in_by_user_id=1, actual_start_time=start, initial_condition="", actual_end_time=end)
            )
            own.append((start, number, "CheckedIn"))
            own += [(end, number, "Completed")] if end else []
    return rows, events


def check(spark, rows, events):
    t = tables(spark, **rows)
    ends = {b: replay(own) for b, own in events.items()}
    assert got(rules.v13_status_changes(t)) == sorted((b, *r) for b, (_, refused) in ends.items() for r in refused)
    stated = {r["booking_id"]: r["booking_status"] for r in rows["booking"]}
    wrong = [(b, s, ends[b][0]) for b, s in stated.items() if s != ends[b][0] and (s, ends[b][0]) != ("NoShow", "Approved")]
    assert got(rules.v13_status_reached(t)) == sorted(wrong)
    return ends


def test_against_a_replay(spark):
    # few instants, so that many events are at one time
    ends = check(spark, *made(random.Random(4), 300, 12, 4))
    assert {status for status, _ in ends.values()} == {"Pending", "Approved", "Rejected", "CheckedIn", "Completed", "Cancelled"}


def test_one_booking_holds_most_events(spark):
    rows, events = made(random.Random(5), 20, 12, 3)
    late = [(START + dt.timedelta(hours=1, minutes=k), 100_000 + k, "Approved") for k in range(3000)]
    rows["booking_decision"] += [
        dict(decision_id=number, booking_id=3, decision_maker_user_id=1, decision_time=time, decision="Approved") for time, number, _ in late
    ]
    events[3] += late
    check(spark, rows, events)


def test_empty_tables(spark):
    t = tables(spark)
    assert rules.v13_status_changes(t).isEmpty() and rules.v13_status_reached(t).isEmpty()
