"""Streams of commands at many rooms: calls to the state store, rooms that share a key, what travels."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from roomgrid.plans import workflow
from roomgrid.session import cut_lineage, shared_dir
from roomgrid.streaming import approvals as stream
from roomgrid.streaming import commands
from roomgrid.streaming.approvals import _NONE, _without_null
from roomgrid.streaming.commands import _processor
from small import at, booking, person, policy, repair, room, tables
from test_growth import _Handle

DAY = 86_400
NAMES = [c.split()[0] for c in stream.OUTCOMES.split(", ")]


def command(n: int, space: int, kind: str = "approve", **given) -> dict:
    row = {
        "space_id": space, "place": 0, "command_id": n, "kind": kind, "at_second": n, "booking_id": _NONE, "maintenance_id": _NONE,
        "is_auto": False, "acknowledge": True, "new_level": None, "record_level": None, "record_from": _NONE, "record_until": _NONE,
        "raw_from": _NONE, "raw_until": _NONE, "wide_from": _NONE, "wide_until": _NONE, "taken": False, "met_records": None, "met_levels": None, "code": 0,
    }
    return row | given


def approval(n: int, space: int, booking: int, start: int, end: int) -> dict:
    return command(n, space, booking_id=booking, raw_from=start, raw_until=end, wide_from=start, wide_until=end)


def outage(n: int, space: int, record: int, start: int, end: int) -> dict:
    return command(n, space, "level", maintenance_id=record, new_level="out-of-service", record_level="advisory", record_from=start, record_until=end)


def run(handle, *rows) -> list[tuple]:
    processor = _processor(NAMES)
    processor.init(handle)
    frame = pd.DataFrame(list(rows))
    found = pd.concat(processor.handleInputRows((7,), iter([frame.iloc[:3], frame.iloc[3:]]), None))
    return [tuple(None if pd.isna(v) else v for v in r) for r in found.itertuples(index=False)]


def test_a_room_of_many_days_is_a_few_entries():
    handle = _Handle()
    found = run(handle, *[approval(n, 1, n, n * DAY, n * DAY + 3600) for n in range(100)])
    assert [r[NAMES.index("result")] for r in found] == ["Approved"] * 100
    assert handle.calls == ["write"]  # a write a day before
    handle.calls.clear()
    # a long booking and one at the end of each span: what the first run stored stands in the way
    last = commands.DAYS * DAY
    found = run(handle, approval(200, 1, 300, 99 * DAY, 99 * DAY + 60), approval(201, 1, 301, 100 * DAY, 4 * last), approval(202, 1, 302, 3 * last, 3 * last + 60), approval(203, 1, 5, 5 * DAY, 5 * DAY + 60))
    assert [r[NAMES.index("code")] for r in found] == [51041, None, 51041, 51036]
    assert handle.calls.count("read") == 1 and handle.calls.count("write") == 4


def test_rooms_of_one_key_do_not_see_each_other():
    handle = _Handle()
    first = run(
        handle, approval(4, 2, 20, 0, 3600), approval(1, 1, 10, 0, 3600), approval(3, 2, 21, 1800, 5400), approval(2, 1, 11, 1800, 5400),
        outage(5, 1, 77, 0, 9000), command(6, 2, code=51036, booking_id=10), command(7, 1, "level", code=51046, booking_id=10, maintenance_id=78),
    )
    assert sorted(first) == [
        (1, "approve", 1, 10, None, None, "Approved", None), (2, "approve", 1, 11, None, 51041, None, None),
        (3, "approve", 2, 21, None, None, "Approved", None), (4, "approve", 2, 20, None, 51041, None, None),
        (5, "level", 1, None, 77, None, "Changed", None), (5, "level", 1, None, 77, None, "Impact", 10),
        (6, "approve", 2, 10, None, 51036, None, None), (7, "level", 1, None, 78, 51046, None, None),
    ]
    # levels and reports are those of the room
    met = {"met_records": [77], "met_levels": ["advisory"]}
    later = run(handle, approval(10, 1, 12, 9 * DAY, 9 * DAY + 60) | met, approval(11, 2, 22, 9 * DAY, 9 * DAY + 60) | met, outage(12, 2, 77, 0, 9000), outage(13, 1, 77, 0, 9000))
    got = {(r[0], r[6], r[7]): r[5] for r in later}
    assert got == {(10, None, None): 51042, (11, "Approved", None): None, (12, "Changed", None): None, (12, "Impact", 21): None, (13, "Unchanged", None): None}


def many_rooms(spark):
    bookings = [booking(n, "2030-01-15 09:00:00", "2030-01-15 10:00:00", "Pending", space=1 + n % 40) for n in range(1, 121)]
    return tables(
        spark, app_user=[person(1), person(2, "FacilityStaff")], space=[room(n) for n in range(1, 41)], booking_policy=[policy(1)],
        booking=bookings, maintenance=[repair(1, "2030-02-15 09:30:00")],
    )


def test_rooms_dealt_to_few_keys_are_served_alike(spark, monkeypatch):
    monkeypatch.setattr(commands, "BUCKETS", 3)
    t = many_rooms(spark)
    rows = [(n, "approve", at("2029-12-10 08:00:00"), n, 2, False, True, None, None, None) for n in range(1, 121)]
    df = spark.createDataFrame(rows, stream.COMMANDS)
    source, out, checkpoint = (shared_dir(spark, n) for n in ("s", "o", "c"))
    standing = cut_lineage(workflow.standing_facts(t))
    for part in (df.where("command_id <= 60"), df.where("command_id > 60")):
        part.write.mode("append").parquet(source)
        commands.run_commands(spark.readStream.schema(stream.COMMANDS).parquet(source), t, standing, out, checkpoint)
    found = spark.read.parquet(out).collect()
    assert {r.command_id: r.code for r in found} == {n: None if n <= 40 else 51041 for n in range(1, 121)}
    assert all(r.space_id == 1 + r.command_id % 40 for r in found)


def test_refused_commands_and_decided_bookings_travel_light(spark):
    day = "2030-01-15 0{}:00:00"
    t = tables(
        spark, app_user=[person(1), person(2, "FacilityStaff")], space=[room(1)], booking_policy=[policy(1, auto=True)],
        booking=[booking(n, day.format(n), day.format(n + 1), status) for n, status in enumerate(("Pending", "Rejected", "Pending"), start=1)],
    )
    standing = workflow.standing_facts(t)
    assert not {"submitted_at", "requester_user_id", "purpose", "policy_id"} & set(standing.columns)
    facts = {r.booking_id: r for r in standing.collect()}
    assert [facts[n].gate for n in (1, 2, 3)] == [0, 51036, 0] and facts[2].requested_start_time is None and facts[3].effective_end is not None
    rows = [(n, "approve", at("2029-12-10 08:00:00"), n, maker, False, True, None, None, None) for n, maker in ((1, 2), (2, 2), (3, 9), (4, 2))]
    ready = stream.prepare(spark.createDataFrame(rows, stream.COMMANDS), t, standing)
    got = {r.command_id: r for r in ready.collect()}
    assert {n: r.code for n, r in got.items()} == {1: None, 2: 51036, 3: 51037, 4: 51034}
    assert got[3].raw_from is None and got[3].at_second is None and got[1].raw_until - got[1].raw_from == 3600
    assert got[1].wide_from <= got[1].raw_from and got[1].wide_until >= got[1].raw_until
    assert _without_null(ready).where(F.col("code") == 0).count() == 1
