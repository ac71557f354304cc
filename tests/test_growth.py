"""Work that grows with the input, not faster: shuffles, hot keys of streams, calls to the state store."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from roomgrid import session
from roomgrid.operators.slices import neighbour
from roomgrid.operators.upsert import absent_rows
from roomgrid.plans import catalog, workflow
from roomgrid.plans.catalog import JOBS
from roomgrid.sources import fixtures
from roomgrid.sources.fixtures import derived
from roomgrid.sources.load import _Load
from roomgrid.streaming import approvals as stream
from roomgrid.streaming.approvals import _NONE
from roomgrid.streaming.commands import _processor
from small import at, person, policy, repair, room, tables

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_dealt_once(spark):
    text = plan(derived(spark, FOLDER, "select * from booking"))
    assert "hashpartitioning(l_orderkey" in text
    assert not [line for line in text.splitlines() if "hashpartitioning(l_orderkey" in line and "l_linenumber" in line.split("hashpartitioning", 1)[1].split(")")[0]]


def test_rows_of_a_scan_travel_once(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("i"))
        text = plan(neighbour(df, ["k"], ["i"], "i", "before"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_bookings_are_derived_once_for_references(spark):
    assert "hashpartitioning(l_orderkey" not in plan(JOBS["v11_orphans"](spark, FOLDER))


def test_commands_without_a_room_are_dealt_to_many_places(spark):
    t = tables(spark, app_user=[person(1), person(2, "FacilityStaff")], space=[room(1)], booking_policy=[policy(1)])
    t = t.replace(maintenance=tables(spark, maintenance=[repair(1, "2030-01-15 09:30:00")])["maintenance"])
    when = at("2030-01-02 08:00:00")
    asked = [(n, "approve", when, -n, 2, False, True, None, None, None) for n in range(1, 301)]
    looked = [(1000 + n, "level", when, None, 2, None, None, 5000 + n % 100, "advisory", "look") for n in range(300)]
    ready = stream.prepare(spark.createDataFrame(asked + looked, stream.COMMANDS), t, workflow.standing_facts(t))
    rows = ready.select("command_id", "space_id", "place", "maintenance_id", "code").collect()
    assert len(rows) == 600 and {r.space_id for r in rows} == {-1} and {r.code for r in rows} == {51034, 51046}
    assert len({r.place for r in rows if r.maintenance_id is None}) > 200
    of_record = {r.maintenance_id: set() for r in rows if r.maintenance_id}
    for r in rows:
        if r.maintenance_id:
            of_record[r.maintenance_id].add(r.place)
    assert len(of_record) == 100 and all(len(places) == 1 for places in of_record.values())


class _Entries:
    """A state variable that counts its calls."""

    def __init__(self, calls: list):
        self.rows, self.value, self.calls = {}, None, calls

    def getValue(self, key):
        self.calls.append("read")
        return self.rows.get(key)

    def containsKey(self, key):
        self.calls.append("read")
        return key in self.rows

    def updateValue(self, key, value):
        self.calls.append("write")
        self.rows[key] = tuple(tuple(x) if isinstance(x, list) else x for x in value)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class _Handle:
    def __init__(self):
        self.calls, self.made = [], {}

    def getMapState(self, name, *_):
        return self.made.setdefault(name, _Entries(self.calls))

    def getValueState(self, name, *_):
        return self.made.setdefault(name, _Entries([]))


def test_a_room_reads_and_writes_each_entry_once_a_batch():
    import pandas as pd

    names = [c.split()[0] for c in stream.OUTCOMES.split(", ")]

    def approve(n: int, booking: int, start: int, end: int) -> dict:
        return {
            "command_id": n, "kind": "approve", "at_second": n, "booking_id": booking, "maintenance_id": _NONE, "is_auto": False, "acknowledge": True,
            "new_level": None, "record_level": None, "record_from": _NONE, "record_until": _NONE, "raw_from": start, "raw_until": end,
            "wide_from": start, "wide_until": end, "taken": False, "met_records": None, "met_levels": None, "code": 0,
        }

    def outage(n: int, start: int, end: int) -> dict:
        return approve(n, _NONE, _NONE, _NONE) | {
            "kind": "level", "maintenance_id": 77, "new_level": "out-of-service", "record_level": "advisory", "record_from": start, "record_until": end,
        }

    handle, found = _Handle(), []

    def batch(*rows) -> None:
        processor = _processor(names)
        processor.init(handle)
        for frame in processor.handleInputRows((1, 0), iter([pd.DataFrame(list(rows))]), None):
            found.extend((r.command_id, None if pd.isna(r.code) else r.code, r.result, None if pd.isna(r.impacted_booking_id) else r.impacted_booking_id) for r in frame.itertuples())

    hour = 3600
    batch(*[approve(n, 100 + n, n * hour, (n + 1) * hour) for n in range(10)], approve(20, 105, 5 * hour, 6 * hour), approve(21, 300, 5 * hour, 6 * hour))
    assert [code for n, code, *_ in found if n < 10] == [None] * 10
    assert [code for n, code, *_ in found if n >= 20] == [51036, 51041]
    assert handle.calls == ["write"]  # one day
    found.clear(), handle.calls.clear()
    # a later run: the day is read once, the record once
    batch(approve(30, 103, 3 * hour, 4 * hour), approve(31, 301, 9 * hour, 11 * hour), approve(32, 302, 12 * hour, 13 * hour), outage(33, 0, 2 * hour))
    assert found == [(30, 51036, None, None), (31, 51041, None, None), (32, None, "Approved", None), (33, None, "Changed", None), (33, None, "Impact", 100), (33, None, "Impact", 101)]
    assert handle.calls.count("read") == 1 + 1 + 2 and handle.calls.count("write") == 1 + 1 + 2


def test_more_lines_are_dealt_to_more_places(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "DEALT_BYTES", 2000)
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = plan(derived(spark, FOLDER, "select * from booking"))
    parts = {int(n) for n in re.findall(r"hashpartitioning\([lo]_orderkey#\w+, (\d+)\)", text)}
    assert len(parts) == 1 and parts.pop() > few and "REPARTITION_BY_NUM" in text


def test_bookings_of_escalations_are_stored_once(spark, monkeypatch):
    sizes, given = [], catalog.cut_lineage

    def counted(df):
        sizes.append(set(df.columns))
        return given(df)

    monkeypatch.setattr(catalog, "cut_lineage", counted)
    monkeypatch.setattr(catalog, "_in_two_runs", lambda *_: (_ for _ in ()).throw(StopIteration))
    try:
        catalog._streamed_escalations(spark, FOLDER)
    except StopIteration:
        pass
    assert sizes and not [columns for columns in sizes if "requested_start_time" in columns]


def test_absent_rows_travel_once(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = spark.createDataFrame([(1, None, "b", 5), (2, None, "a", 5), (3, 7, "c", 5), (4, 8, None, 5), (5, 8, "d", None)], "id long, k long, v string, w long")
        target = spark.createDataFrame([(9, 7, "z", 5), (10, 7, "y", 5)], "id long, k long, v string, w long")
        df = absent_rows(target, source, ["k", "w"])
        assert "Join" not in plan(df)
        assert df.columns == source.columns and sorted(df.collect()) == [(1, None, "b", 5), (4, 8, None, 5), (5, 8, "d", None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_rows_without_a_reference_do_not_travel(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        load = _Load({}, {})
        load._ids["app_user"] = spark.createDataFrame([(1, 10), (2, 20)], "_source_id long, _target_id long")
        rows = spark.createDataFrame([(1, 2), (2, None), (3, 1), (3, None)], "booking_id long, cancelled_by_user_id long")
        df = load._referring(rows, "booking", "cancelled_by_user_id", "app_user")
        assert sorted(df.collect(), key=str) == [(1, 20), (2, None), (3, 10), (3, None)]
        assert "Union" in plan(df) and "isnotnull(cancelled_by_user_id" in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_stored_steps_are_dealt_finely(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with session.finely_dealt(spark):
        text = plan(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count())
        assert f", {session.FINE})" in text
    assert spark.conf.get(name, None) is None
    spark.conf.set(name, "9")
    try:
        with session.finely_dealt(spark):
            assert spark.conf.get(name) == "9"
        assert spark.conf.get(name) == "9"
    finally:
        spark.conf.unset(name)
