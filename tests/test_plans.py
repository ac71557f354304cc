"""The plans keep what the jobs promise: no products, pruned scans, pushed filters."""

from __future__ import annotations

import pytest

from roomgrid.plans import analytics, catalog, reports, rules, workflow
from roomgrid.plans.catalog import AS_OF, SEMESTER, parameter, room_requests
from roomgrid.session import shared_dir
from roomgrid.sources.fixtures import derived_tables
from roomgrid.sources.tables import load_tables, write_tables

FOLDER = "/root/testdata/sf0.001"
JOBS = {
    "r02": lambda t, q, w: reports.r02_availability_search(t, q),
    "r07": lambda t, q, w: reports.r07_overlapping_bookings(t),
    "r08": lambda t, q, w: reports.r08_booking_maintenance_conflicts(t),
    "r10": lambda t, q, w: reports.r10_booking_gaps(t),
    "r19": lambda t, q, w: reports.r19_effective_policy(t),
    "a01": lambda t, q, w: analytics.a01_semester_hours(t, *SEMESTER),
    "a03": lambda t, q, w: analytics.a03_room_finder(t, q, w),
    "v03": lambda t, q, w: rules.v03_booking_overlap(t),
    "v04": lambda t, q, w: rules.v04_maintenance_block(t),
    "w02": lambda t, q, w: workflow.w02_conflict_check(t, workflow.pending_bookings(t)),
}


@pytest.fixture(scope="module")
def stored(spark):
    folder = shared_dir(spark, "plans")
    write_tables(derived_tables(spark, FOLDER), folder)
    return load_tables(spark, folder)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("name", list(JOBS))
def test_no_products(spark, stored, name, broadcast):
    """Also where no side is small enough to be sent around."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept if broadcast else "-1")
    try:
        text = plan(JOBS[name](stored, room_requests(spark, FOLDER), parameter(spark, FOLDER, "room_wish")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["o07_generate_bookings", "r05_capacity_demand", "r12_requester_reliability", "w07_record_decisions", "w08_impact_history"])
def test_whole_tables_are_numbered_by_ranges(spark, name):
    """No constant key that would put all rows into one group, and no row of cut points to loop over."""
    text = plan(catalog.JOBS[name](spark, FOLDER))
    assert "_all" not in text and "_cuts" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_scans_are_pruned_and_filtered(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(analytics.a01_semester_hours(stored, *SEMESTER))
    scan = next(line for line in text.splitlines() if "booking_status" in line and "FileScan" in line)
    assert "In(booking_status" in scan and "GreaterThanOrEqual(requested_start_time" in scan
    assert "purpose" not in scan.split("ReadSchema")[1]
    text = plan(reports.r01_upcoming_bookings(stored, AS_OF))
    assert "GreaterThanOrEqual(requested_end_time" in text
