"""Time the headline jobs: conflict check, room finder, semester hours and usage distribution.

The twelve tables are derived and stored once, as a loaded database would hold them; the
jobs then run on the stored Parquet tables. Each job runs ``BENCH_RUNS`` times after one
warm-up and its median counts. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roomgrid.plans import analytics, reports, rules, workflow  # noqa: E402
from roomgrid.plans.catalog import AS_OF, SEMESTER, parameter, room_requests  # noqa: E402
from roomgrid.session import local_session, shared_dir  # noqa: E402
from roomgrid.sources.fixtures import derived_tables  # noqa: E402
from roomgrid.sources.tables import load_tables, write_tables  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=cpus, app="roomgrid-bench")
    target = shared_dir(spark, "bench")
    names = ("app_user", "space", "facility", "space_facility", "booking_policy", "booking", "booking_decision", "usage_session", "maintenance")
    write_tables(derived_tables(spark, folder), target, names)
    t = load_tables(spark, target)
    requests, wishes = room_requests(spark, folder), parameter(spark, folder, "room_wish")
    jobs = {
        "a01_semester_hours": lambda: analytics.a01_semester_hours(t, *SEMESTER),
        "a02_usage_distribution": lambda: analytics.a02_usage_distribution(t, *SEMESTER),
        "a03_room_finder": lambda: analytics.a03_room_finder(t, requests, wishes),
        "w02_conflict_check": lambda: workflow.w02_conflict_check(t, workflow.pending_bookings(t)),
        "r01_upcoming_bookings": lambda: reports.r01_upcoming_bookings(t, AS_OF),
        "r03_space_utilization": lambda: reports.r03_space_utilization(t, AS_OF),
        "r07_overlapping_bookings": lambda: reports.r07_overlapping_bookings(t),
        "r10_booking_gaps": lambda: reports.r10_booking_gaps(t),
        "r13_decision_turnaround": lambda: reports.r13_decision_turnaround(t),
        "r19_effective_policy": lambda: reports.r19_effective_policy(t),
        "r20_audit_timeline": lambda: reports.r20_audit_timeline(t),
        "v04_maintenance_block": lambda: rules.v04_maintenance_block(t),
    }
    seconds = {}
    for name, job in jobs.items():
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            job().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    sf = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )


if __name__ == "__main__":
    main()
