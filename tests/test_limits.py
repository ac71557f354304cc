"""What used to lose or change rows: NULL groups, hot groups, large numbers, short calendars."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roomgrid.operators.ranking import ranked
from roomgrid.operators.slices import neighbour, numbered, with_slices
from roomgrid.plans import rules, workflow
from roomgrid.sources import generate
from roomgrid.session import cut_lineage, shared_dir
from roomgrid.streaming import approvals as stream
from small import at, booking, person, policy, repair, room, tables

LARGE = 9007199254740993  # no double has this value


@pytest.mark.parametrize("slice_rows", [2, 1 << 21])
def test_null_groups_keep_their_rows(spark, slice_rows):
    rows = [(k, i, i * 10) for k in (None, 1) for i in range(9)] + [(2, 1, 5)]
    df = spark.createDataFrame(rows, "k int, i int, v int")
    got = neighbour(df, ["k"], ["i"], "v", "before", rows_per_slice=slice_rows).collect()
    assert len(got) == len(rows)
    assert all(r.before == ((r.i - 1) * 10 if r.i and r.k != 2 else None) for r in got)
    places = ranked(df, ["v"], "place", within=["k"], rows_per_slice=slice_rows).collect()
    assert sorted((r.k or 0, r.i, r.place) for r in places) == sorted((k or 0, i, 1 if k == 2 else i + 1) for k, i, _ in rows)


def test_only_the_hot_group_is_cut(spark):
    hot = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("i"))
    rest = spark.range(20_000).select((F.col("id") + 2).cast("int").alias("k"), F.col("id").alias("i"))
    df = hot.union(rest)
    sliced = with_slices(df, ["k"], ["i"], 1000)
    largest = sliced.groupBy("k", "_slice").count().agg(F.max("count")).first()[0]
    assert largest < 10_000 and sliced.where("k = 1").select("_slice").distinct().count() > 5
    got = neighbour(df, ["k"], ["i"], "i", "p", rows_per_slice=1000)
    assert got.where("k = 1 and i > 0 and (p is null or p <> i - 1)").count() == 0
    assert got.where("k > 1 and p is not null").count() == 0 and got.count() == 40_000
    assert numbered(df, ["k", "i"], "n", slices=40).agg(F.countDistinct("n"), F.min("n"), F.max("n")).first() == (40_000, 1, 40_000)
    assert "ScalarSubquery" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_generated_keys_stay_whole_and_no_booking_is_lost(spark):
    users = cut_lineage(generate.generate_users(spark, requesters=12_000))
    assert users.select("email").distinct().count() == 12_020
    spaces = generate.generate_spaces(spark, 1_500)
    assert spaces.select("space_code").distinct().count() == 1_500
    few = generate.generate_spaces(spark, 40)
    made = cut_lineage(generate.generate_bookings(spark, 100_000, few, users))
    assert made.count() == 100_000
    t = tables(spark).replace(booking=made, space=few, app_user=users)
    assert rules.v10_unique_keys(t).count() == 0
    with pytest.raises(ValueError, match="days"):
        generate.generate_bookings(spark, 100_000, few, users, generate.academic_days(spark))


def test_stream_keeps_large_numbers(spark):
    b = booking(LARGE, "2030-01-15 09:00:00", "2030-01-15 10:00:00", status="Pending", submitted="2030-01-01 08:00:00")
    t = tables(spark, app_user=[person(1), person(2, "FacilityStaff")], space=[room(1)], booking=[b], booking_policy=[policy(1)])
    t = t.replace(maintenance=tables(spark, maintenance=[repair(LARGE + 2, "2030-01-15 09:30:00")])["maintenance"])
    rows = [
        (LARGE, "approve", at("2030-01-02 08:00:00"), LARGE, 2, False, True, None, None, None),
        (LARGE + 2, "level", at("2030-01-03 08:00:00"), None, 2, None, None, LARGE + 2, "out-of-service", "worse"),
        (LARGE + 4, "approve", at("2030-01-04 08:00:00"), -1, 2, False, True, None, None, None),
    ]
    source, out = shared_dir(spark, "source"), shared_dir(spark, "out")
    spark.createDataFrame(rows, stream.COMMANDS).write.parquet(source)
    outcomes = stream.s01_stream_approvals(spark.readStream.schema(stream.COMMANDS).parquet(source), t, workflow.standing_facts(t))
    stream.run_available(outcomes, out, shared_dir(spark, "checkpoint"))
    got = sorted((r.command_id, r.booking_id, r.maintenance_id, r.code, r.result, r.impacted_booking_id) for r in spark.read.parquet(out).collect())
    assert got[0] == (LARGE, LARGE, None, None, "Approved", None)
    assert sorted(got[1:3], key=lambda r: r[4]) == [(LARGE + 2, None, LARGE + 2, None, "Changed", None), (LARGE + 2, None, LARGE + 2, None, "Impact", LARGE)]
    assert got[3] == (LARGE + 4, -1, None, 51034, None, None)


def test_create_then_approve(spark):
    people = [person(1), person(2, "FacilityStaff"), person(3, status="Inactive")]
    t = tables(
        spark, app_user=people, space=[room(1), room(2, status="Retired"), room(3, capacity=5)], booking_policy=[policy(1, auto=True)],
        booking=[booking(7, "2030-01-15 09:00:00", "2030-01-15 10:00:00")],
    )
    nine, ten, eleven = (at(f"2030-01-15 {h}:00:00") for h in ("09", "10", "11"))
    rows = [
        (1, 1, 1, ten, eleven, "Meeting", 5, True, 2, True),
        (2, 1, 1, ten, eleven, "Meeting", 5, True, 2, True),  # the first has taken the time
        (3, 1, 1, ten, eleven, "Meeting", 5, False, None, False),  # asks for nothing more
        (4, 1, 2, ten, eleven, "Meeting", 5, True, 2, True),
        (5, 1, 3, ten, eleven, "Meeting", 6, True, 2, True),
        (6, 1, 9, ten, eleven, "Meeting", 5, True, 2, True),
        (7, 1, 1, ten, eleven, "Party", 5, True, 2, True),
        (8, 3, 2, ten, eleven, "Party", 0, True, None, True),  # the first broken rule counts
        (9, 1, 1, nine, ten, "Meeting", 5, True, 2, True),
    ]
    schema = "request_id long, requester_user_id long, space_id long, start timestamp_ntz, end timestamp_ntz, purpose string, participants int, auto_approve boolean, decision_maker_user_id long, acknowledge boolean"
    made, after = workflow.w12_create_and_approve(t, spark.createDataFrame(rows, schema), "2030-01-01 08:00:00")
    assert sorted(tuple(r) for r in made.collect()) == [
        (1, 8, None, "AutoApproved", "Approved"), (2, 9, 51041, None, "Pending"), (3, 10, None, None, "Pending"), (4, None, 51001, None, None),
        (5, None, 51001, None, None), (6, None, 547, None, None), (7, None, 547, None, None), (8, None, 51031, None, None), (9, 11, 51041, None, "Pending"),
    ]
    assert {r.booking_id: r.booking_status for r in after["booking"].collect()} == {7: "Approved", 8: "Approved", 9: "Pending", 10: "Pending", 11: "Pending"}
    assert [(r.booking_id, r.decision) for r in after["booking_decision"].collect()] == [(8, "AutoApproved")]
