"""The twenty operational reports.

Each takes the tables and its parameters and returns a DataFrame. Rows come in the
report's order unless ``ordered=False``; leave the order off when the result feeds another
job, since a total order costs a range shuffle. Clock readings are the parameter ``as_of``.

How the plans keep to scale: filters and columns are chosen before joins; whatever can be
counted per room or per person is counted before names are joined; no join side is forced
into a broadcast, Spark's own size check decides; ordered scans and ranks cut large groups
into slices (``operators.slices``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomgrid.functions.exprs import as_decimal, hour_diff, hundredths, minute_diff, ntz, open_end, percent, shift_minutes
from roomgrid.operators.overlap import at_least_pairs, overlap_pairs, self_overlap_pairs
from roomgrid.operators.policy import with_policy
from roomgrid.operators.ranking import ranked
from roomgrid.operators.slices import neighbour
from roomgrid.schema import (
    ACTIVE_BOOKING,
    ACTIVE_MAINTENANCE,
    CLOSED_SPACE,
    HELD_BOOKING,
    IMPACT_LEVELS,
    OPEN_BOOKING,
    OPEN_SPACE,
    USABLE_BOOKING,
)


def _in_order(df: DataFrame, ordered: bool, *order) -> DataFrame:
    return df.orderBy(*order) if ordered else df


def _status(df: DataFrame, statuses) -> DataFrame:
    return df.where(F.col("booking_status").isin(*statuses))


def _people(t, prefix: str, *columns: str) -> DataFrame:
    """Users under the name of a role: ``<prefix>_id`` and the chosen columns."""
    return t["app_user"].select(F.col("user_id").alias(f"{prefix}_id"), *[F.col(c).alias(f"{prefix}_{c}") for c in columns])


def _count_of(status: str):
    return F.count(F.when(F.col("booking_status") == status, 1))


def active_maintenance(t, levels=IMPACT_LEVELS) -> DataFrame:
    m = t["maintenance"].where(F.col("maintenance_status").isin(*ACTIVE_MAINTENANCE))
    return m if set(levels) == set(IMPACT_LEVELS) else m.where(F.col("impact_level").isin(*levels))


def r01_upcoming_bookings(t, as_of, days: int = 7, *, ordered: bool = True) -> DataFrame:
    """Approved and checked-in bookings of the coming days, with room and requester."""
    horizon = ntz(as_of) + F.make_dt_interval(days=F.lit(days))
    due = _status(t["booking"], ACTIVE_BOOKING).where(
        (F.col("requested_end_time") >= ntz(as_of)) & (F.col("requested_start_time") < horizon)
    )
    rooms = t["space"].select("space_id", "space_code", "space_name")
    who = _people(t, "requester", "full_name", "email")
    out = (
        due.join(rooms, "space_id")
        .join(who, F.col("requester_user_id") == F.col("requester_id"))
        .select(
            "space_code",
            "space_name",
            "requested_start_time",
            "requested_end_time",
            "purpose",
            "expected_participants",
            "booking_status",
            F.col("requester_full_name").alias("requester_name"),
            "requester_email",
        )
    )
    return _in_order(out, ordered, "requested_start_time", "space_code")


def free_rooms(t, requests: DataFrame, blocking_levels) -> DataFrame:
    """Every request with every open room that is large enough and free in its interval.

    ``requests``: request_id, start, end, participants. Adds ``notices``: maintenance_id and
    text of the overlapping records that do not block. Bookings and maintenance meet the
    requests in one join; what it finds is folded per (request, room).
    """
    booked = _status(t["booking"], ACTIVE_BOOKING).select(
        "space_id",
        F.col("requested_start_time").alias("from"),
        F.col("requested_end_time").alias("until"),
        F.lit(True).alias("blocks"),
        F.lit(None).cast("long").alias("maintenance_id"),
        F.lit(None).cast("string").alias("text"),
    )
    repaired = active_maintenance(t).select(
        "space_id",
        F.col("start_time").alias("from"),
        open_end("completion_time").alias("until"),
        F.col("impact_level").isin(*blocking_levels).alias("blocks"),
        "maintenance_id",
        F.col("problem_description").alias("text"),
    )
    spans = requests.select("request_id", "start", "end")
    notice = F.when(~F.col("blocks"), F.struct("maintenance_id", "text"))
    met = (
        overlap_pairs(booked.unionByName(repaired), spans, [], ("from", "until"), ("start", "end"))
        .groupBy("request_id", "space_id")
        .agg(F.bool_or("blocks").alias("blocked"), F.array_sort(F.collect_list(notice)).alias("notices"))
    )
    rooms = t["space"].where(F.col("current_status").isin(*OPEN_SPACE)).select("space_id", *_ROOM)
    large_enough = at_least_pairs(rooms, requests, "capacity", "participants")
    return large_enough.join(met, ["request_id", "space_id"], "left").where(~F.coalesce("blocked", F.lit(False)))


_ROOM = ["space_code", "space_name", "space_type", "capacity", "building", "floor", "room_number"]


def r02_availability_search(t, requests: DataFrame, blocking_levels=IMPACT_LEVELS, *, ordered: bool = True) -> DataFrame:
    """Free rooms per request; active maintenance of any level blocks unless told otherwise."""
    out = free_rooms(t, requests, blocking_levels).select("request_id", *_ROOM)
    return _in_order(out, ordered, "request_id", "capacity", "space_code")


def r03_space_utilization(t, window_end, days: int = 90, *, ordered: bool = True) -> DataFrame:
    """Completed and no-show hours per room, against twelve hours a day of the window."""
    end = ntz(window_end)
    booked = (
        _status(t["booking"], ("Completed", "NoShow"))
        .where(
            (F.col("requested_start_time") >= end - F.make_dt_interval(days=F.lit(days)))
            & (F.col("requested_start_time") < end)
        )
        .select(
            "space_id",
            "booking_status",
            hundredths(minute_diff("requested_start_time", "requested_end_time"), F.lit(60)).alias("hours"),
        )
    )
    per_space = booked.groupBy("space_id").agg(
        F.sum(F.when(F.col("booking_status") == "Completed", F.col("hours"))).alias("completed"),
        F.sum(F.when(F.col("booking_status") == "NoShow", F.col("hours"))).alias("no_show"),
        F.sum("hours").alias("all_hours"),
    )
    nothing = F.lit(0).cast("long")
    out = (
        t["space"]
        .select("space_id", "space_code", "space_name")
        .join(per_space, "space_id", "left")
        .select(
            "space_code",
            "space_name",
            as_decimal(F.coalesce("completed", nothing), 38).alias("completed_hours"),
            as_decimal(F.coalesce("no_show", nothing), 38).alias("no_show_hours"),
            as_decimal(hundredths(F.coalesce("all_hours", nothing), F.lit(days * 12)), 5).alias("scheduled_utilization_pct"),
        )
    )
    return _in_order(out, ordered, F.desc("scheduled_utilization_pct"), "space_code")


def r04_peak_start_hours(t, first_day: str = "Sunday", *, ordered: bool = True) -> DataFrame:
    """Booking starts per weekday and hour, most frequent first. At most 168 groups are ranked."""
    started = _status(t["booking"], HELD_BOOKING).select(
        F.weekday("requested_start_time").alias("monday_first"), F.hour("requested_start_time").alias("start_hour")
    )
    counts = started.groupBy("monday_first", "start_hour").agg(F.count("*").alias("booking_count"))
    # fixed values: any Monday gives the English names
    names = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("monday_first")), "EEEE")
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    shift = 7 - days.index(first_day)
    place = F.rank().over(Window.orderBy(F.desc("booking_count")))  # 7 * 24 rows at most
    out = counts.select(
        names.alias("weekday_name"),
        F.col("start_hour").cast("long").alias("start_hour"),
        "booking_count",
        place.cast("long").alias("overall_peak_rank"),
        F.pmod(F.col("monday_first") + shift, F.lit(7)).alias("_day"),
    )
    return _in_order(out, ordered, "overall_peak_rank", "_day", "start_hour").drop("_day")


def r05_capacity_demand(t, *, ordered: bool = True) -> DataFrame:
    """Rooms by how full their bookings are on average; rooms without bookings come last."""
    per_space = (
        _status(t["booking"], HELD_BOOKING)
        .groupBy("space_id")
        .agg(F.count("*").alias("bookings"), F.sum("expected_participants").alias("people"))
    )
    nothing = F.lit(0).cast("long")
    demand = (
        t["space"]
        .select("space_id", "space_code", "space_name", "capacity")
        .join(per_space, "space_id", "left")
        .select(
            "space_code",
            "space_name",
            "capacity",
            F.coalesce("bookings", nothing).alias("active_or_completed_bookings"),
            F.coalesce("people", nothing).alias("booked_participants"),
        )
    )
    seats = F.nullif(F.col("capacity") * F.col("active_or_completed_bookings"), F.lit(0).cast("long"))
    scored = demand.withColumn("_empty", seats.isNull()).withColumn("_less", -(F.col("booked_participants") / seats))
    out = ranked(scored, ["_empty", "_less"], "demand_rank").select(
        *demand.columns, percent("booked_participants", seats).alias("average_capacity_fill_pct"), "demand_rank"
    )
    return _in_order(out, ordered, "demand_rank", "space_code")


def r06_session_variance(t, *, ordered: bool = True) -> DataFrame:
    """Planned and actual minutes of finished sessions, and how late they ended."""
    finished = t["usage_session"].where(F.col("actual_end_time").isNotNull()).select(
        "booking_id", "actual_start_time", "actual_end_time"
    )
    booked = t["booking"].select("booking_id", "space_id", "requester_user_id", "requested_start_time", "requested_end_time")
    out = (
        finished.join(booked, "booking_id")
        .join(t["space"].select("space_id", "space_code"), "space_id")
        .join(_people(t, "requester", "full_name"), F.col("requester_user_id") == F.col("requester_id"))
        .select(
            "booking_id",
            "space_code",
            F.col("requester_full_name").alias("requester_name"),
            "requested_start_time",
            "requested_end_time",
            "actual_start_time",
            "actual_end_time",
            minute_diff("requested_start_time", "requested_end_time").alias("planned_minutes"),
            minute_diff("actual_start_time", "actual_end_time").alias("actual_minutes"),
            minute_diff("requested_end_time", "actual_end_time").alias("checkout_variance_minutes"),
        )
    )
    return _in_order(out, ordered, F.desc("checkout_variance_minutes"), "booking_id")


def r07_overlapping_bookings(t, *, ordered: bool = True) -> DataFrame:
    """Pairs of active bookings of one room that overlap; sound data has none."""
    active = _status(t["booking"], ACTIVE_BOOKING).select(
        "space_id", "booking_id", F.col("requested_start_time").alias("start"), F.col("requested_end_time").alias("end")
    )
    pairs = self_overlap_pairs(active, ["space_id"], ("start", "end"), "booking_id")
    low_first = F.col("booking_id") < F.col("booking_id_2")

    def side(column: str, first: bool):
        own, other = F.col(column), F.col(f"{column}_2")
        return F.when(low_first, own if first else other).otherwise(other if first else own)

    out = pairs.join(t["space"].select("space_id", "space_code"), "space_id").select(
        "space_code",
        side("booking_id", True).alias("first_booking_id"),
        side("booking_id", False).alias("second_booking_id"),
        side("start", True).alias("first_start"),
        side("end", True).alias("first_end"),
        side("start", False).alias("second_start"),
        side("end", False).alias("second_end"),
    )
    return _in_order(out, ordered, "space_code", "first_start", "first_booking_id", "second_booking_id")


def maintenance_overlaps(bookings: DataFrame, maintenance: DataFrame) -> DataFrame:
    """Pairs of bookings and maintenance records of one room that overlap.

    Both keep their columns; the maintenance end is also there as ``blocked_until``.
    """
    return overlap_pairs(
        bookings,
        maintenance.withColumn("blocked_until", open_end("completion_time")),
        ["space_id"],
        ("requested_start_time", "requested_end_time"),
        ("start_time", "blocked_until"),
    )


def r08_booking_maintenance_conflicts(t, blocking_levels=IMPACT_LEVELS, *, ordered: bool = True) -> DataFrame:
    """Active bookings that overlap active maintenance."""
    booked = _status(t["booking"], ACTIVE_BOOKING).select(
        "space_id", "booking_id", "requested_start_time", "requested_end_time"
    )
    broken = active_maintenance(t, blocking_levels).select(
        "space_id", "maintenance_id", "problem_description", "start_time", "completion_time"
    )
    out = (
        maintenance_overlaps(booked, broken)
        .join(t["space"].select("space_id", "space_code"), "space_id")
        .select(
            "space_code",
            "booking_id",
            "requested_start_time",
            "requested_end_time",
            "maintenance_id",
            "problem_description",
            F.col("start_time").alias("maintenance_start"),
            F.col("completion_time").alias("maintenance_end"),
        )
    )
    return _in_order(out, ordered, "space_code", "requested_start_time", "booking_id", "maintenance_id")


def r09_unavailable_spaces(t, as_of, *, ordered: bool = True) -> DataFrame:
    """Rooms that are closed or have an open maintenance record, and who takes care of it."""
    records = active_maintenance(t).select(
        "space_id", "maintenance_id", "maintenance_status", "start_time", "problem_description", "assigned_staff_user_id"
    )
    out = (
        t["space"]
        .select("space_id", "space_code", "space_name", "current_status")
        .join(records, "space_id", "left")
        .where(F.col("current_status").isin(*CLOSED_SPACE) | F.col("maintenance_id").isNotNull())
        .join(_people(t, "assignee", "full_name"), F.col("assigned_staff_user_id") == F.col("assignee_id"), "left")
        .select(
            "space_code",
            "space_name",
            "current_status",
            "maintenance_id",
            "maintenance_status",
            "start_time",
            "problem_description",
            F.coalesce("assignee_full_name", F.lit("Unassigned")).alias("assigned_staff"),
            hour_diff("start_time", ntz(as_of)).alias("open_hours"),
        )
    )
    return _in_order(out, ordered, F.desc("open_hours"), "space_code", "maintenance_id")


def r10_booking_gaps(t, *, ordered: bool = True) -> DataFrame:
    """Minutes between one booking of a room and the next."""
    used = _status(t["booking"], USABLE_BOOKING).select("space_id", "booking_id", "requested_start_time", "requested_end_time")
    follow = neighbour(used, ["space_id"], ["requested_start_time", "booking_id"], "requested_end_time", "previous_end_time")
    out = (
        follow.where(F.col("previous_end_time").isNotNull())
        .join(t["space"].select("space_id", "space_code"), "space_id")
        .select(
            "space_code",
            "booking_id",
            "previous_end_time",
            "requested_start_time",
            minute_diff("previous_end_time", "requested_start_time").alias("gap_minutes"),
        )
    )
    return _in_order(out, ordered, "gap_minutes", "space_code", "requested_start_time", "booking_id")


def r11_role_outcomes(t, *, ordered: bool = True) -> DataFrame:
    """Bookings and their outcomes per role of the requester."""
    # fixed values: report column and the status it counts
    outcomes = {
        "approved_bookings": "Approved",
        "rejected_bookings": "Rejected",
        "cancelled_bookings": "Cancelled",
        "no_show_bookings": "NoShow",
    }
    per_person = t["booking"].groupBy("requester_user_id").agg(
        F.count("*").alias("total_bookings"), *[_count_of(status).alias(c) for c, status in outcomes.items()]
    )
    out = (
        per_person.join(_people(t, "requester", "role"), F.col("requester_user_id") == F.col("requester_id"))
        .groupBy(F.col("requester_role").alias("role"))
        .agg(*[F.sum(c).alias(c) for c in ["total_bookings", *outcomes]])
    )
    return _in_order(out, ordered, F.desc("total_bookings"), "role")


def r12_requester_reliability(t, min_bookings: int = 1, *, ordered: bool = True) -> DataFrame:
    """Share of cancelled and unused bookings per requester, worst first."""
    per_person = (
        t["booking"]
        .groupBy("requester_user_id")
        .agg(
            F.count("*").alias("total_bookings"),
            _count_of("Cancelled").alias("cancelled_bookings"),
            _count_of("NoShow").alias("no_show_bookings"),
        )
        .where(F.col("total_bookings") >= min_bookings)
    )
    unused = F.col("cancelled_bookings") + F.col("no_show_bookings")
    known = per_person.join(_people(t, "requester", "full_name", "email"), F.col("requester_user_id") == F.col("requester_id"))
    scored = known.withColumn("_less", -(unused / F.col("total_bookings")))
    out = ranked(scored, ["_less"], "non_use_risk_rank").select(
        F.col("requester_full_name").alias("full_name"),
        F.col("requester_email").alias("email"),
        "total_bookings",
        "cancelled_bookings",
        "no_show_bookings",
        percent(unused, "total_bookings").alias("non_use_rate_pct"),
        "non_use_risk_rank",
    )
    return _in_order(out, ordered, "non_use_risk_rank", "full_name", "email")


def r13_decision_turnaround(t, *, ordered: bool = True) -> DataFrame:
    """From submission to the first decision, per decision and decision maker."""
    first = (
        t["booking_decision"]
        .groupBy("booking_id")
        .agg(F.min(F.struct("decision_time", "decision_id", "decision", "decision_maker_user_id")).alias("d"))
        .select("booking_id", "d.decision_time", "d.decision", "d.decision_maker_user_id")
    )
    per_maker = (
        first.join(t["booking"].select("booking_id", "submitted_at"), "booking_id")
        .groupBy("decision", "decision_maker_user_id")
        .agg(
            F.count("*").alias("decisions"),
            F.sum(minute_diff("submitted_at", "decision_time")).alias("minutes"),
            F.max(hour_diff("submitted_at", "decision_time")).alias("longest"),
        )
    )
    out = (
        per_maker.join(_people(t, "maker", "full_name"), F.col("decision_maker_user_id") == F.col("maker_id"))
        .groupBy("decision", F.col("maker_full_name").alias("decision_maker"))
        .agg(
            F.sum("decisions").alias("decisions"),
            as_decimal(hundredths(F.sum("minutes"), F.sum("decisions") * 60), 10).alias("average_turnaround_hours"),
            F.max("longest").alias("longest_turnaround_hours"),
        )
    )
    return _in_order(out, ordered, F.desc("average_turnaround_hours"), "decision_maker", "decision")


def r14_monthly_workload(t, *, ordered: bool = True) -> DataFrame:
    """Decisions per person and month, ranked within the month."""
    month = F.trunc(F.col("decision_time").cast("date"), "MM")
    per_maker = t["booking_decision"].groupBy("decision_maker_user_id", month.alias("decision_month")).agg(
        F.count("*").alias("n")
    )
    per_name = (
        per_maker.join(_people(t, "maker", "full_name"), F.col("decision_maker_user_id") == F.col("maker_id"))
        .groupBy(F.col("maker_full_name").alias("full_name"), "decision_month")
        .agg(F.sum("n").alias("decision_count"))
    )
    scored = per_name.withColumn("_less", -F.col("decision_count"))
    out = ranked(scored, ["_less"], "monthly_workload_rank", within=["decision_month"]).drop("_less")
    return _in_order(out, ordered, "decision_month", "monthly_workload_rank", "full_name")


def r15_maintenance_turnaround(t, as_of, *, ordered: bool = True) -> DataFrame:
    """Hours to completion of a maintenance record, or up to now while it is open."""
    out = t["maintenance"].join(t["space"].select("space_id", "space_code"), "space_id").select(
        "space_code",
        "maintenance_id",
        "maintenance_status",
        "problem_description",
        "start_time",
        "completion_time",
        hour_diff("start_time", F.coalesce("completion_time", ntz(as_of))).alias("elapsed_hours"),
        F.when(F.col("completion_time").isNull(), "Open").otherwise("Completed").alias("turnaround_state"),
    )
    return _in_order(out, ordered, F.desc("elapsed_hours"), "space_code", "maintenance_id")


def r16_facility_demand(t, *, ordered: bool = True) -> DataFrame:
    """Equipment of each room with the bookings of that room, ranked per kind of equipment."""
    per_space = _status(t["booking"], HELD_BOOKING).groupBy("space_id").agg(F.count("*").alias("n"))
    rooms = t["space"].select("space_id", "space_code").join(per_space, "space_id", "left")
    inventory = (
        t["space_facility"]
        .select("space_id", "facility_id", "quantity")
        .join(rooms, "space_id")
        .join(t["facility"].select("facility_id", "facility_name", "facility_type"), "facility_id")
        .select(
            "space_code",
            "facility_name",
            "facility_type",
            "quantity",
            F.coalesce("n", F.lit(0).cast("long")).alias("supported_booking_count"),
        )
    )
    scored = inventory.withColumn("_less", -F.col("supported_booking_count"))
    out = ranked(scored, ["_less", "space_code"], "facility_demand_rank", within=["facility_type"]).select(
        *inventory.columns, "facility_demand_rank"
    )
    return _in_order(out, ordered, "facility_type", "facility_demand_rank", "space_code", "facility_name")


def r17_open_sessions(t, as_of, *, ordered: bool = True) -> DataFrame:
    """Sessions nobody has checked out of."""
    running = t["usage_session"].where(F.col("actual_end_time").isNull()).select(
        "booking_id", "check_in_by_user_id", "actual_start_time", "initial_condition", "usage_notes"
    )
    out = (
        running.join(t["booking"].select("booking_id", "space_id", "requester_user_id"), "booking_id")
        .join(t["space"].select("space_id", "space_code"), "space_id")
        .join(_people(t, "requester", "full_name"), F.col("requester_user_id") == F.col("requester_id"))
        .join(_people(t, "staff", "full_name"), F.col("check_in_by_user_id") == F.col("staff_id"))
        .select(
            "space_code",
            "booking_id",
            F.col("requester_full_name").alias("requester_name"),
            "actual_start_time",
            minute_diff("actual_start_time", ntz(as_of)).alias("open_session_minutes"),
            F.col("staff_full_name").alias("checked_in_by"),
            "initial_condition",
            "usage_notes",
        )
    )
    return _in_order(out, ordered, F.desc("open_session_minutes"), "space_code", "booking_id")


def r18_capacity_fit(t, *, ordered: bool = True) -> DataFrame:
    """Spare seats of open bookings; nearly full from nine tenths, oversized up to three tenths."""
    open_bookings = _status(t["booking"], OPEN_BOOKING).select(
        "booking_id", "space_id", "purpose", "booking_status", "expected_participants", "requested_start_time"
    )
    people, seats = F.col("expected_participants").cast("long"), F.col("capacity").cast("long")
    out = open_bookings.join(t["space"].select("space_id", "space_code", "capacity"), "space_id").select(
        "booking_id",
        "space_code",
        "purpose",
        "booking_status",
        "expected_participants",
        "capacity",
        (F.col("capacity") - F.col("expected_participants")).alias("spare_seats"),
        as_decimal(hundredths(people * 100, seats), 5).alias("capacity_fill_pct"),
        F.when(people * 10 >= seats * 9, "Near capacity")
        .when(people * 10 <= seats * 3, "Potentially oversized")
        .otherwise("Appropriate fit")
        .alias("fit_assessment"),
        F.col("requested_start_time").alias("_start"),
    )
    return _in_order(out, ordered, F.desc("capacity_fill_pct"), "_start", "booking_id").drop("_start")


def r19_effective_policy(t, *, ordered: bool = True) -> DataFrame:
    """The policy that counts for each pending booking, and its interval with buffers."""
    pending = (
        _status(t["booking"], ("Pending",))
        .select("booking_id", "space_id", "requester_user_id", "purpose", "requested_start_time", "requested_end_time")
        .join(_people(t, "requester", "full_name", "role"), F.col("requester_user_id") == F.col("requester_id"))
        .join(t["space"].select("space_id", "space_code"), "space_id")
    )
    out = with_policy(pending, t["booking_policy"], role="requester_role").select(
        "booking_id",
        F.col("requester_full_name").alias("requester_name"),
        "requester_role",
        "space_code",
        "purpose",
        "requested_start_time",
        "policy_id",
        "minimum_lead_minutes",
        "cancellation_lead_minutes",
        "pre_buffer_minutes",
        "post_buffer_minutes",
        shift_minutes("requested_start_time", -F.col("pre_buffer_minutes")).alias("effective_start_time"),
        shift_minutes("requested_end_time", "post_buffer_minutes").alias("effective_end_time"),
    )
    return _in_order(out, ordered, "requested_start_time", "booking_id")


def r20_audit_timeline(t, *, ordered: bool = True) -> DataFrame:
    """What happened to each booking, in time order, with the minutes since the event before.

    Each table is read once: a row unfolds into its one or two events. People's names are
    joined once, after the events are together.
    """

    def event(time, kind, actor, detail):
        return F.struct(
            _c(time).alias("event_time"),
            _c(kind).alias("event_type"),
            _c(actor).alias("actor"),
            _c(detail).alias("event_detail"),
        )

    def _c(value):
        return F.col(value) if isinstance(value, str) else value

    def unfolded(df: DataFrame, *events) -> DataFrame:
        return df.select("booking_id", F.explode(F.array(*events)).alias("e")).select("booking_id", "e.*").where(
            F.col("event_time").isNotNull()
        )

    submission = F.concat_ws(
        "", F.lit("Purpose: "), F.col("purpose"), F.lit("; expected participants: "), F.col("expected_participants").cast("string")
    )
    events = (
        unfolded(
            t["booking"],
            event("submitted_at", F.lit("Submitted"), "requester_user_id", submission),
            event("cancelled_at", F.lit("Cancelled"), "cancelled_by_user_id", "cancellation_note"),
        )
        .unionByName(
            unfolded(
                t["booking_decision"],
                event("decision_time", "decision", "decision_maker_user_id", F.coalesce("rejection_reason", "decision_note")),
            )
        )
        .unionByName(
            unfolded(
                t["usage_session"],
                event("actual_start_time", F.lit("CheckedIn"), "check_in_by_user_id", "initial_condition"),
                event("actual_end_time", F.lit("CheckedOut"), "check_out_by_user_id", F.coalesce("final_condition", "usage_notes")),
            )
        )
    )
    named = events.join(_people(t, "actor", "full_name"), F.col("actor") == F.col("actor_id")).select(
        "booking_id", "event_time", "event_type", F.col("actor_full_name").alias("actor_name"), "event_detail"
    )
    # equal events differ in nothing but their place, so text closes the order
    order = ["event_time", "event_type", "actor_name", "event_detail"]
    # a booking has a handful of events, so a plain window has no large group here
    before = F.lag("event_time").over(Window.partitionBy("booking_id").orderBy(*order))
    out = (
        named.withColumn("_previous", before)
        .withColumn("minutes_since_previous_event", minute_diff("_previous", "event_time"))
        .drop("_previous")
    )
    return _in_order(out, ordered, "booking_id", *order)
