"""The four analytical reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomgrid.functions.exprs import as_decimal, hundredths, minute_diff, ntz
from roomgrid.plans.reports import _ROOM, _in_order, _people, _status, free_rooms
from roomgrid.schema import OUT_OF_SERVICE, USABLE_BOOKING


def _semester(t, start, end) -> DataFrame:
    return _status(t["booking"], USABLE_BOOKING).where(
        (F.col("requested_start_time") >= ntz(start)) & (F.col("requested_start_time") < ntz(end))
    )


def a01_semester_hours(t, semester_start, semester_end, *, ordered: bool = True) -> DataFrame:
    """Booked hours and bookings per room in a semester; rooms without any show zero."""
    per_space = (
        _semester(t, semester_start, semester_end)
        .groupBy("space_id")
        .agg(
            F.sum(minute_diff("requested_start_time", "requested_end_time")).alias("minutes"),
            F.count("*").alias("bookings"),
        )
    )
    nothing = F.lit(0).cast("long")
    out = (
        t["space"]
        .select("space_id", "space_code", "space_name", "space_type")
        .join(per_space, "space_id", "left")
        .select(
            "space_code",
            "space_name",
            "space_type",
            as_decimal(hundredths(F.coalesce("minutes", nothing), F.lit(60)), 12).alias("approved_booking_hours"),
            F.coalesce("bookings", nothing).alias("approved_booking_count"),
        )
    )
    return _in_order(out, ordered, F.desc("approved_booking_hours"), "space_code")


def a02_usage_distribution(t, semester_start, semester_end, *, ordered: bool = True) -> DataFrame:
    """Bookings of a semester per weekday (Monday is 1) and start hour."""
    start = F.col("requested_start_time")
    counts = (
        _semester(t, semester_start, semester_end)
        .groupBy((F.weekday(start) + 1).alias("day"), F.hour(start).alias("hour"))
        .agg(F.count("*").alias("approved_booking_count"))
    )
    # fixed values: the day before a Monday plus the day number gives the English name
    name = F.date_format(F.date_add(F.lit("2023-12-31").cast("date"), F.col("day")), "EEEE")
    out = counts.select(
        F.col("day").cast("long").alias("weekday_number_monday_first"),
        name.alias("weekday_name"),
        F.col("hour").cast("long").alias("start_hour"),
        "approved_booking_count",
    )
    return _in_order(out, ordered, "weekday_number_monday_first", "start_hour")


def _equipped(t, requested: DataFrame) -> DataFrame:
    """(request_id, space_id) of the rooms that hold everything the request lists.

    Only requests with a list appear here. The wanted items are counted per request, the
    present ones per room, and the counts must agree.
    """
    item = ["facility_name", "facility_type"]
    wanted = requested.select("request_id", *item).distinct()
    present = (
        t["space_facility"]
        .select("space_id", "facility_id")
        .join(t["facility"].select("facility_id", *item).join(wanted, item), "facility_id")
        .groupBy("request_id", "space_id")
        .agg(F.count_distinct(*item).alias("present"))
    )
    needed = wanted.groupBy("request_id").agg(F.count("*").alias("needed"))
    return present.join(needed, "request_id").where(F.col("present") == F.col("needed")).select("request_id", "space_id")


def a03_room_finder(t, requests: DataFrame, requested: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Rooms per request that are large enough, hold the listed facilities and are free.

    Advisories do not block a room; their number and texts are added. ``requests``:
    request_id, start, end, participants; ``requested``: request_id, facility_name,
    facility_type. A request that ends before it starts is an error.
    """
    checked = requests.withColumn(
        "end",
        F.when(F.col("end") > F.col("start"), F.col("end")).otherwise(
            F.raise_error(F.lit("51300: a room search must end after it starts")).cast("timestamp_ntz")
        ),
    )
    free = free_rooms(t, checked, (OUT_OF_SERVICE,))
    wishes = requested.groupBy("request_id").agg(F.lit(True).alias("has_list"))
    equipped = _equipped(t, requested).withColumn("complete", F.lit(True))
    rooms = (
        free.join(wishes, "request_id", "left")
        .join(equipped, ["request_id", "space_id"], "left")
        .where(F.col("has_list").isNull() | F.col("complete"))
    )
    out = rooms.select(
        "request_id",
        "space_id",
        *_ROOM,
        F.greatest(F.size("notices"), F.lit(0)).cast("long").alias("active_advisory_count"),
        F.when(F.size("notices") > 0, F.array_join("notices.text", "; ")).alias("active_advisories"),
    )
    return _in_order(out, ordered, "request_id", "capacity", "space_code")


def a04_maintenance_impact(t, maintenance_id: int | None = None, *, ordered: bool = True) -> DataFrame:
    """Bookings hit by an escalation, whom to contact and how it was settled."""
    impact = t["booking_impact"].select(
        "maintenance_id",
        "booking_id",
        "identified_at",
        "identified_by_user_id",
        "contact_status",
        "contacted_at",
        "resolution",
        "resolved_at",
        "resolved_by_user_id",
        "resolution_note",
    )
    if maintenance_id is not None:
        impact = impact.where(F.col("maintenance_id") == maintenance_id)
    records = t["maintenance"].select("maintenance_id", "space_id", "problem_description", "start_time", "completion_time")
    rooms = t["space"].select("space_id", "space_code", "space_name")
    booked = t["booking"].select(
        "booking_id", "booking_status", "requester_user_id", "requested_start_time", "requested_end_time"
    )
    out = (
        impact.join(records, "maintenance_id")
        .join(rooms, "space_id")
        .join(booked, "booking_id")
        .join(_people(t, "requester", "full_name", "email", "phone_number"), F.col("requester_user_id") == F.col("requester_id"))
        .join(_people(t, "finder", "full_name"), F.col("identified_by_user_id") == F.col("finder_id"))
        .join(_people(t, "resolver", "full_name"), F.col("resolved_by_user_id") == F.col("resolver_id"), "left")
        .select(
            "maintenance_id",
            "space_code",
            "space_name",
            "problem_description",
            F.col("start_time").alias("maintenance_start_time"),
            F.col("completion_time").alias("maintenance_end_time"),
            F.col("identified_at").alias("escalation_identified_at"),
            F.col("finder_full_name").alias("escalation_recorded_by"),
            "booking_id",
            F.col("booking_status").alias("current_booking_status"),
            "requested_start_time",
            "requested_end_time",
            F.col("requester_full_name").alias("requester_name"),
            "requester_email",
            F.col("requester_phone_number").alias("requester_phone"),
            "contact_status",
            "contacted_at",
            "resolution",
            "resolved_at",
            F.col("resolver_full_name").alias("resolved_by"),
            "resolution_note",
        )
    )
    return _in_order(
        out, ordered, F.desc("escalation_identified_at"), "space_code", "requested_start_time", "maintenance_id", "booking_id"
    )
