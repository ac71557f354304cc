"""Test data of any size, made by column expressions over a source of numbers.

Nothing is drawn at random: every row follows from its number, so tasks can be run again.
Each ``..._from`` function takes its numbers (or rooms, people, days) as a DataFrame; the
``generate_...`` functions supply them with ``spark.range``. Rooms, people and days are
joined to the bookings on keys computed from the number; the bookings are not shuffled as
long as Spark finds those tables small enough to send around.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roomgrid.functions.exprs import shift_minutes
from roomgrid.operators.slices import numbered
from roomgrid.plans.reports import maintenance_overlaps
from roomgrid.schema import PURPOSES

#: Bounds of a benchmark data set; pass them as ``limits`` to have other counts refused.
BENCHMARK = (100_000, 500_000)


def _padded(number: str, digits: int):
    """At least so many digits; a longer number stays whole."""
    return F.expr(f"lpad(cast({number} as string), greatest({digits}, length(cast({number} as string))), '0')")


def _choice(number, words):
    return F.element_at(F.array(*[F.lit(w) for w in words]), (number + 1).cast("int"))


def space_count(bookings: int) -> int:
    return max(80, -(-bookings // 1200))


# ---- people and rooms


def users_from(numbers: DataFrame, requesters: int, prefix: str = "bench", domain: str = "example.org") -> DataFrame:
    """``numbers``: column n from 1. Numbers above ``requesters`` are staff."""
    n = F.col("n")
    staff = n > requesters
    role = F.when(staff, "FacilityStaff").when(n % 10 == 0, "Lecturer").when(n % 10 == 1, "TA").otherwise("Student")
    return numbers.select(
        n.cast("long").alias("user_id"),
        F.concat(F.lit("Person "), n.cast("string")).alias("full_name"),
        F.concat(F.lit(f"{prefix}."), _padded("n", 4), F.lit(f"@{domain}")).alias("email"),
        F.concat(F.lit("0908"), _padded("n", 6)).alias("phone_number"),
        role.alias("role"),
        F.when(staff, "Facilities").otherwise("Computer Science").alias("department"),
        F.lit("Active").alias("account_status"),
    )


def generate_users(spark: SparkSession, requesters: int = 980, staff: int = 20) -> DataFrame:
    return users_from(spark.range(1, requesters + staff + 1).withColumnRenamed("id", "n"), requesters)


def spaces_from(numbers: DataFrame, prefix: str = "BENCH") -> DataFrame:
    """``numbers``: column n from 1."""
    n = F.col("n")
    # fixed values: room types by number % 5
    kinds = ("Classroom", "MeetingRoom", "ComputerLaboratory", "ProjectLaboratory", "StudentWorkspace")
    return numbers.select(
        n.cast("long").alias("space_id"),
        F.concat(F.lit(f"{prefix}-"), _padded("n", 3)).alias("space_code"),
        F.concat(F.lit("Room "), n.cast("string")).alias("space_name"),
        _choice(n % 5, kinds).alias("space_type"),
        F.concat(F.lit("Wing "), ((n - 1) % 8 + 1).cast("string")).alias("building"),
        ((n - 1) % 6 + 1).cast("string").alias("floor"),
        F.concat(F.lit("B"), _padded("n", 3)).alias("room_number"),
        (20 + (n * 7) % 181).cast("int").alias("capacity"),
        F.lit("Available").alias("current_status"),
        F.lit("Made room; open to all made people.").alias("usage_policy"),
    )


def generate_spaces(spark: SparkSession, n: int) -> DataFrame:
    return spaces_from(spark.range(1, n + 1).withColumnRenamed("id", "n"))


# ---- calendar


def academic_days_from(dates: DataFrame) -> DataFrame:
    """``dates``: column booking_date. Weekdays outside June and July, numbered from 0.

    One row per day of a calendar, so a window over all of them is small.
    """
    taught = dates.distinct().where((F.weekday("booking_date") < 5) & ~F.month("booking_date").isin(6, 7))
    number = F.row_number().over(Window.orderBy("booking_date")) - 1
    return taught.select("booking_date", number.cast("long").alias("academic_day_number"))


def academic_days(spark: SparkSession, start: str = "2023-01-01", days: int = 1200) -> DataFrame:
    first = F.lit(start).cast("date")
    return academic_days_from(spark.range(days).select(F.date_add(first, F.col("id").cast("int")).alias("booking_date")))


# ---- bookings and what follows from them


def bookings_from(numbers: DataFrame, spaces: DataFrame, requesters: DataFrame, days: DataFrame) -> DataFrame:
    """One booking per number n from 0, as long as there are days.

    Rooms and requesters are numbered by id; ``requesters`` holds only people who book.
    """
    rooms = numbered(spaces.select("space_id", "capacity"), ["space_id"], "_room", start=-1)
    people = numbered(requesters.select("user_id"), ["user_id"], "_person", start=-1)
    room_count = spaces.agg(F.count("*")).scalar()
    person_count = requesters.agg(F.count("*")).scalar()
    keyed = (
        numbers.select("n", room_count.alias("_rooms"), person_count.alias("_people"))
        .selectExpr("n", "n % _rooms as _room", "n % _people as _person", "n div _rooms as _slot")
        .selectExpr("*", "_slot div 2 as academic_day_number")
    )
    joined = keyed.join(days, "academic_day_number").join(rooms, "_room").join(people, "_person")
    n, hundred = F.col("n"), F.col("n") % 100
    midnight = F.col("booking_date").cast("timestamp_ntz")
    start_hour = F.when(F.col("_slot") % 2 == 0, 9).otherwise(13)
    cancelled = hundred.between(85, 92)
    status = (
        F.when(hundred < 70, "Approved")
        .when(hundred < 80, "Completed")
        .when(hundred < 85, "NoShow")
        .when(hundred < 93, "Cancelled")
        .when(hundred < 98, "Rejected")
        .otherwise("Pending")
    )
    participants = F.expr("if(capacity < 10, capacity, 5 + n % (capacity - 4))")
    return joined.select(
        (n + 1).alias("booking_id"),
        F.col("user_id").alias("requester_user_id"),
        "space_id",
        shift_minutes(midnight, start_hour * 60).alias("requested_start_time"),
        shift_minutes(midnight, start_hour * 60 + 120).alias("requested_end_time"),
        _choice(n % 7, PURPOSES).alias("purpose"),
        participants.cast("int").alias("expected_participants"),
        status.alias("booking_status"),
        shift_minutes(midnight, (F.lit(-14) - n % 21) * 1440).alias("submitted_at"),
        F.when(cancelled, shift_minutes(midnight, -3 * 1440)).alias("cancelled_at"),
        F.when(cancelled, F.col("user_id")).alias("cancelled_by_user_id"),
        F.when(cancelled, F.lit("Made cancellation.")).alias("cancellation_note"),
        F.lit(None).cast("timestamp_ntz").alias("advisories_presented_at"),
        F.lit(None).cast("timestamp_ntz").alias("advisory_acknowledged_at"),
    )


def generate_bookings(
    spark: SparkSession,
    n: int,
    spaces: DataFrame,
    users: DataFrame,
    days: DataFrame | None = None,
    *,
    limits: tuple[int, int] | None = None,
) -> DataFrame:
    """``n`` bookings of the rooms by everyone who is not staff.

    Counts outside ``limits`` are refused, if given. Without ``days`` the calendar is as long
    as the bookings need; with days that are too few it is an error, so no booking is lost.
    """
    if limits and not limits[0] <= n <= limits[1]:
        raise ValueError(f"51200: the number of bookings must be between {limits[0]} and {limits[1]}")
    requesters = users.where(F.col("role") != "FacilityStaff")
    numbers = spark.range(n).withColumnRenamed("id", "n")
    if n == 0:
        needed = 0
    else:
        rooms = spaces.count()
        if rooms == 0:
            raise ValueError("bookings need rooms")
        needed = (n - 1) // rooms // 2 + 1  # two slots a day in every room
    if days is None:
        # at least 200 of 365 days are taught
        days = academic_days(spark, days=max(1200, needed * 365 // 200 + 365))
    elif days.where(F.col("academic_day_number") < needed).count() < needed:
        raise ValueError(f"{n} bookings need {needed} days")
    return bookings_from(numbers, spaces, requesters, days)


def _first_staff(users: DataFrame):
    return users.where(F.col("role") == "FacilityStaff").agg(F.min("user_id")).scalar()


def generate_decisions(bookings: DataFrame, users: DataFrame) -> DataFrame:
    """The decision on every booking that got one, a day after submission; its number is the booking's."""
    decided = bookings.where(F.col("booking_status").isin("Approved", "Completed", "NoShow", "Rejected"))
    rejected = F.col("booking_status") == "Rejected"
    return decided.select(
        F.col("booking_id").alias("decision_id"),
        "booking_id",
        _first_staff(users).alias("decision_maker_user_id"),
        shift_minutes("submitted_at", 1440).alias("decision_time"),
        F.when(rejected, "Rejected").otherwise("Approved").alias("decision"),
        F.lit("Made decision.").alias("decision_note"),
        F.when(rejected, F.lit("Made refusal.")).alias("rejection_reason"),
    )


def generate_maintenance(spaces: DataFrame, bookings: DataFrame, users: DataFrame) -> DataFrame:
    """A finished outage per room, and an open advisory 15 minutes into its latest approved booking.

    Numbers are 2 * room - 1 and 2 * room.
    """
    staff = _first_staff(users)
    outage_start = F.lit("2022-06-01 00:00:00").cast("timestamp_ntz")

    def record(rows: DataFrame, number, text, start, end, status: str, level: str, note) -> DataFrame:
        return rows.select(
            number.alias("maintenance_id"),
            "space_id",
            staff.alias("reporter_user_id"),
            staff.alias("assigned_staff_user_id"),
            text.alias("problem_description"),
            start.alias("start_time"),
            end.cast("timestamp_ntz").alias("completion_time"),
            F.lit(status).alias("maintenance_status"),
            F.lit(level).alias("impact_level"),
            note.cast("string").alias("result_note"),
        )

    double = F.col("space_id") * 2
    finished = record(
        spaces,
        double - 1,
        F.lit("Made outage."),
        outage_start,
        shift_minutes(outage_start, 240),
        "Completed",
        "out-of-service",
        F.lit("Over before the first booking."),
    )
    latest = (
        bookings.where(F.col("booking_status") == "Approved")
        .groupBy("space_id")
        .agg(F.max(F.struct("requested_start_time", "booking_id")).alias("last"))
    )
    text = F.concat(
        F.lit("Made advisory on booking "), F.col("last.booking_id").cast("string"), F.lit(": take care.")
    )
    start = shift_minutes("last.requested_start_time", 15)
    advisory = record(latest, double, text, start, F.lit(None), "InProgress", "advisory", F.lit(None))
    return finished.unionByName(advisory)


def generate_acks(bookings: DataFrame, maintenance: DataFrame) -> DataFrame:
    """An acknowledgement of every active advisory an approved booking overlaps, five minutes before its start."""
    approved = bookings.where(F.col("booking_status") == "Approved").select(
        "booking_id", "space_id", "requested_start_time", "requested_end_time"
    )
    advisories = maintenance.where(
        (F.col("maintenance_status") == "InProgress") & (F.col("impact_level") == "advisory")
    ).select("maintenance_id", "space_id", "problem_description", "start_time", "completion_time")
    return maintenance_overlaps(approved, advisories).select(
        "booking_id",
        "maintenance_id",
        shift_minutes("requested_start_time", -5).alias("acknowledged_at"),
        F.col("problem_description").alias("advisory_summary_at_acknowledgement"),
    )


def with_ack_times(bookings: DataFrame, acks: DataFrame) -> DataFrame:
    """The bookings, with the advisory times set on those that have an acknowledgement."""
    noticed = acks.select("booking_id").distinct().withColumn("_noticed", F.lit(True))
    joined = bookings.join(noticed, "booking_id", "left")
    times = {"advisories_presented_at": -5, "advisory_acknowledged_at": -4}
    changed = {
        c: F.when(F.col("_noticed"), shift_minutes("requested_start_time", shift)).otherwise(F.col(c))
        for c, shift in times.items()
    }
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in bookings.columns])


# ---- summary


def dataset_summary(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bookings with first start and last end; bookings per status; maintenance per level and status."""
    whole = t["booking"].agg(
        F.count("*").alias("generated_bookings"),
        F.min("requested_start_time").alias("first_booking"),
        F.max("requested_end_time").alias("last_booking"),
    )
    by_status = t["booking"].groupBy("booking_status").agg(F.count("*").alias("booking_count")).orderBy("booking_status")
    kind = ["impact_level", "maintenance_status"]
    by_level = t["maintenance"].groupBy(*kind).agg(F.count("*").alias("maintenance_count")).orderBy(*kind)
    return whole, by_status, by_level
