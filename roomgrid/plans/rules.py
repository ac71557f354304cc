"""Rule checks. Each returns the rows that break a rule: (rule, code, key, detail).

``batch`` stands for rows about to be added or changed: the check looks at those rows, and
compares them with the table as it will be, that is with the batch rows in place of rows of
the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomgrid.functions.exprs import open_end, overlaps
from roomgrid.operators.overlap import overlap_count, overlap_flags, self_overlap_flag
from roomgrid.plans.reports import active_maintenance, maintenance_overlaps
from roomgrid.schema import (
    ACTIVE_BOOKING,
    ACTIVE_MAINTENANCE,
    ADVISORY,
    ALTERNATE_KEYS,
    CLOSED_SPACE,
    DOMAIN_RULES,
    FOREIGN_KEYS,
    HELD_BOOKING,
    IMPACT_LEVELS,
    OPEN_BOOKING,
    OUT_OF_SERVICE,
    PERSONNEL,
    PRIMARY_KEYS,
    SCHEMAS,
    STATUS_CHANGES,
    TEXT_LIMITS,
)


def _text(value) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _joined(*parts, by: str = ":") -> Column:
    """Values as one text; NULL is written out, since a key may hold it."""
    return F.concat_ws(by, *[F.coalesce(_text(p), F.lit("NULL")) for p in parts])


def _violations(df: DataFrame, rule, code: int | None, key: Column, detail: Column) -> DataFrame:
    return df.select(
        (F.lit(rule) if isinstance(rule, str) else rule).alias("rule"),
        F.lit(code).cast("int").alias("code"),
        key.alias("key"),
        detail.alias("detail"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _active(df: DataFrame) -> DataFrame:
    return df.where(F.col("booking_status").isin(*ACTIVE_BOOKING)).select(
        "booking_id", "space_id", "requested_start_time", "requested_end_time"
    )


def v01_requester_active(t, batch: DataFrame | None = None) -> DataFrame:
    rows = (t["booking"] if batch is None else batch).select("booking_id", "requester_user_id")
    idle = t["app_user"].where(F.col("account_status") != "Active").select("user_id", "account_status")
    found = rows.join(idle, F.col("requester_user_id") == F.col("user_id"))
    return _violations(
        found, "requester_active", 51000, _text("booking_id"), _joined("requester_user_id", "account_status", by=" ")
    )


def v02_space_usable(t, batch: DataFrame | None = None) -> DataFrame:
    rows = (t["booking"] if batch is None else batch).select("booking_id", "space_id", "booking_status", "expected_participants")
    closed = F.col("booking_status").isin(*OPEN_BOOKING) & F.col("current_status").isin(*CLOSED_SPACE)
    found = rows.join(t["space"].select("space_id", "capacity", "current_status"), "space_id").where(
        closed | (F.col("expected_participants") > F.col("capacity"))
    )
    return _violations(
        found, "space_usable", 51001, _text("booking_id"), _joined("current_status", "expected_participants", "capacity", by=" ")
    )


def v03_booking_overlap(t, batch: DataFrame | None = None) -> DataFrame:
    """Active bookings that overlap another one; both of a pair are listed."""
    if batch is None:
        rows = _active(t["booking"])
    else:
        kept = t["booking"].join(batch.select("booking_id"), "booking_id", "left_anti")
        rows = (
            _active(kept).withColumn("_new", F.lit(False)).unionByName(_active(batch).withColumn("_new", F.lit(True)))
        )
    span = ("requested_start_time", "requested_end_time")
    found = self_overlap_flag(rows, ["space_id"], span, "booking_id", "_hit").where("_hit")
    if batch is not None:
        found = found.where("_new")
    return _violations(found, "booking_overlap", 51002, _text("booking_id"), _text("space_id"))


def v04_maintenance_block(t, batch: DataFrame | None = None, mode: str = "phase2") -> DataFrame:
    """Active bookings in the way of maintenance: of any level in phase 1, out-of-service only in phase 2."""
    levels = {"phase1": IMPACT_LEVELS, "phase2": (OUT_OF_SERVICE,)}[mode]
    found = overlap_flags(
        _active(t["booking"] if batch is None else batch),
        {"_hit": active_maintenance(t, levels).select("space_id", "start_time", "completion_time")},
        ["space_id"],
        ("requested_start_time", "requested_end_time"),
        ("start_time", "completion_time"),
        "booking_id",
    ).where("_hit")
    return _violations(found, "maintenance_block", 51003, _text("booking_id"), _text("space_id"))


def v05_missing_ack(t, batch: DataFrame | None = None) -> DataFrame:
    """Pairs of an active booking and an overlapping active advisory without an acknowledgement."""
    advisories = active_maintenance(t, (ADVISORY,)).select(
        "space_id", "maintenance_id", "problem_description", "start_time", "completion_time"
    )
    met = maintenance_overlaps(_active(t["booking"] if batch is None else batch), advisories)
    known = t["advisory_ack"].select("booking_id", "maintenance_id")
    found = met.join(known, ["booking_id", "maintenance_id"], "left_anti")
    return _violations(found, "missing_ack", 51011, _joined("booking_id", "maintenance_id"), F.col("problem_description"))


def v06_bad_ack(t, batch: DataFrame | None = None) -> DataFrame:
    acks = (t["advisory_ack"] if batch is None else batch).select("booking_id", "maintenance_id")
    bookings = t["booking"].select(
        "booking_id", F.col("space_id").alias("booked_space"), "requested_start_time", "requested_end_time"
    )
    records = t["maintenance"].select(
        "maintenance_id", "space_id", "maintenance_status", "impact_level", "start_time", "completion_time"
    )
    apart = ~overlaps("requested_start_time", "requested_end_time", F.col("start_time"), open_end("completion_time"))
    why = (
        F.when(F.col("booked_space") != F.col("space_id"), "other space")
        .when(~F.col("maintenance_status").isin(*ACTIVE_MAINTENANCE), "not active")
        .when(F.col("impact_level") != ADVISORY, "not an advisory")
        .when(apart, "no overlap")
    )
    found = acks.join(bookings, "booking_id").join(records, "maintenance_id").withColumn("_why", why)
    return _violations(
        found.where(F.col("_why").isNotNull()), "bad_ack", 51010, _joined("booking_id", "maintenance_id"), F.col("_why")
    )


def v07_session_authority(t, batch: DataFrame | None = None) -> DataFrame:
    rows = (t["usage_session"] if batch is None else batch).select(
        "usage_session_id", "booking_id", "check_in_by_user_id", "check_out_by_user_id"
    )

    def staff(name: str) -> DataFrame:
        return t["app_user"].select(F.col("user_id").alias(f"{name}_id"), F.col("role").alias(f"{name}_role"))

    joined = (
        rows.join(t["booking"].select("booking_id", "booking_status"), "booking_id")
        .join(staff("opener"), F.col("check_in_by_user_id") == F.col("opener_id"))
        .join(staff("closer"), F.col("check_out_by_user_id") == F.col("closer_id"), "left")
    )
    why = (
        F.when(~F.col("booking_status").isin(*HELD_BOOKING), "booking not approved")
        .when(~F.col("opener_role").isin(*PERSONNEL), "check-in without authority")
        .when(~F.col("closer_role").isin(*PERSONNEL), "check-out without authority")
    )
    found = joined.withColumn("_why", why).where(F.col("_why").isNotNull())
    return _violations(found, "session_authority", 51004, _text("usage_session_id"), F.col("_why"))


def v08_decision_authority(t, batch: DataFrame | None = None) -> DataFrame:
    rows = (t["booking_decision"] if batch is None else batch).select("decision_id", "decision_maker_user_id")
    barred = t["app_user"].where(~F.col("role").isin(*PERSONNEL) | (F.col("account_status") != "Active"))
    found = rows.join(
        barred.select("user_id", "role", "account_status"), F.col("decision_maker_user_id") == F.col("user_id")
    )
    return _violations(found, "decision_authority", 51005, _text("decision_id"), _joined("role", "account_status", by=" "))


def domain_conditions(table: str) -> dict[str, str]:
    """Rule name to the SQL condition a row must not break: row rules, required columns, text lengths."""
    rules = dict(DOMAIN_RULES.get(table, {}))
    for field in SCHEMAS[table]:
        if not field.nullable:
            rules[f"{table}.{field.name} required"] = f"{field.name} is not null"
    for column, limit in TEXT_LIMITS[table].items():
        rules[f"{table}.{column} length"] = f"length({column}) <= {limit}"
    return rules


def v09_domain_checks(t, batch: dict[str, DataFrame] | None = None) -> DataFrame:
    """All row rules of all tables, or of the tables in ``batch``. One pass per table, no shuffle."""
    parts = []
    for table, rows in (t if batch is None else batch).items():
        broken = [F.when(~F.expr(f"({condition})"), F.lit(name)) for name, condition in domain_conditions(table).items()]
        found = rows.withColumn("_rule", F.explode(F.array_compact(F.array(*broken))))
        parts.append(_violations(found, F.col("_rule"), None, _joined(*PRIMARY_KEYS[table]), F.lit(table)))
    return _union(parts)


def v10_unique_keys(t, batch: dict[str, DataFrame] | None = None) -> DataFrame:
    """Keys that occur more than once; NULL equals NULL. E-mail is also compared without case."""
    tables = t if batch is None else batch
    parts = []

    def repeated(rule: str, rows: DataFrame, keys: list[str]) -> None:
        counted = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
        parts.append(_violations(counted, rule, None, _joined(*keys), _text("_n")))

    for table in tables:
        repeated(f"{table} primary key", tables[table], PRIMARY_KEYS[table])
        if table in ALTERNATE_KEYS:
            repeated(f"{table} alternate key", tables[table], ALTERNATE_KEYS[table])
    if "app_user" in tables:
        repeated("app_user email ignoring case", tables["app_user"].select(F.lower("email").alias("email")), ["email"])
    return _union(parts)


def v11_orphans(t, batch: dict[str, DataFrame] | None = None) -> DataFrame:
    """Values of a reference that its parent table lacks; NULL passes.

    The distinct values are looked up, so neither a busy value nor the whole child table
    travels; only the (normally few) missing ones are joined back to their rows.
    """
    children = t if batch is None else batch
    parts = []
    for table, column, parent, parent_key in FOREIGN_KEYS:
        if table not in children:
            continue
        rows = children[table].select(*dict.fromkeys([*PRIMARY_KEYS[table], column])).where(F.col(column).isNotNull())
        present = t[parent].select(F.col(parent_key).alias("_missing"))
        missing = rows.select(F.col(column).alias("_missing")).distinct().join(present, "_missing", "left_anti")
        found = rows.join(missing, F.col(column) == F.col("_missing"))
        parts.append(_violations(found, f"{table}.{column}", None, _joined(*PRIMARY_KEYS[table]), _text("_missing")))
    return _union(parts)


def v12_ack_completeness(t, batch: DataFrame | None = None) -> DataFrame:
    """Active bookings with overlapping active advisories: how many, how many acknowledged, how many missing.

    Advisories are counted without forming pairs; acknowledgements are followed by their keys.
    """
    bookings = _active(t["booking"] if batch is None else batch)
    advisories = active_maintenance(t, (ADVISORY,)).select("maintenance_id", "space_id", "start_time", "completion_time")
    due = overlap_count(
        bookings,
        advisories,
        ["space_id"],
        ("requested_start_time", "requested_end_time"),
        ("start_time", "completion_time"),
        "booking_id",
        "overlapping_advisories",
    )
    meets = overlaps("requested_start_time", "requested_end_time", F.col("start_time"), open_end("completion_time"))
    given = (
        t["advisory_ack"]
        .select("booking_id", "maintenance_id")
        .join(advisories, "maintenance_id")
        .join(bookings, ["booking_id", "space_id"])
        .where(meets)
        .groupBy("booking_id")
        .agg(F.count("*").alias("acknowledged_advisories"))
    )
    return due.join(given, "booking_id", "left").select(
        "booking_id",
        "overlapping_advisories",
        F.coalesce("acknowledged_advisories", F.lit(0).cast("long")).alias("acknowledged_advisories"),
        (F.col("overlapping_advisories") - F.coalesce("acknowledged_advisories", F.lit(0).cast("long"))).alias(
            "missing_advisories"
        ),
    )


# places of the statuses in a booking's life, for events of one instant
_PLACES = ("Approved", "Rejected", "CheckedIn", "Completed", "NoShow", "Cancelled")


def status_events(t) -> DataFrame:
    """What asks for a change of a booking's status: booking_id, new_status, event_time, event_id, _at (their order)."""

    def event(time: str, status: Column, number: str) -> Column:
        return F.struct(F.col(time).alias("event_time"), status.alias("new_status"), F.col(number).alias("event_id"))

    def unfolded(df: DataFrame, *events: Column) -> DataFrame:
        rows = df.select("booking_id", F.explode(F.array(*events)).alias("e")).select("booking_id", "e.*")
        return rows.where("event_time is not null")

    decided = F.when(F.col("decision") == "Rejected", "Rejected").otherwise("Approved")
    events = _union(
        [
            unfolded(t["booking"], event("cancelled_at", F.lit("Cancelled"), "booking_id")),
            unfolded(t["booking_decision"], event("decision_time", decided, "decision_id")),
            unfolded(
                t["usage_session"],
                event("actual_start_time", F.lit("CheckedIn"), "usage_session_id"),
                event("actual_end_time", F.lit("Completed"), "usage_session_id"),
            ),
        ]
    )
    place = F.array_position(F.array(*map(F.lit, _PLACES)), F.col("new_status"))
    return events.withColumn("_at", F.struct("event_time", place.alias("place"), "event_id"))


def _may_follow(before: str, after: str) -> Column:
    rule = F.lit(False)
    for status, following in STATUS_CHANGES.items():
        rule = rule | ((F.col(before) == status) & F.col(after).isin(*following))
    return rule


def _longest_life() -> int:
    def length(status: str) -> int:
        return max((1 + length(s) for s in STATUS_CHANGES.get(status, ())), default=0)

    return length("Pending")


def status_steps(events: DataFrame) -> DataFrame:
    """Per booking that left Pending: ``_steps``, its legal changes (at, status) in order.

    A change that may not follow is refused and changes nothing, so the state is that of the last
    legal one. No status comes twice in a life: a life has at most as many changes as the longest
    way through ``STATUS_CHANGES``. The k-th is the first event after the one before it that may follow
    it: a minimum per booking, combined before the shuffle. No booking's events have to be
    sorted or held together, however many they are.
    """
    change = F.struct(F.col("_at").alias("at"), F.col("new_status").alias("status"))
    last = events.where(F.col("new_status").isin(*STATUS_CHANGES["Pending"])).groupBy("booking_id").agg(F.min(change).alias("_last"))
    lives = last.select("booking_id", F.array("_last").alias("_steps"))
    for _ in range(_longest_life() - 1):
        held = last.where(F.col("_last.status").isin(*STATUS_CHANGES)).select(
            F.col("booking_id").alias("_held"), F.col("_last.at").alias("_since"), F.col("_last.status").alias("_status")
        )
        last = (
            events.join(held, F.col("booking_id") == F.col("_held"))
            .where((F.col("_at") > F.col("_since")) & _may_follow("_status", "new_status"))
            .groupBy("booking_id")
            .agg(F.min(change).alias("_last"))
        )
        added = last.withColumnRenamed("booking_id", "_held")
        steps = F.when(F.col("_last").isNull(), F.col("_steps")).otherwise(F.array_append("_steps", F.col("_last")))
        lives = lives.join(added, F.col("booking_id") == F.col("_held"), "left").select("booking_id", steps.alias("_steps"))
    return lives


def v13_status_changes(t) -> DataFrame:
    """Events that ask for a status change the booking may not make at that time, with its status before.

    Events of one instant count in the order approval or refusal, check-in, check-out, cancellation.
    """
    events = status_events(t)
    lives = status_steps(events).withColumnRenamed("booking_id", "_of")
    done = F.filter("_steps", lambda s: s["at"] < F.col("_at"))
    return (
        events.join(lives, F.col("booking_id") == F.col("_of"), "left")
        .where(~F.coalesce(F.exists("_steps", lambda s: s["at"] == F.col("_at")), F.lit(False)))
        .select(
            "booking_id",
            "event_time",
            "event_id",
            F.coalesce(F.try_element_at(done, F.lit(-1))["status"], F.lit("Pending")).alias("status_before"),
            "new_status",
        )
    )


def v13_status_reached(t, batch: dict[str, DataFrame] | None = None) -> DataFrame:
    """Bookings whose stated status is not the one their events lead to.

    A no-show has no event of its own; it may be stated of an approved booking.
    """
    lives = status_steps(status_events(t)).withColumnRenamed("booking_id", "_of")
    stated = (batch or t)["booking"].select("booking_id", "booking_status")
    reached = F.coalesce(F.try_element_at("_steps", F.lit(-1))["status"], F.lit("Pending"))
    missed = (F.col("booking_status") == "NoShow") & _may_follow("reached_status", "booking_status")
    return (
        stated.join(lives, F.col("booking_id") == F.col("_of"), "left")
        .select("booking_id", "booking_status", reached.alias("reached_status"))
        .where(~F.col("booking_status").eqNullSafe(F.col("reached_status")) & ~F.coalesce(missed, F.lit(False)))
    )
