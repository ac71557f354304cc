"""The booking workflow over whole batches.

Each job takes a DataFrame of requests and returns outcomes with the code of the first rule
a request fails, NULL when it passes. Nothing is changed in place: jobs return the rows to
append and the new snapshot of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomgrid.functions.exprs import ntz, shift_minutes
from roomgrid.operators.first_come import MAX_ISLAND, first_come
from roomgrid.operators.overlap import overlap_flags, overlap_pairs, self_overlap_pairs
from roomgrid.operators.policy import with_policy
from roomgrid.operators.slices import neighbour, numbered
from roomgrid.plans.reports import active_maintenance, maintenance_overlaps
from roomgrid.schema import (
    CLOSED_SPACE,
    PURPOSES,
    ACTIVE_BOOKING,
    ACTIVE_MAINTENANCE,
    ADVISORY,
    IMPACT_LEVELS,
    OPEN_SPACE,
    OUT_OF_SERVICE,
    PERSONNEL,
)
from roomgrid.session import cut_lineage, release_shuffles

# Notes on recorded decisions.
AUTO_NOTE = "Automatic approval after transactional availability validation."
MANUAL_NOTE = "Manual approval after transactional availability validation."


def _first_code(*rules: tuple[Column, int]) -> Column:
    out = F.lit(None).cast("int")
    for broken, code in reversed(rules):
        out = F.when(broken, F.lit(code)).otherwise(out)
    return out


def _active_people(t, prefix: str, roles: tuple[str, ...] | None = None) -> DataFrame:
    people = t["app_user"].where(F.col("account_status") == "Active")
    if roles:
        people = people.where(F.col("role").isin(*roles))
    return people.select(F.col("user_id").alias(f"{prefix}_found"))


def _one_per(df: DataFrame, key: str) -> DataFrame:
    """The rows as they are; an error if a key comes twice."""
    rest = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.count("*").alias("_n"), F.min(F.struct(*rest)).alias("_row"))
    text = F.concat(F.lit(f"more than one row in the batch for {key} "), F.col(key).cast("string"))
    checked = grouped.where(F.when(F.col("_n") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True)))
    return checked.select(key, "_row.*").select(*df.columns)


def w01_validate_requests(t, requests: DataFrame) -> DataFrame:
    """New requests with their code; those without one become Pending.

    ``requests``: request_id, requester_user_id, space_id, start, end, purpose, participants,
    auto_approve, decision_maker_user_id, acknowledge. After the checks of the call come those
    of the insert: a room that is not there or a purpose that is not known (547, the server's
    number for a broken reference or check), a closed room or too many participants (51001).
    """
    people = _active_people(t, "requester")
    rooms = t["space"].select(F.col("space_id").alias("_room"), "capacity", "current_status")
    code = _first_code(
        (F.col("end") <= F.col("start"), 51030),
        (F.col("participants") <= 0, 51031),
        (F.col("requester_found").isNull(), 51032),
        (F.col("auto_approve") & F.col("decision_maker_user_id").isNull(), 51033),
        (F.col("_room").isNull() | ~F.coalesce(F.col("purpose").isin(*PURPOSES), F.lit(False)), 547),
        (F.col("current_status").isin(*CLOSED_SPACE) | (F.col("participants") > F.col("capacity")), 51001),
    )
    known = requests.join(people, F.col("requester_user_id") == F.col("requester_found"), "left")
    checked = known.join(rooms, F.col("space_id") == F.col("_room"), "left").withColumn("code", code)
    return checked.select(
        *requests.columns, "code", F.when(F.col("code").isNull(), F.lit("Pending")).alias("booking_status")
    )


def w12_create_and_approve(t, requests: DataFrame, as_of) -> tuple[DataFrame, object]:
    """Create bookings from new requests and decide those that ask for it at once.

    Returns (request_id, booking_id, code, decision, booking_status) per request, and the
    tables with the bookings, acknowledgements and decisions added. Accepted requests get the
    booking numbers after the highest in use, in order of request_id, and are submitted at
    ``as_of``. A booking whose approval is refused stays Pending; ``code`` says why.
    """
    checked = cut_lineage(w01_validate_requests(t, requests))
    accepted = _next_numbers(checked.where(F.col("code").isNull()), ["request_id"], t["booking"], "booking_id")
    accepted = cut_lineage(accepted)
    none = {name: F.lit(None).cast(kind) for name, kind in t["booking"].dtypes}
    given = {
        "booking_id": F.col("booking_id"),
        "requester_user_id": F.col("requester_user_id"),
        "space_id": F.col("space_id"),
        "requested_start_time": F.col("start"),
        "requested_end_time": F.col("end"),
        "purpose": F.col("purpose"),
        "expected_participants": F.col("participants"),
        "booking_status": F.lit("Pending"),
        "submitted_at": ntz(as_of),
    }
    rows = accepted.select(*[given.get(name, none[name]).cast(kind).alias(name) for name, kind in t["booking"].dtypes])
    inserted = cut_lineage(t["booking"].unionByName(rows))
    now = t.replace(booking=inserted)
    wanted = accepted.where(F.col("auto_approve")).select("booking_id", "decision_maker_user_id", F.lit(True).alias("is_auto"), "acknowledge")
    outcomes = cut_lineage(w05_approve_batch(now, wanted))
    after = t.replace(
        booking=w07_booking_snapshot(now, outcomes, as_of),
        advisory_ack=t["advisory_ack"].unionByName(w06_record_acks(now, outcomes, as_of)),
        booking_decision=t["booking_decision"].unionByName(w07_record_decisions(now, outcomes, as_of)),
    )
    decided = outcomes.select("booking_id", F.col("code").alias("_late"), "decision")
    status = F.when(F.col("decision").isNotNull(), F.lit("Approved")).otherwise(F.lit("Pending"))
    made = accepted.join(decided, "booking_id", "left").select(
        "request_id", "booking_id", F.col("_late").alias("code"), "decision", status.alias("booking_status")
    )
    refused = checked.where(F.col("code").isNotNull()).select(
        "request_id", F.lit(None).cast("long").alias("booking_id"), "code", F.lit(None).cast("string").alias("decision"), "booking_status"
    )
    return made.unionByName(refused), after


def pending_bookings(t) -> DataFrame:
    return t["booking"].where(F.col("booking_status") == "Pending")


def w03_resolve_policy(t, pending: DataFrame) -> DataFrame:
    """Bookings with the policy that counts, their interval with its buffers, and ``auto_allowed``."""
    people = t["app_user"].select(F.col("user_id").alias("_user"), F.col("role").alias("_role"))
    known = pending.join(people, F.col("requester_user_id") == F.col("_user"), "left")
    none = F.lit(0)
    return with_policy(known, t["booking_policy"], role="_role").select(
        *pending.columns,
        "policy_id",
        shift_minutes("requested_start_time", -F.coalesce("pre_buffer_minutes", none)).alias("effective_start"),
        shift_minutes("requested_end_time", F.coalesce("post_buffer_minutes", none)).alias("effective_end"),
        "auto_allowed",
    )


def w04_auto_approval_allowed(t, pending: DataFrame) -> DataFrame:
    """(booking_id, allowed): does any matching policy allow automatic approval?"""
    return w03_resolve_policy(t, pending).select("booking_id", F.col("auto_allowed").alias("allowed"))


def _booked(t, buffered: bool) -> DataFrame:
    """Active bookings with the interval they block."""
    active = t["booking"].where(F.col("booking_status").isin(*ACTIVE_BOOKING)).select(
        "booking_id", "space_id", "requester_user_id", "purpose", "requested_start_time", "requested_end_time"
    )
    start, end = F.col("requested_start_time"), F.col("requested_end_time")
    if buffered:
        active = w03_resolve_policy(t, active)
        start, end = F.col("effective_start"), F.col("effective_end")
    return active.select("space_id", F.col("booking_id").alias("taken_by"), start.alias("taken_from"), end.alias("taken_until"))


def w02_conflict_check(t, pending: DataFrame, *, buffer_both: bool = False) -> DataFrame:
    """(booking_id, conflicting_booking_id): active bookings in the way of the requests.

    A request counts with its buffers, an existing booking without, unless ``buffer_both``.
    """
    wanted = w03_resolve_policy(t, pending).select("space_id", "booking_id", "effective_start", "effective_end")
    pairs = overlap_pairs(
        _booked(t, buffer_both), wanted, ["space_id"], ("taken_from", "taken_until"), ("effective_start", "effective_end")
    )
    return pairs.where(F.col("taken_by") != F.col("booking_id")).select(
        "booking_id", F.col("taken_by").alias("conflicting_booking_id")
    )


def _stated(t) -> DataFrame:
    """Bookings with what the first gates look at."""
    return t["booking"].select(
        "booking_id",
        "space_id",
        "requester_user_id",
        "purpose",
        "expected_participants",
        "booking_status",
        "submitted_at",
        "requested_start_time",
        "requested_end_time",
    )


def _with_facts(t, bookings: DataFrame) -> DataFrame:
    """Add the policy, the active requester and the open room. Both looks at the requester follow each other: one shuffle."""
    rooms = t["space"].where(F.col("current_status").isin(*OPEN_SPACE)).select(
        F.col("space_id").alias("open_space"), "capacity"
    )
    known = bookings.join(_active_people(t, "requester"), F.col("requester_user_id") == F.col("requester_found"), "left")
    return w03_resolve_policy(t, known).join(rooms, F.col("space_id") == F.col("open_space"), "left")


def first_gates() -> Column:
    """The code of the first broken rule that does not depend on other requests."""
    return _first_code(
        (F.col("booking_status").isNull(), 51034),
        (F.col("booking_status") != "Pending", 51036),
        (F.col("maker_found").isNull(), 51037),
        (F.col("requester_found").isNull(), 51038),
        (F.col("open_space").isNull() | (F.col("capacity") < F.col("expected_participants")), 51039),
        (F.col("is_auto") & ~F.col("auto_allowed"), 51040),
    )


def standing_gate() -> Column:
    """The part of ``first_gates`` that a booking answers by itself; 0 where it passes."""
    code = _first_code(
        (F.col("booking_status").isNull(), 51034),
        (F.col("booking_status") != "Pending", 51036),
        (F.col("requester_found").isNull(), 51038),
        (F.col("open_space").isNull() | (F.col("capacity") < F.col("expected_participants")), 51039),
    )
    return F.coalesce(code, F.lit(0))


def known_gates() -> Column:
    """``first_gates`` of a command that was joined to ``standing_facts`` and to its maker."""
    gate = F.col("gate")
    return _first_code(
        (gate.isNull() | (gate == 51034), 51034),  # no such booking, or one without a status
        (gate == 51036, 51036),
        (F.col("maker_found").isNull(), 51037),
        (gate > 0, gate),
        (F.col("is_auto") & ~F.col("auto_allowed"), 51040),
    )


def standing_facts(t, *, buffer_both: bool = False) -> DataFrame:
    """All bookings with their gate (``standing_gate``), and for pending ones what else an approval looks at.

    The static side of the approval stream: the requested interval, the one with buffers, ``auto_allowed``,
    ``taken`` (by an active booking) and ``met``, the active maintenance records a booking overlaps, as
    (maintenance_id, impact_level). Of a booking that is decided the gate says enough.
    """
    wide = ("effective_start", "effective_end")
    late = ["purpose", "expected_participants", "requested_start_time", "requested_end_time"]
    stated = _stated(t).drop("submitted_at").withColumns({c: F.when(F.col("booking_status") == "Pending", F.col(c)) for c in late})
    facts = cut_lineage(
        _with_facts(t, stated).select(
            "booking_id", "space_id", standing_gate().alias("gate"), "auto_allowed", "requested_start_time", "requested_end_time", *wide
        )
    )
    release_shuffles(facts.sparkSession)
    pending = facts.where(~F.col("gate").isin(51034, 51036)).select(
        "booking_id", "space_id", "requested_start_time", "requested_end_time", *wide
    )
    probes = pending.select("booking_id", "space_id", *wide)
    taken = overlap_flags(
        probes, {"taken": _booked(t, buffer_both)}, ["space_id"], wide, ("taken_from", "taken_until"), "booking_id"
    ).select("booking_id", "taken")
    records = active_maintenance(t).select("space_id", "maintenance_id", "impact_level", "start_time", "completion_time")
    met = (
        maintenance_overlaps(pending.drop(*wide), records)
        .groupBy("booking_id")
        .agg(F.collect_list(F.struct("maintenance_id", "impact_level")).alias("met"))
    )
    return facts.join(taken, "booking_id", "left").join(met, "booking_id", "left")


def _blocking(t) -> dict[str, DataFrame]:
    span = ["space_id", "start_time", "completion_time"]
    return {
        "outage": active_maintenance(t, (OUT_OF_SERVICE,)).select(*span),
        "notice": active_maintenance(t, (ADVISORY,)).select(*span),
    }


def w05_approve_batch(
    t, approvals: DataFrame, *, buffer_both: bool = False, max_island: int = MAX_ISLAND
) -> DataFrame:
    """Decide approvals: (booking_id, decision_maker_user_id, code, decision), one row each.

    ``approvals``: booking_id, decision_maker_user_id, is_auto, acknowledge. The rules apply
    in order; requests for one room are served by (submitted_at, booking_id), so an approved
    one blocks those after it. Who fails later rules (outage, advisory) takes no time, but
    still hears first that the time is taken.
    """
    once = _one_per(approvals, "booking_id")
    # only the bookings asked for are looked up further; of those that are decided the status says enough
    late = ["purpose", "expected_participants", "submitted_at", "requested_start_time", "requested_end_time"]
    stated = _stated(t).withColumns({c: F.when(F.col("booking_status") == "Pending", F.col(c)) for c in late})
    known = _with_facts(t, once.join(stated, "booking_id", "left")).join(
        _active_people(t, "maker", PERSONNEL), F.col("decision_maker_user_id") == F.col("maker_found"), "left"
    )
    # read several times below
    gated = cut_lineage(
        known.withColumn("code", first_gates())
        .select(
            *once.columns,
            "space_id",
            "submitted_at",
            "requested_start_time",
            "requested_end_time",
            "effective_start",
            "effective_end",
            "code",
        )
    )
    raw, wide = ("requested_start_time", "requested_end_time"), ("effective_start", "effective_end")
    room = ["space_id"]
    passing = gated.where(F.col("code").isNull())
    passed = cut_lineage(
        overlap_flags(passing, {"taken": _booked(t, buffer_both)}, room, wide, ("taken_from", "taken_until"), "booking_id")
    )
    checked = overlap_flags(passed, _blocking(t), room, raw, ("start_time", "completion_time"), "booking_id")
    later = _first_code((F.col("outage"), 51042), (F.col("notice") & ~F.col("acknowledge"), 51043))
    decided = cut_lineage(
        checked.select(*gated.drop("code").columns, F.when(F.col("taken"), F.lit(51041)).otherwise(later).alias("code"))
    )
    takers = decided.where(F.col("code").isNull())
    narrow = wide if buffer_both else raw
    served = cut_lineage(
        first_come(takers, room, ["submitted_at", "booking_id"], narrow, wide, "booking_id", max_island=max_island)
    )
    taken_now = (
        takers.join(served.where("accepted"), "booking_id")
        .select(
            "space_id",
            F.col("booking_id").alias("by"),
            F.col(narrow[0]).alias("by_from"),
            F.col(narrow[1]).alias("by_until"),
            F.col("submitted_at").alias("by_at"),
        )
    )
    # refused for a later rule: was the time already taken in this batch?
    late = decided.where(F.col("code").isin(51042, 51043))
    met = (
        overlap_pairs(
            taken_now,
            late.select("space_id", "booking_id", "submitted_at", *wide),
            room,
            ("by_from", "by_until"),
            wide,
        )
        .where(
            (F.col("by_at") < F.col("submitted_at"))
            | ((F.col("by_at") == F.col("submitted_at")) & (F.col("by") < F.col("booking_id")))
        )
        .select("booking_id")
        .distinct()
        .withColumn("met", F.lit(True))
    )
    result = ["booking_id", "decision_maker_user_id", "is_auto", "code"]
    done = (
        gated.where(F.col("code").isNotNull())
        .select(result)
        .unionByName(decided.where(F.col("code") == 51041).select(result))
        .unionByName(
            late.join(met, "booking_id", "left")
            .withColumn("code", F.when(F.col("met"), F.lit(51041)).otherwise(F.col("code")))
            .select(result)
        )
        .unionByName(
            takers.join(served, "booking_id").withColumn("code", F.when(~F.col("accepted"), F.lit(51041))).select(result)
        )
    )
    decision = F.when(F.col("code").isNull(), F.when(F.col("is_auto"), F.lit("AutoApproved")).otherwise(F.lit("Approved")))
    return done.select("booking_id", "decision_maker_user_id", "code", decision.alias("decision"))


def w05_approve_attempts(t, attempts: DataFrame, *, buffer_both: bool = False) -> DataFrame:
    """Decide approvals of which a booking may have several: (booking_id, attempt, decision_maker_user_id, code, decision).

    ``attempts``: booking_id, attempt (its place among those of the booking), decision_maker_user_id,
    is_auto, acknowledge. Bookings of a room are served as in ``w05_approve_batch``, the attempts
    of one in their order: the first that breaks no rule approves it, those after it find it
    decided (51036). Nothing else happens between a booking's attempts, so they see the same
    room: one attempt stands for the booking in the batch, the first that could succeed, else
    the first that reaches the rules about its time. Two first attempts are an error.
    """
    makers = _active_people(t, "maker", PERSONNEL)
    facts = standing_facts(t, buffer_both=buffer_both).withColumnRenamed("booking_id", "_known")
    levels = F.coalesce(F.col("met.impact_level"), F.array().cast("array<string>"))
    blocked = _first_code(
        (F.coalesce("taken", F.lit(False)), 51041),
        (F.array_contains(levels, OUT_OF_SERVICE), 51042),
        (F.array_contains(levels, ADVISORY) & ~F.col("acknowledge"), 51043),
    )
    coded = cut_lineage(
        attempts.join(facts, F.col("booking_id") == F.col("_known"), "left")
        .join(makers, F.col("decision_maker_user_id") == F.col("maker_found"), "left")
        .select(*attempts.columns, known_gates().alias("gate"), blocked.alias("blocked"))
    )
    row = F.struct(
        F.coalesce("gate", "blocked").isNotNull().alias("fails"), F.col("gate").isNotNull().alias("gated"), "attempt", "decision_maker_user_id", "is_auto", "acknowledge"
    )
    chosen = cut_lineage(coded.groupBy("booking_id").agg(F.min(row).alias("row")).select("booking_id", "row.*"))
    served = w05_approve_batch(t, chosen.select("booking_id", "decision_maker_user_id", "is_auto", "acknowledge"), buffer_both=buffer_both)
    outcome = chosen.select(F.col("booking_id").alias("_booking"), F.col("attempt").alias("_attempt")).join(
        served.select(F.col("booking_id").alias("_served"), F.col("code").alias("_code"), "decision"), F.col("_booking").eqNullSafe(F.col("_served"))
    )
    code = (
        F.when(F.col("attempt") == F.col("_attempt"), F.col("_code"))
        .when(F.col("decision").isNotNull() & (F.col("attempt") > F.col("_attempt")), 51036)
        .when(F.col("gate").isNotNull(), F.col("gate"))
        .when(F.col("_code") == 51041, 51041)
        .otherwise(F.col("blocked"))
    )
    found = coded.join(outcome, F.col("booking_id").eqNullSafe(F.col("_booking"))).withColumn("code", code)
    return found.select("booking_id", "attempt", "decision_maker_user_id", "code", F.when(F.col("code").isNull(), F.col("decision")).alias("decision"))


def _approved(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("code").isNull()).select("booking_id", "decision_maker_user_id", "decision")


def _advisories_met(t, outcomes: DataFrame) -> DataFrame:
    wanted = t["booking"].select("booking_id", "space_id", "requested_start_time", "requested_end_time").join(
        _approved(outcomes).select("booking_id"), "booking_id", "left_semi"
    )
    return maintenance_overlaps(
        cut_lineage(wanted),  # read twice
        active_maintenance(t, (ADVISORY,)).select(
            "space_id", "maintenance_id", "problem_description", "start_time", "completion_time"
        ),
    )


def w06_record_acks(t, outcomes: DataFrame, as_of) -> DataFrame:
    """Acknowledgements of the approved requests, one per overlapping advisory not yet acknowledged."""
    known = t["advisory_ack"].select("booking_id", "maintenance_id")
    return (
        _advisories_met(t, outcomes)
        .join(known, ["booking_id", "maintenance_id"], "left_anti")
        .select(
            "booking_id",
            "maintenance_id",
            ntz(as_of).alias("acknowledged_at"),
            F.col("problem_description").alias("advisory_summary_at_acknowledgement"),
        )
    )


def _next_numbers(rows: DataFrame, order: list[str], existing: DataFrame, key: str) -> DataFrame:
    """Number new rows after the highest key in use."""
    highest = existing.agg(F.coalesce(F.max(key), F.lit(0).cast("long"))).scalar()
    return numbered(rows, order, "_number").withColumn(key, F.col("_number") + highest).drop("_number")


def _still_pending(t, outcomes: DataFrame) -> DataFrame:
    pending = pending_bookings(t).select("booking_id")
    return _approved(outcomes).join(pending, "booking_id", "left_semi")


def w07_record_decisions(t, outcomes: DataFrame, as_of) -> DataFrame:
    """Decision rows of the approved requests that are still pending."""
    rows = _next_numbers(_still_pending(t, outcomes), ["booking_id"], t["booking_decision"], "decision_id")
    automatic = F.col("decision") == "AutoApproved"
    return rows.select(
        "decision_id",
        "booking_id",
        "decision_maker_user_id",
        ntz(as_of).alias("decision_time"),
        "decision",
        F.when(automatic, F.lit(AUTO_NOTE)).otherwise(F.lit(MANUAL_NOTE)).alias("decision_note"),
        F.lit(None).cast("string").alias("rejection_reason"),
    )


def w07_booking_snapshot(t, outcomes: DataFrame, as_of) -> DataFrame:
    """The bookings after the batch: Pending becomes Approved, and advisory times are set where some applied."""
    approved = _still_pending(t, outcomes).select("booking_id", F.lit(True).alias("_approved"))
    noticed = _advisories_met(t, outcomes).select("booking_id").distinct().withColumn("_noticed", F.lit(True))
    now = ntz(as_of)
    joined = t["booking"].join(approved, "booking_id", "left").join(noticed, "booking_id", "left")
    changed = {
        "booking_status": F.when(F.col("_approved"), F.lit("Approved")).otherwise(F.col("booking_status")),
        "advisories_presented_at": F.when(
            F.col("_approved") & F.col("_noticed"), F.coalesce("advisories_presented_at", now)
        ).otherwise(F.col("advisories_presented_at")),
        "advisory_acknowledged_at": F.when(F.col("_approved") & F.col("_noticed"), now).otherwise(
            F.col("advisory_acknowledged_at")
        ),
    }
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in t["booking"].columns])


def w08_change_impact_level(t, changes: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Outcomes of level changes: maintenance_id, prior and new level, user_id, note, code, changed.

    ``changes``: maintenance_id, new_level, user_id, note. One change per record and batch,
    unless ``order`` names columns that put them in a total order; then each accepted change
    starts from the one before it, and the result keeps those columns.
    """
    records = t["maintenance"].select(
        F.col("maintenance_id").alias("_record"),
        F.when(F.col("maintenance_status").isin(*ACTIVE_MAINTENANCE), F.col("impact_level")).alias("prior_impact_level"),
    )
    joined = (
        (changes if order else _one_per(changes, "maintenance_id"))
        .join(records, F.col("maintenance_id") == F.col("_record"), "left")
        .join(_active_people(t, "changer", PERSONNEL), F.col("user_id") == F.col("changer_found"), "left")
    )
    code = _first_code(
        (~F.col("new_level").isin(*IMPACT_LEVELS), 51045),
        (F.col("_record").isNull(), 51046),
        (F.col("prior_impact_level").isNull(), 51048),
        (F.col("changer_found").isNull(), 51049),
    )
    outcomes = joined.select(
        "maintenance_id",
        "prior_impact_level",
        F.col("new_level").alias("new_impact_level"),
        "user_id",
        "note",
        *(order or []),
        code.alias("code"),
    )
    if order:
        valid = neighbour(outcomes.where("code is null"), ["maintenance_id"], order, "new_impact_level", "_before")
        valid = valid.withColumn("prior_impact_level", F.coalesce("_before", "prior_impact_level")).drop("_before")
        outcomes = valid.unionByName(outcomes.where("code is not null"))
    changed = F.coalesce(F.col("prior_impact_level") != F.col("new_impact_level"), F.lit(False))
    return outcomes.withColumn("changed", F.col("code").isNull() & changed)


def w08_impact_history(t, outcomes: DataFrame, as_of, order: list[str] | None = None) -> DataFrame:
    """History rows of the changes that changed something."""
    sequence = ["maintenance_id", *(order or [])]
    rows = _next_numbers(outcomes.where("changed"), sequence, t["impact_history"], "impact_history_id")
    return rows.select(
        "impact_history_id",
        "maintenance_id",
        "prior_impact_level",
        "new_impact_level",
        F.col("user_id").alias("changed_by_user_id"),
        ntz(as_of).alias("changed_at"),
        F.col("note").alias("change_note"),
    )


def w08_maintenance_snapshot(t, outcomes: DataFrame) -> DataFrame:
    """The maintenance table with the new levels."""
    levels = outcomes.where("changed").select("maintenance_id", F.col("new_impact_level").alias("_level"))
    joined = t["maintenance"].join(levels, "maintenance_id", "left")
    return joined.withColumn("impact_level", F.coalesce("_level", "impact_level")).select(*t["maintenance"].columns)


def w09_escalation_impacts(t, outcomes: DataFrame, as_of=None) -> DataFrame:
    """One row to follow up per booking hit by an advisory that became an outage; known pairs are not repeated.

    Outcomes with a time ``at`` of their own give the time of the row, others ``as_of``.
    """
    raised = outcomes.where(
        F.col("changed") & (F.col("prior_impact_level") == ADVISORY) & (F.col("new_impact_level") == OUT_OF_SERVICE)
    )
    # with several escalations of one record in a batch, the earliest finds the bookings
    sequence = [c for c in raised.columns if c not in ("maintenance_id", "prior_impact_level", "new_impact_level", "note", "code", "changed")]
    timed = "at" in sequence
    sequence = ["at"] * timed + [c for c in sequence if c not in ("user_id", "at")] + ["user_id"]
    raised = raised.groupBy("maintenance_id").agg(F.min(F.struct(*sequence)).alias("_first")).select(
        "maintenance_id", "_first.user_id", (F.col("_first.at") if timed else ntz(as_of)).alias("_at")
    )
    records = t["maintenance"].select("maintenance_id", "space_id", "start_time", "completion_time").join(raised, "maintenance_id")
    bookings = t["booking"].where(F.col("booking_status").isin(*ACTIVE_BOOKING)).select(
        "booking_id", "space_id", "requested_start_time", "requested_end_time"
    )
    pair = ["maintenance_id", "booking_id"]
    fresh = (
        maintenance_overlaps(bookings, records)
        .select(*pair, "user_id", "_at")
        .join(t["booking_impact"].select(*pair), pair, "left_anti")
    )
    rows = _next_numbers(fresh, pair, t["booking_impact"], "maintenance_booking_impact_id")
    return rows.select(
        "maintenance_booking_impact_id",
        *pair,
        F.col("_at").alias("identified_at"),
        F.col("user_id").alias("identified_by_user_id"),
        F.lit("PendingContact").alias("contact_status"),
        F.lit(None).cast("timestamp_ntz").alias("contacted_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(None).cast("long").alias("resolved_by_user_id"),
        F.lit(None).cast("string").alias("resolution"),
        F.lit(None).cast("string").alias("resolution_note"),
    )


def w10_verify_approvals(t, space_id: int, start, end) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For one room and window: its bookings, how many are approved, and pairs of active ones that overlap.

    The pairs are looked for in the whole room, not only in the window.
    """
    room = t["booking"].where(F.col("space_id") == space_id).select(
        "space_id", "booking_id", "booking_status", "requested_start_time", "requested_end_time"
    )
    due = room.where((F.col("requested_start_time") >= ntz(start)) & (F.col("requested_start_time") < ntz(end)))
    listed = due.drop("space_id").orderBy("booking_id")
    approved = due.agg(F.count(F.when(F.col("booking_status") == "Approved", 1)).alias("approved_booking_count"))
    active = room.where(F.col("booking_status").isin(*ACTIVE_BOOKING)).drop("booking_status")
    pairs = self_overlap_pairs(active, ["space_id"], ("requested_start_time", "requested_end_time"), "booking_id").select(
        F.least("booking_id", "booking_id_2").alias("first_booking_id"),
        F.greatest("booking_id", "booking_id_2").alias("second_booking_id"),
    )
    return listed, approved, pairs


def w11_verify_escalation(t, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For pairs (booking_id, maintenance_id): how many acknowledgements there are, and the follow-up rows."""
    pair = ["booking_id", "maintenance_id"]
    acks = t["advisory_ack"].select(*pair, F.lit(1).alias("_ack"))
    counted = pairs.join(acks, pair, "left").groupBy(*pair).agg(F.count("_ack").alias("advisory_acknowledgement_count"))
    impacts = (
        t["booking_impact"]
        .select(*pair, "contact_status")
        .join(pairs, pair, "left_semi")
        .join(t["maintenance"].select("maintenance_id", "impact_level"), "maintenance_id")
        .select("maintenance_id", "booking_id", "contact_status", "impact_level")
    )
    return counted, impacts
