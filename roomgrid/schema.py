"""The twelve tables: columns, keys, references, domain rules and status sets."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "l": T.LongType(),
    "i": T.IntegerType(),
    "t": T.TimestampNTZType(),
    "b": T.BooleanType(),
}

# Table layout, "name:type" with "?" for columns that may be NULL and
# the longest text allowed after "/".
_LAYOUT = {
    "app_user": "user_id:l full_name:s/150 email:s/254 phone_number:s?/30 role:s/30 department:s/100 account_status:s/20",
    "space": "space_id:l space_code:s/30 space_name:s/150 space_type:s/40 building:s/80 floor:s/20 room_number:s/30 "
    "capacity:i current_status:s/30 usage_policy:s?/1000",
    "facility": "facility_id:l facility_name:s/100 facility_type:s/50 description:s?/500",
    "space_facility": "space_id:l facility_id:l quantity:i notes:s?/500",
    "booking_policy": "policy_id:l space_id:l? applicable_role:s?/30 applicable_purpose:s?/40 minimum_lead_minutes:i "
    "cancellation_lead_minutes:i pre_buffer_minutes:i post_buffer_minutes:i auto_approval_enabled:b",
    "booking": "booking_id:l requester_user_id:l space_id:l requested_start_time:t requested_end_time:t purpose:s/40 "
    "expected_participants:i booking_status:s/20 submitted_at:t cancelled_at:t? cancelled_by_user_id:l? "
    "cancellation_note:s?/1000 advisories_presented_at:t? advisory_acknowledged_at:t?",
    "booking_decision": "decision_id:l booking_id:l decision_maker_user_id:l decision_time:t decision:s/20 "
    "decision_note:s?/1000 rejection_reason:s?/1000",
    "usage_session": "usage_session_id:l booking_id:l check_in_by_user_id:l actual_start_time:t initial_condition:s/1000 "
    "check_out_by_user_id:l? actual_end_time:t? final_condition:s?/1000 usage_notes:s?/1000",
    "maintenance": "maintenance_id:l space_id:l reporter_user_id:l assigned_staff_user_id:l? problem_description:s/2000 "
    "start_time:t completion_time:t? maintenance_status:s/30 impact_level:s/20 result_note:s?/2000",
    "advisory_ack": "booking_id:l maintenance_id:l acknowledged_at:t advisory_summary_at_acknowledgement:s?/2000",
    "impact_history": "impact_history_id:l maintenance_id:l prior_impact_level:s?/20 new_impact_level:s/20 "
    "changed_by_user_id:l changed_at:t change_note:s/1000",
    "booking_impact": "maintenance_booking_impact_id:l maintenance_id:l booking_id:l identified_at:t "
    "identified_by_user_id:l contact_status:s/30 contacted_at:t? resolved_at:t? resolved_by_user_id:l? "
    "resolution:s?/30 resolution_note:s?/1000",
}


def _parse(layout: str) -> tuple[T.StructType, dict[str, int]]:
    fields, limits = [], {}
    for item in layout.split():
        name, kind = item.split(":")
        kind, _, limit = kind.partition("/")
        fields.append(T.StructField(name, _TYPES[kind[0]], kind.endswith("?")))
        if limit:
            limits[name] = int(limit)
    return T.StructType(fields), limits


SCHEMAS: dict[str, T.StructType] = {}
TEXT_LIMITS: dict[str, dict[str, int]] = {}
for _name, _layout in _LAYOUT.items():
    SCHEMAS[_name], TEXT_LIMITS[_name] = _parse(_layout)

TABLES = tuple(SCHEMAS)

# Status sets. The three booking sets differ on purpose, each report names its own.
ACTIVE_BOOKING = ("Approved", "CheckedIn")
HELD_BOOKING = ("Approved", "CheckedIn", "Completed")
USABLE_BOOKING = ("Approved", "CheckedIn", "Completed", "NoShow")
OPEN_BOOKING = ("Pending", "Approved", "CheckedIn")
ACTIVE_MAINTENANCE = ("Reported", "Assigned", "InProgress")
OPEN_SPACE = ("Available", "InUse")
CLOSED_SPACE = ("UnderMaintenance", "TemporarilyClosed", "Retired")
PERSONNEL = ("FacilityStaff", "FacilityManager")
ADVISORY, OUT_OF_SERVICE = "advisory", "out-of-service"
IMPACT_LEVELS = (ADVISORY, OUT_OF_SERVICE)

# The status changes a booking may make; it begins as Pending.
STATUS_CHANGES = {
    "Pending": ("Approved", "Rejected", "Cancelled"),
    "Approved": ("Cancelled", "CheckedIn", "NoShow"),
    "CheckedIn": ("Completed",),
}

PRIMARY_KEYS = {
    "app_user": ["user_id"],
    "space": ["space_id"],
    "facility": ["facility_id"],
    "space_facility": ["space_id", "facility_id"],
    "booking_policy": ["policy_id"],
    "booking": ["booking_id"],
    "booking_decision": ["decision_id"],
    "usage_session": ["usage_session_id"],
    "maintenance": ["maintenance_id"],
    "advisory_ack": ["booking_id", "maintenance_id"],
    "impact_history": ["impact_history_id"],
    "booking_impact": ["maintenance_booking_impact_id"],
}

ALTERNATE_KEYS = {
    "app_user": ["email"],
    "space": ["space_code"],
    "facility": ["facility_name", "facility_type"],
    "booking_policy": ["space_id", "applicable_role", "applicable_purpose"],
    "usage_session": ["booking_id"],
    "booking_impact": ["maintenance_id", "booking_id"],
}

# Natural keys of the rerunnable load.
NATURAL_KEYS = {
    "app_user": ["email"],
    "space": ["space_code"],
    "facility": ["facility_name", "facility_type"],
    "space_facility": ["space_id", "facility_id"],
    "booking_policy": ["space_id", "applicable_role", "applicable_purpose"],
    "maintenance": ["space_id", "problem_description"],
    "booking": ["requester_user_id", "requested_start_time"],
    "booking_decision": ["booking_id", "decision"],
    "usage_session": ["booking_id"],
}

# (table, column, parent table, parent key)
FOREIGN_KEYS = [
    ("space_facility", "space_id", "space", "space_id"),
    ("space_facility", "facility_id", "facility", "facility_id"),
    ("booking_policy", "space_id", "space", "space_id"),
    ("booking", "requester_user_id", "app_user", "user_id"),
    ("booking", "space_id", "space", "space_id"),
    ("booking", "cancelled_by_user_id", "app_user", "user_id"),
    ("booking_decision", "booking_id", "booking", "booking_id"),
    ("booking_decision", "decision_maker_user_id", "app_user", "user_id"),
    ("usage_session", "booking_id", "booking", "booking_id"),
    ("usage_session", "check_in_by_user_id", "app_user", "user_id"),
    ("usage_session", "check_out_by_user_id", "app_user", "user_id"),
    ("maintenance", "space_id", "space", "space_id"),
    ("maintenance", "reporter_user_id", "app_user", "user_id"),
    ("maintenance", "assigned_staff_user_id", "app_user", "user_id"),
    ("advisory_ack", "booking_id", "booking", "booking_id"),
    ("advisory_ack", "maintenance_id", "maintenance", "maintenance_id"),
    ("impact_history", "maintenance_id", "maintenance", "maintenance_id"),
    ("impact_history", "changed_by_user_id", "app_user", "user_id"),
    ("booking_impact", "maintenance_id", "maintenance", "maintenance_id"),
    ("booking_impact", "booking_id", "booking", "booking_id"),
    ("booking_impact", "identified_by_user_id", "app_user", "user_id"),
    ("booking_impact", "resolved_by_user_id", "app_user", "user_id"),
]

# Accepted words.
ROLES = ("Student", "Lecturer", "TA", "FacilityStaff", "DeptAdmin", "FacilityManager")
PURPOSES = ("Lecture", "Examination", "Seminar", "Workshop", "Meeting", "StudentActivity", "AdministrativeEvent")
WORDS = {
    "role": ROLES,
    "account_status": ("Active", "Inactive", "Suspended"),
    "space_type": ("Auditorium", "Classroom", "ComputerLaboratory", "ProjectLaboratory", "MeetingRoom", "StudentWorkspace"),
    "space_status": ("Available", "InUse", "UnderMaintenance", "TemporarilyClosed", "Retired"),
    "purpose": PURPOSES,
    "booking_status": ("Pending", "Approved", "Rejected", "Cancelled", "CheckedIn", "Completed", "NoShow"),
    "decision": ("Approved", "Rejected", "AutoApproved"),
    "maintenance_status": ("Reported", "Assigned", "InProgress", "Completed", "Cancelled"),
    "impact_level": IMPACT_LEVELS,
    "contact_status": ("PendingContact", "Contacted", "Resolved"),
    "resolution": ("Rescheduled", "Relocated", "Cancelled", "AcceptedRisk"),
}


def _among(column: str, words: str) -> str:
    return f"{column} in ({', '.join(repr(w) for w in WORDS[words])})"


def _set_together(*columns: str) -> str:
    """All the columns are filled, or none is."""
    filled = " and ".join(f"{c} is not null" for c in columns)
    empty = " and ".join(f"{c} is null" for c in columns)
    return f"(({filled}) or ({empty}))"


# Conditions a row must not break; a NULL result passes. Written as SQL text that Spark
# parses into one column each.
DOMAIN_RULES: dict[str, dict[str, str]] = {
    "app_user": {
        "user_role": _among("role", "role"),
        "user_account_status": _among("account_status", "account_status"),
    },
    "space": {
        "space_type": _among("space_type", "space_type"),
        "space_capacity_positive": "capacity > 0",
        "space_status": _among("current_status", "space_status"),
    },
    "space_facility": {"space_facility_quantity_positive": "quantity > 0"},
    "booking_policy": {
        "policy_role": _among("applicable_role", "role"),
        "policy_purpose": _among("applicable_purpose", "purpose"),
        "policy_minutes_nonnegative": "least(minimum_lead_minutes, cancellation_lead_minutes, pre_buffer_minutes, "
        "post_buffer_minutes) >= 0",
    },
    "booking": {
        "booking_time_order": "requested_end_time > requested_start_time",
        "booking_participants_positive": "expected_participants > 0",
        "booking_purpose": _among("purpose", "purpose"),
        "booking_status": _among("booking_status", "booking_status"),
        "booking_cancellation_audit": f"{_set_together('cancelled_at', 'cancelled_by_user_id')} "
        "and (booking_status = 'Cancelled') = (cancelled_at is not null)",
        "booking_ack_time": "advisory_acknowledged_at is null or (advisories_presented_at is not null "
        "and advisory_acknowledged_at >= advisories_presented_at)",
    },
    "booking_decision": {
        "decision_value": _among("decision", "decision"),
        "decision_rejection_reason": "(decision = 'Rejected') = (rejection_reason is not null)",
    },
    "usage_session": {
        "session_time_order": "actual_end_time > actual_start_time",
        "session_checkout_audit": _set_together("actual_end_time", "check_out_by_user_id", "final_condition"),
    },
    "maintenance": {
        "maintenance_status": _among("maintenance_status", "maintenance_status"),
        "maintenance_time_order": "completion_time >= start_time",
        "maintenance_completion_audit": "(maintenance_status = 'Completed') = (completion_time is not null) "
        "and (maintenance_status <> 'Completed' or result_note is not null)",
        "maintenance_impact_level": _among("impact_level", "impact_level"),
    },
    "impact_history": {
        "history_prior_level": _among("prior_impact_level", "impact_level"),
        "history_new_level": _among("new_impact_level", "impact_level"),
    },
    "booking_impact": {
        "impact_contact_status": _among("contact_status", "contact_status"),
        "impact_resolution": _among("resolution", "resolution"),
        "impact_resolution_audit": _set_together("resolution", "resolved_at", "resolved_by_user_id"),
    },
}
