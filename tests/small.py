"""Small hand-made tables."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema

from roomgrid.schema import SCHEMAS
from roomgrid.sources.tables import Tables, conform


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def frame(spark, table: str, rows: list[dict]):
    schema = SCHEMAS[table]
    full = [{f.name: row.get(f.name) for f in schema} for row in rows]
    arrow = pa.Table.from_pylist(full, schema=pa.schema([f.with_nullable(True) for f in to_arrow_schema(schema)]))
    return conform(spark.createDataFrame(arrow), table)


def tables(spark, **rows: list[dict]) -> Tables:
    return Tables({name: frame(spark, name, rows.get(name, [])) for name in SCHEMAS})


def person(user_id, role="Student", status="Active"):
    return dict(user_id=user_id, full_name=f"Person {user_id}", email=f"p{user_id}@example.org", role=role, department="Any", account_status=status)


def room(space_id, capacity=20, status="Available"):
    return dict(
        space_id=space_id, space_code=f"R{space_id}", space_name=f"Room {space_id}", space_type="MeetingRoom", building="A",
        floor="1", room_number=str(space_id), capacity=capacity, current_status=status,
    )


def booking(booking_id, start, end, status="Approved", space=1, who=1, people=10, purpose="Meeting", submitted="2029-12-01 08:00:00", **more):
    return dict(
        booking_id=booking_id, requester_user_id=who, space_id=space, requested_start_time=at(start), requested_end_time=at(end),
        purpose=purpose, expected_participants=people, booking_status=status, submitted_at=at(submitted), **more,
    )


def repair(maintenance_id, start, end=None, status="InProgress", level="advisory", space=1, text="lamp is weak"):
    return dict(
        maintenance_id=maintenance_id, space_id=space, reporter_user_id=2, problem_description=text, start_time=at(start),
        completion_time=at(end) if end else None, maintenance_status=status, impact_level=level,
        result_note="done" if status == "Completed" else None,
    )


def policy(policy_id, space=None, role=None, purpose=None, pre=0, post=0, auto=False):
    return dict(
        policy_id=policy_id, space_id=space, applicable_role=role, applicable_purpose=purpose, minimum_lead_minutes=60,
        cancellation_lead_minutes=120, pre_buffer_minutes=pre, post_buffer_minutes=post, auto_approval_enabled=auto,
    )


def approvals(spark, *rows):
    """(booking_id, maker, is_auto, acknowledge)"""
    return spark.createDataFrame(list(rows), "booking_id bigint, decision_maker_user_id bigint, is_auto boolean, acknowledge boolean")


def got(df):
    return sorted(tuple(r) for r in df.collect())
