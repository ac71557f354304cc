"""Versions of the tables: replaced as a whole, repeated, cut off, and written by two at once."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from roomgrid.session import shared_dir
from roomgrid.sources import snapshots as S
from small import booking, frame, got, person, tables

HOUR = ("2030-01-07 08:00:00", "2030-01-07 09:00:00")


def first(spark):
    folder = shared_dir(spark, "versions")
    t = tables(spark, app_user=[person(1)], booking=[booking(1, *HOUR, status="Pending"), booking(2, *HOUR, status="Pending")])
    assert S.latest_version(spark, folder) == 0
    assert S.write_version(spark, folder, 0, "load", replaced=t) == 1
    return folder


def approved(t):
    return {"booking": t["booking"].withColumn("booking_status", F.lit("Approved"))}


def history(spark, *ids):
    rows = [dict(impact_history_id=k, maintenance_id=1, new_impact_level="advisory", changed_by_user_id=1, change_note="") for k in ids]
    return {"impact_history": frame(spark, "impact_history", [r | dict(changed_at=booking(1, *HOUR)["submitted_at"]) for r in rows])}


def statuses(t):
    return got(t["booking"].select("booking_id", "booking_status"))


def test_replaced_and_appended_as_one_step(spark):
    folder = first(spark)
    old = S.read_version(spark, folder)
    seen = old["booking"]
    assert S.write_version(spark, folder, 1, "approve", approved(old), history(spark, 1, 2)) == 2
    assert S.write_version(spark, folder, 2, "more", appended=history(spark, 3)) == 3
    new = S.read_version(spark, folder)
    assert statuses(new) == [(1, "Approved"), (2, "Approved")] and got(new["impact_history"].select("impact_history_id")) == [(1,), (2,), (3,)]
    # a reader that began earlier, and one that asks for an earlier version
    assert got(seen.select("booking_status").distinct()) == [("Pending",)]
    assert S.read_version(spark, folder, 1)["impact_history"].isEmpty()
    assert got(new["app_user"]) == got(old["app_user"]) and new["advisory_ack"].isEmpty()


def test_a_repeated_run_writes_once(spark):
    folder = first(spark)
    old = S.read_version(spark, folder)
    for _ in range(2):
        assert S.write_version(spark, folder, 1, "approve", approved(old), history(spark, 1)) == 2
    assert S.read_version(spark, folder)["impact_history"].count() == 1
    assert S.latest_version(spark, folder) == 2


def test_a_write_that_is_cut_off_shows_nothing(spark):
    folder = first(spark)
    old = S.read_version(spark, folder)
    broken = history(spark, 1)["impact_history"].withColumn("change_note", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        S.write_version(spark, folder, 1, "approve", approved(old), {"impact_history": broken})
    # the bookings were written, but no version names them
    assert len(os.listdir(f"{folder}/booking")) == 2 and S.latest_version(spark, folder) == 1
    assert statuses(S.read_version(spark, folder)) == [(1, "Pending"), (2, "Pending")]
    assert S.write_version(spark, folder, 1, "approve", approved(old), history(spark, 1)) == 2
    assert S.read_version(spark, folder)["impact_history"].count() == 1


def test_of_two_writers_one_wins(spark, monkeypatch):
    folder = first(spark)
    old = S.read_version(spark, folder)
    S.write_version(spark, folder, 1, "one", approved(old))
    with pytest.raises(S.VersionTaken):
        S.write_version(spark, folder, 1, "two", appended=history(spark, 1))
    # both have looked before either has written: the rename decides
    looks = iter([1])
    monkeypatch.setattr(S, "latest_version", lambda *_: next(looks))
    with pytest.raises(S.VersionTaken):
        S.write_version(spark, folder, 1, "two", appended=history(spark, 1))
    monkeypatch.undo()
    assert S.read_version(spark, folder)["impact_history"].isEmpty() and S.latest_version(spark, folder) == 2
    assert [n for n in os.listdir(f"{folder}/_versions") if not n.endswith((".json", ".crc"))] == []


def test_what_cannot_be_asked_for(spark):
    folder = first(spark)
    old = S.read_version(spark, folder)
    with pytest.raises(ValueError, match="no version 5"):
        S.write_version(spark, folder, 5, "late", approved(old))
    with pytest.raises(ValueError, match="at once: booking"):
        S.write_version(spark, folder, 1, "both", approved(old), approved(old))
