"""Operators against brute force. One group holds half of the rows, and slices are tiny."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roomgrid.functions.exprs import as_decimal, hour_diff, hundredths, minute_diff, ntz, open_end, overlaps, percent
from roomgrid.operators import first_come as first_come_module
from roomgrid.operators.first_come import first_come
from roomgrid.operators.overlap import (
    at_least_pairs,
    overlap_count,
    overlap_flags,
    overlap_pairs,
    self_overlap_flag,
    self_overlap_pairs,
)
from roomgrid.operators.policy import with_policy
from roomgrid.operators.ranking import ranked
from roomgrid.operators.slices import neighbour, numbered, running, with_slices
from roomgrid.operators.upsert import insert_if_absent
from small import frame, got, policy

T0 = dt.datetime(1998, 1, 1)


def spans(n, seed, open_share=0.0, longest_hours=40):
    """(id, room, start, end); room 0 holds half of the rows; some ends lie far away."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = T0 + dt.timedelta(minutes=30 * rng.randrange(0, 48 * 60))
        long = dt.timedelta(minutes=30 * rng.randrange(1, 2 * longest_hours))
        if rng.random() < 0.05:
            long *= 50
        end = dt.datetime(9999, 12, 31, 23, 59, 59) if rng.random() < open_share else start + long
        rows.append((i, rng.choice([0, 0, 0, 1, 2, 3]), start, end))
    return rows


def frame_of(spark, rows, prefix=""):
    return spark.createDataFrame(
        rows, f"{prefix}id bigint, room bigint, {prefix}s timestamp_ntz, {prefix}e timestamp_ntz"
    )


def meets(a, b):
    return a[1] == b[1] and a[2] < b[3] and a[3] > b[2]


def test_minutes_and_hours_count_boundaries(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 09:00:59' a, timestamp_ntz'2024-01-01 09:01:00' b, timestamp_ntz'2024-01-02 00:00:00' c")
    row = df.select(
        minute_diff("a", "b"), hour_diff("a", "b"), hour_diff("b", "c"), minute_diff("c", "b"), minute_diff("a", ntz("2024-01-01 10:00:00"))
    ).first()
    assert tuple(row) == (1, 0, 15, -899, 60)


def test_rounding_is_half_up_and_exact(spark):
    row = spark.range(1).select(
        hundredths(F.lit(29), F.lit(200)), percent(F.lit(1), F.lit(8)), percent(F.lit(1), F.lit(0)), as_decimal(F.lit(5), 10)
    ).first()
    assert [str(v) for v in row] == ["15", "12.50", "None", "0.05"]


def test_touching_intervals_do_not_overlap(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 09:00:00' a, timestamp_ntz'2024-01-01 10:00:00' b, cast(null as timestamp_ntz) n")
    row = df.select(overlaps("a", "b", F.col("b"), open_end("n")), overlaps("a", "b", F.col("a"), open_end("n"))).first()
    assert tuple(row) == (False, True)


@pytest.mark.parametrize("slice_rows", [3, 40, 1 << 20])
def test_neighbours_and_running_values(spark, slice_rows):
    rows = spans(400, 1)
    df = frame_of(spark, rows)
    order = ["s", "id"]
    before, after, top, count = {}, {}, {}, {}
    for room in range(4):
        line = sorted((r for r in rows if r[1] == room), key=lambda r: (r[2], r[0]))
        for i, r in enumerate(line):
            before[r[0]] = line[i - 1][3] if i else None
            after[r[0]] = line[i + 1][2] if i + 1 < len(line) else None
            top[r[0]] = max((x[3] for x in line[:i]), default=None)
            count[r[0]] = i + 1
    out = neighbour(df, ["room"], order, "e", "p", rows_per_slice=slice_rows)
    assert {r.id: r.p for r in out.collect()} == before
    out = neighbour(df, ["room"], order, "s", "n", following=True, rows_per_slice=slice_rows)
    assert {r.id: r.n for r in out.collect()} == after
    out = running(df, ["room"], order, {"m": ("max", F.col("e"))}, rows_per_slice=slice_rows)
    assert {r.id: r.m for r in out.collect()} == top
    out = running(df, ["room"], order, {"c": ("sum", F.lit(1))}, inclusive=True, rows_per_slice=slice_rows)
    assert {r.id: r.c for r in out.collect()} == count
    assert [r.k for r in numbered(df, order, "k", start=7, slices=400 // slice_rows + 1).orderBy(*order).collect()] == list(range(8, 408))


def test_slices_split_a_hot_group_and_follow_its_order(spark):
    df = spark.range(20000).select(F.lit(1).alias("g"), "id")
    sizes = with_slices(df, ["g"], ["id"], 50).groupBy("_slice").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    rows = sizes.orderBy("_slice").collect()
    assert len(rows) > 250 and max(r.n for r in rows) < 1000
    assert all(x.b < y.a for x, y in zip(rows, rows[1:]))


@pytest.mark.parametrize("slice_rows", [2, 1 << 20])
def test_rank_with_ties_and_nulls(spark, slice_rows):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 0, 1]), rng.choice([None, 1, 2, 2, 3, 9])) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, g int, v int")
    whole = {r.id: r.k for r in ranked(df, ["v"], "k", slices=3 if slice_rows == 2 else None).collect()}
    within = {r.id: r.k for r in ranked(df, ["v"], "k", within=["g"], rows_per_slice=slice_rows).collect()}
    low = lambda v: -1 if v is None else v
    assert whole == {i: 1 + sum(low(w) < low(v) for _, _, w in rows) for i, _, v in rows}
    assert within == {i: 1 + sum(h == g and low(w) < low(v) for _, h, w in rows) for i, g, v in rows}


def test_overlap_pairs_find_each_pair_once(spark):
    left, right = spans(250, 3), spans(120, 4, open_share=0.2)
    out = overlap_pairs(frame_of(spark, left), frame_of(spark, right, "r"), ["room"], ("s", "e"), ("rs", "re"))
    assert got(out.select("id", "rid")) == sorted((a[0], b[0]) for a in left for b in right if meets(a, b))


def test_self_overlap_pairs_and_flag(spark):
    rows = spans(250, 5, longest_hours=3)
    df = frame_of(spark, rows)
    pairs = {(min(a[0], b[0]), max(a[0], b[0])) for a in rows for b in rows if a[0] != b[0] and meets(a, b)}
    out = self_overlap_pairs(df, ["room"], ("s", "e"), "id").select(F.least("id", "id_2"), F.greatest("id", "id_2"))
    assert got(out) == sorted(pairs)
    for slice_rows in (4, 1 << 20):
        flagged = self_overlap_flag(df, ["room"], ("s", "e"), "id", "hit", rows_per_slice=slice_rows).where("hit")
        assert {r.id for r in flagged.collect()} == {i for p in pairs for i in p}


@pytest.mark.parametrize("slice_rows", [4, 1 << 20])
def test_overlap_flags_and_counts(spark, slice_rows):
    probes, blocks, others = spans(200, 6, longest_hours=4), spans(40, 7, longest_hours=4), spans(10, 8, open_share=0.5)
    p, b, o = frame_of(spark, probes), frame_of(spark, blocks, "b"), frame_of(spark, others, "b")
    out = overlap_flags(p, {"x": b, "y": o}, ["room"], ("s", "e"), ("bs", "be"), "id", rows_per_slice=slice_rows)
    assert {r.id: (r.x, r.y) for r in out.collect()} == {
        a[0]: (any(meets(a, c) for c in blocks), any(meets(a, c) for c in others)) for a in probes
    }
    counted = overlap_count(p, b, ["room"], ("s", "e"), ("bs", "be"), "id", "n", rows_per_slice=slice_rows)
    expected = {a[0]: sum(meets(a, c) for c in blocks) for a in probes}
    assert {r.id: r.n for r in counted.collect()} == {i: n for i, n in expected.items() if n}


def test_at_least_pairs(spark):
    values, floors = [0, 1, 2, 7, 8, 30, 31, 500], [-3, 0, 1, 2, 8, 30, 501]
    v = spark.createDataFrame([(x,) for x in values], "v int")
    f = spark.createDataFrame([(x,) for x in floors], "f int")
    assert got(at_least_pairs(v, f, "v", "f")) == sorted((x, y) for x in values for y in floors if x >= y)


def served(rows):
    """One after the other, in plain Python. rows: (id, room, narrow start, narrow end, wide start, wide end, time)"""
    held, out = {}, {}
    for r in sorted(rows, key=lambda r: (r[6], r[0])):
        taken = held.setdefault(r[1], [])
        out[r[0]] = not any(r[4] < b and r[5] > a for a, b in taken)
        if out[r[0]]:
            taken.append((r[2], r[3]))
    return out


@pytest.mark.parametrize("max_island, chain", [(1 << 20, False), (60, False), (60, True)])
def test_first_come(spark, max_island, chain):
    rng = random.Random(9)
    hour = dt.timedelta(hours=1)
    rows = []
    for i in range(160):
        start = T0 + hour * (i if chain else rng.randrange(0, 90))
        end = start + hour * 1.5 if chain else start + hour * rng.randrange(1, 4)
        pre, post = dt.timedelta(minutes=rng.choice([0, 15])), dt.timedelta(minutes=rng.choice([0, 30]))
        when = T0 + (dt.timedelta(minutes=i) if chain else dt.timedelta(minutes=rng.randrange(0, 50)))
        rows.append((i, 0 if chain else rng.choice([0, 0, 0, 1]), start, end, start - pre, end + post, when))
    df = spark.createDataFrame(
        rows, "id bigint, room bigint, s timestamp_ntz, e timestamp_ntz, ws timestamp_ntz, we timestamp_ntz, t timestamp_ntz"
    )
    out = first_come(df, ["room"], ["t", "id"], ("s", "e"), ("ws", "we"), "id", max_island=max_island, rows_per_slice=16)
    assert {r.id: r.accepted for r in out.collect()} == served(rows)


def line_of_requests(kind, n=150):
    """Long lines in which each waits for the one before, in one direction or two, and with rows in between."""
    rng = random.Random(n)
    quarter = dt.timedelta(minutes=15)
    rows = []
    for i in range(n):
        place = {"backwards": n - i, "in two": abs(2 * i - n), "crowded": i, "uneven": i}[kind]
        start = T0 + quarter * 4 * i
        end = start + quarter * (rng.randrange(3, 14) if kind in ("crowded", "uneven") else 6)
        pre, post = (quarter * rng.choice([0, 1, 8 if kind == "uneven" else 1]) for _ in range(2))
        late = kind == "crowded" and i % 3 == 1
        rows.append((i, 0, start, end, start - pre, end + post, T0 + dt.timedelta(minutes=place + (n if late else 0))))
    return rows


@pytest.mark.parametrize("kind", ["backwards", "in two", "crowded", "uneven"])
def test_first_come_follows_long_lines_in_few_rounds(spark, kind, monkeypatch):
    rounds, workers = [], []
    kept, worker = first_come_module._round, first_come_module._decide_islands
    monkeypatch.setattr(first_come_module, "_round", lambda *args: rounds.append(1) or kept(*args))
    monkeypatch.setattr(first_come_module, "_decide_islands", lambda *args: workers.append(1) or worker(*args))
    rows = line_of_requests(kind)
    df = spark.createDataFrame(
        rows, "id bigint, room bigint, s timestamp_ntz, e timestamp_ntz, ws timestamp_ntz, we timestamp_ntz, t timestamp_ntz"
    )
    out = first_come(df, ["room"], ["t", "id"], ("s", "e"), ("ws", "we"), "id", max_island=4, rows_per_slice=50)
    assert {r.id: r.accepted for r in out.collect()} == served(rows)
    assert len(rounds) <= 5 and len(workers) == 1  # the worker had the small islands alone


def test_policy_choice(spark):
    policies = frame(
        spark,
        "booking_policy",
        [
            policy(1),
            policy(2, role="Lecturer", auto=True),
            policy(3, purpose="Seminar"),
            policy(4, space=1, purpose="Seminar"),
            policy(5, space=1),
            policy(6, space=1),
        ],
    )
    asked = [(1, "Student", "Seminar"), (1, "Lecturer", "Meeting"), (2, "Lecturer", "Seminar"), (2, "Student", "Seminar"), (2, "TA", "Meeting")]
    df = spark.createDataFrame(asked, "space_id bigint, role string, purpose string")
    out = got(with_policy(df, policies).select("space_id", "role", "purpose", "policy_id", "auto_allowed"))
    assert out == sorted(
        [
            (1, "Student", "Seminar", 4, False),
            (1, "Lecturer", "Meeting", 6, True),
            (2, "Lecturer", "Seminar", 2, True),
            (2, "Student", "Seminar", 3, False),
            (2, "TA", "Meeting", 1, False),
        ]
    )
    assert with_policy(df, policies.where("policy_id = 4")).where("policy_id is null").count() == 4


def test_insert_if_absent_twice_adds_nothing(spark):
    keys = ["space_id", "applicable_role", "applicable_purpose"]
    target = frame(spark, "booking_policy", [policy(1)])
    source = frame(spark, "booking_policy", [policy(7), policy(8, space=1), policy(9, space=1), policy(10, space=2)])
    once = insert_if_absent(target, source, keys)
    assert sorted(r.policy_id for r in once.collect()) == [1, 8, 10]
    assert insert_if_absent(once, source, keys).count() == 3
