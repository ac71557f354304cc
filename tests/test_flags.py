"""Flags on pending bookings: what meets, and that splitting the arrivals does not matter."""

from __future__ import annotations

import datetime as dt
import random

from roomgrid.session import shared_dir
from roomgrid.streaming import flags

T0 = dt.datetime(2030, 1, 1)
HOUR = dt.timedelta(hours=1)


def arrivals(n=120):
    """A third in one room; ends may be missing, touch or be far away."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        kind = "maintenance" if i % 3 == 0 else "booking"
        start = T0 + HOUR * rng.randrange(300)
        end = None if kind == "maintenance" and i % 12 == 0 else start + HOUR * rng.randrange(1, 40)
        rows.append((T0 + dt.timedelta(minutes=rng.randrange(n)), kind, i, rng.choice([1, 1, 2, 3, 4]), start, end))
    return rows


def wanted(rows):
    far = dt.datetime.max
    return sorted(
        (b[2], m[2], max(b[0], m[0]))
        for b in rows
        for m in rows
        if b[1] == "booking" and m[1] == "maintenance" and b[3] == m[3] and b[4] < (m[5] or far) and m[4] < b[5]
    )


def test_any_split_and_a_retried_batch_give_the_same_flags(spark):
    rows = arrivals()
    assert wanted(rows)
    folder = shared_dir(spark, "flags")
    for kind in ("booking", "maintenance"):
        spark.createDataFrame([], flags.ARRIVALS).write.parquet(f"{folder}/{kind}/batch=-1")
    cuts = [0, 50, 51, 120]
    for batch, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for _ in range(2 if batch == 2 else 1):
            flags.flag_batch(spark.createDataFrame(rows[a:b], flags.ARRIVALS), batch, folder)
    flags.flag_batch(spark.createDataFrame([], flags.ARRIVALS), len(cuts), folder)
    got = spark.read.schema(flags.FLAGS).parquet(f"{folder}/flags").collect()
    assert sorted(tuple(r)[:3] for r in got) == wanted(rows)
