"""Mixing: shares of the mixture, the distribution of repeats, and edge cases."""

from __future__ import annotations

import math

import pytest

from roomgrid.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, id string, row string, copy long, count long"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA)


def test_steps_are_the_distribution():
    for rate in (0.01, 1.0, 7.5, 64.0):
        steps = M.poisson_steps(rate)
        want = 0.0
        for k, step in enumerate(steps):
            want += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
            assert step == pytest.approx(min(want, 1.0), rel=1e-9, abs=1e-12)
        assert steps[-1] > 1 - 1e-12


def test_shares_and_repeats(spark):
    rows = [(i, "t" * 100, "hot" if i % 3 else f"s{i % 4}") for i in range(9000)] + [(9001 + i, "t" * 100, None) for i in range(1000)]
    got = M.mix(_frame(spark, rows), {"hot": 0.2, "s1": 0.5, "gone": 3.0}, other=0.3)
    assert got.columns == ["doc_id", "text", "source", "id", "row", "copy", "count", "_copy", "_order"]
    out = got.collect()
    n = len(out)
    assert n == pytest.approx(10_000, rel=0.05)
    share = lambda s: sum(r["source"] == s for r in out) / n
    assert share("hot") == pytest.approx(0.2, rel=0.1) and share("s1") == pytest.approx(0.5, rel=0.1)
    rate = 0.5 * 10_000 / sum(r[2] == "s1" for r in rows)
    times = {}
    for r in out:
        if r["source"] == "s1":
            times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
            assert r["_copy"] >= 1
    none = sum(r[2] == "s1" and r[0] not in times for r in rows) / sum(r[2] == "s1" for r in rows)
    assert none == pytest.approx(math.exp(-rate), abs=0.03)
    variance = sum((times.get(r[0], 0) - rate) ** 2 for r in rows if r[2] == "s1") / sum(r[2] == "s1" for r in rows)
    assert variance == pytest.approx(rate, rel=0.2)
    # a global shuffle: order of the keys is unrelated to the ids
    ids = [r["doc_id"] for r in sorted(out, key=lambda r: r["_order"])]
    ups = sum(a < b for a, b in zip(ids, ids[1:])) / len(ids)
    assert ups == pytest.approx(0.5, abs=0.03)
    assert sorted(map(str, out)) == sorted(map(str, M.mix(_frame(spark, rows).repartition(7), {"hot": 0.2, "s1": 0.5, "gone": 3.0}, other=0.3).collect()))


def test_large_rates(spark):
    rows = [(i, "t", "rare") for i in range(40)] + [(100 + i, "t" * 1000, "big") for i in range(20)]
    out = M.mix(_frame(spark, rows), {"rare": 0.5}, other=0.5).where("source = 'rare'").count()
    assert out == pytest.approx(10_020, rel=0.05)


def test_edges(spark):
    assert M.mix(_frame(spark, [])).count() == 0
    assert M.mix(_frame(spark, [(1, None, "a"), (2, "", "b"), (None, None, None)])).count() == 3
    twice = M.mix(_frame(spark, [(5, "abc", "a"), (5, "abc", "a"), (None, "x", "a"), (None, "y" * 100_000, None)]), epochs=3.0).collect()
    assert sum(r["doc_id"] == 5 for r in twice) % 2 == 0
    with pytest.raises(ValueError, match="weight"):
        M.mix(_frame(spark, [(1, "a", "a")]), {"a": 0.0}, other=0.0)
