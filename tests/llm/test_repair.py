"""Conversation repair against a cheapest-path search over (turn, place)."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from roomgrid.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string, conv int, part string, later int, h1 long, numbers string"
SPACES = " \t\n\x0b\x0c\r"


def _prefix(roles):
    """Whether a string of initials can become a legal one."""
    return any(re.fullmatch(r"(s?(ua)+)?", roles + more) for more in ("", "u", "ua", "a"))


def _cheapest(turns):
    """(cost, audit) by Dijkstra; turns: (initial, truncated, must go)."""
    seen, heap = set(), [(0, "", 0, "")]
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        key = (at, roles[-2:], len(roles) > 0)
        if (at, roles[-2:], bool(roles)) in seen:
            continue
        seen.add(key)
        if at == len(turns) and re.fullmatch(r"(s?(ua)+)?", roles):
            return cost, audit
        steps = [(3, "I", at, c) for c in "ua"]
        if at < len(turns):
            initial, truncated, gone = turns[at]
            steps.append((4, "D", at + 1, ""))
            if not gone:
                steps += [(3 * truncated, "K", at + 1, initial if len(initial) == 1 else "?")]
                steps += [(3 + 3 * truncated, "R", at + 1, c) for c in "ua"]
        for more, edit, to, c in steps:
            if _prefix((roles + c)[-40:] if len(roles) < 38 else "ua" + (roles + c)[-2:].replace("uu", "xx")):
                heapq.heappush(heap, (cost + more, audit + edit, to, (roles + c)[-6:] if len(roles) > 12 and (roles + c)[-6:][0] == "u" else roles + c))
    raise AssertionError


def _order(r):
    return (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())


def _expected(rows):
    """The contract's columns for the rows (turn, role, text) of one conversation."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=_order)
    faults, seen, turns = [], set(), []
    for t, r, x in rows:
        core = x.strip(SPACES)
        fault = "blank" if not core else "duplicate" if (r, x) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((r, x))
        faults.append(fault)
        turns.append((r[:1], fault == "truncated", fault in ("blank", "duplicate")))
    cost, audit = _cheapest(turns)
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    lines, at, place = [], 0, ""
    for edit in audit:
        target = "assistant" if place == "u" else "user"
        if edit == "I":
            lines.append((target, ""))
        else:
            _, r, x = rows[at]
            at += 1
            if edit == "D":
                continue
            lines.append((r if edit == "K" else target, x))
        place = lines[-1][0][:1]
    assert re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r, _ in lines))
    sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)


def _damaged(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        if k == 1:
            x = ""
        if k == 2:
            x = re.sub("[.!?]", "", x)
        if k == 4:
            r = "user"
        out += [(c, t, r, x)] * (2 if k == 3 else 1)
    return out


def _wanted(rows, ids):
    groups = {c: [] for c in ids}
    for c, t, r, x in rows:
        groups[c].append((t, r, x))
    return {c: _expected(g) for c, g in groups.items()}


def _got(turns, summary, digests):
    sha = {r["conv_id"]: r["sha"] for r in digests.collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], sha.get(r["conv_id"], empty)) for r in summary.collect()}


def _random_rows(rng, conv, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u", "agent"]
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", "Yes. \n", None, "a b", "…"]
    return [(conv, rng.choice([None, 0, 1, 2, 5, 9, -3]) if rng.random() < 0.3 else k, rng.choice(roles[: rng.choice([2, 3, 10])]), rng.choice(texts) if rng.random() < 0.4 else f"t{rng.random()}.") for k in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_spans_against_a_search(seed):
    rng = random.Random(seed)
    for _ in range(150):
        turns = [(rng.choice(["s", "u", "a", "u", "a", "x", ""]), rng.random() < 0.3, rng.random() < 0.2) for _ in range(rng.randrange(12))]
        cells = [R._TURNS[c if c in ("s", "u", "a") else "", t and not g, g] for c, t, g in turns]
        want = _cheapest([(c, t and not g, g) for c, t, g in turns])
        assert R._answer(R.span(cells)) == want
        # every split gives the same cell
        for k in range(len(cells) + 1):
            assert R.combine(R.span(cells[:k]), R.span(cells[k:])) == R.combine(R.combine(R._NOTHING, R.span(cells)), R._NOTHING) or not cells


def test_repair_inside_and_across_ranges(spark):
    rng = random.Random(11)
    rows = [r for c in [None, *range(40)] for r in _random_rows(rng, c, rng.randrange(1, 9))]
    rows += _random_rows(rng, 500, 90)  # goes over ranges
    rows += [(501, 3, "user", "Same.")] * 30
    df = spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            turns, summary = R.repair(df)
            assert _got(turns, summary, R.digest_of(turns)) == _wanted(rows, {r[0] for r in rows})
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)


def test_edges(spark):
    long_text = "wort " * 200_000 + "ende."
    rows = [(1, None, None, None), (2, 1, "user", long_text), (2, 2, "assistant", long_text), (3, 1, "system", "Alone."), (4, 5, "assistant", "Hi."), (4, 5, "user", "Hi."), (None, 1, "", ".")]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], SCHEMA)
    turns, summary = R.repair(df)
    assert _got(turns, summary, R.digest_of(turns)) == _wanted(rows, {r[0] for r in rows})
    turns, summary = R.repair(df.limit(0))
    assert turns.collect() == [] and summary.collect() == []


def test_query_against_a_search(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    odd = [(None, None, None, None), (None, 2, "user", "A."), (10**6, 0, None, "x"), *((c, 1, "user", "Only.") for c in range(2_000_000, 2_000_060))]
    rows = [tuple(r) for r in source.select("conv_id", "turn", "role", "text").collect()] + odd
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    df = R.op12_conversation_repair(spark, str(tmp_path))
    assert [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"] * 2
    got = {r["conv_id"]: tuple(r)[1:] for r in df.collect()}
    want = _wanted(_damaged(rows), {r[0] for r in rows})
    assert got == want and any(w[6] == "" for w in want.values())
