"""Conversation repair: the cheapest edits that give a legal order of roles.

The roles' initials of a repaired conversation match ``(s?(ua)+)?``. The repair grammar is in
Chomsky normal form. Its nonterminals are pairs of places in that pattern: ``X[p,q]`` derives
the spans of turns whose repair leads from place p to place q. Its rules are

* ``X[p,q] -> X[p,r] X[r,q]``,
* ``X[p,q] -> turn``: keep or rerole a turn that leads from p to q, or delete it (p = q),
* ``X[p,q] -> nothing``: insertions alone that lead from p to q. Their closure is put
  around every turn, so no rule is needed for them afterwards.

A span's *cell* holds the least (cost, audit) of each nonterminal. Cells are combined bottom-up
by span length. In general a span has to try all its splits; here p and q say all that the
outside knows of a span, so any split gives the same least cost, and any gives the same
least audit: audits of one span with one cost are never the beginning of one another (the
longer one would have more insertions), so the lesser stays the lesser whatever follows. One
split in the middle is enough, and a conversation of n turns takes n - 1 combinations.

Spark puts all turns in order and into ranges of that order. A conversation inside a range is
repaired in its task. One that goes over several ranges, however long, has a cell for each
range; the cells are combined, and the audit goes back to the ranges, which edit their turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import stored, table

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_SPACES = " \t\n\x0b\x0c\r"
_START, _SYSTEM, _USER, _ASSISTANT = range(4)  # places: nothing yet, after s, after u, after ua
_NEXT = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_ENDS = (_START, _ASSISTANT)
_PAIRS = [(p, q) for p in range(4) for q in range(4) if p == q or (q > _START and (q != _SYSTEM or p == _START))]
_AT = {pair: k for k, pair in enumerate(_PAIRS)}
_RULES = [(_AT[p, q], _AT[p, r], _AT[r, q]) for p, r in _PAIRS for r2, q in _PAIRS if r == r2]
_LEGAL = {"su", "ua", "au"}

_Entry = tuple[int, str]
_Cell = list[_Entry | None]


def combine(left: _Cell, right: _Cell) -> _Cell:
    """The cell of two adjoining spans."""
    out: _Cell = [None] * len(_PAIRS)
    for to, a, b in _RULES:
        x, y = left[a], right[b]
        if x is None or y is None:
            continue
        cost, old = x[0] + y[0], out[to]
        if old is None or cost < old[0]:
            out[to] = (cost, x[1] + y[1])
        elif cost == old[0]:
            audit = x[1] + y[1]
            if audit < old[1]:
                out[to] = (cost, audit)
    return out


def _closure() -> _Cell:
    out: _Cell = [None] * len(_PAIRS)
    for p in range(4):
        out[_AT[p, p]] = (0, "")
    step = list(out)
    for (p, c), q in _NEXT.items():
        if c != "s":
            step[_AT[p, q]] = (INSERT, "I")
    for _ in range(3):
        out = combine(out, step)
    return out


_NOTHING = _closure()


def _turn(initial: str, truncated: bool, gone: bool) -> _Cell:
    out: _Cell = [None] * len(_PAIRS)
    for p in range(4):
        out[_AT[p, p]] = (DELETE, "D")
    if not gone:
        extra = TRUNCATED if truncated else 0
        for (p, c), q in _NEXT.items():
            options = ([(REROLE + extra, "R")] if c != "s" else []) + ([(extra, "K")] if c == initial else [])
            out[_AT[p, q]] = min(options, default=None)
    return combine(combine(_NOTHING, out), _NOTHING)


_TURNS = {(c, t, g): _turn(c, t, g) for c in ("s", "u", "a", "") for t in (False, True) for g in (False, True)}


def span(cells: list[_Cell]) -> _Cell:
    """The cell of a whole span from those of its turns, by spans of length 1, 2, 4, ..."""
    if not cells:
        return _NOTHING
    while len(cells) > 1:
        joined = [combine(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = joined + cells[len(joined) * 2 :]
    return cells[0]


def edited(turns: list[tuple[str, str]], place: int, audit: str) -> Iterator[tuple[str, str]]:
    """The repaired turns of a span that starts at ``place``."""
    at = 0
    for edit in audit:
        role, text = ("assistant" if place == _USER else "user"), ""
        if edit != "I":
            own, at = turns[at], at + 1
            if edit == "D":
                continue
            role, text = (own[0] if edit == "K" else role), own[1]
        place = _NEXT[place, role[0]]
        yield role, text


class _Segment:
    """The turns of one conversation in one range: facts and cell."""

    def __init__(self, turns: list[tuple]) -> None:
        """``turns``: (turn, role, text, later), later: whether role and text stood at an earlier turn."""
        self.turns = [(role, text) for _, role, text, _ in turns]
        numbers = [t[0] for t in turns if t[0] is not None]
        self.first, self.last = (numbers[0], numbers[-1]) if numbers else (None, None)
        self.distinct = sum(a != b for a, b in zip(numbers, [None, *numbers]))
        self.blank = self.duplicate = self.truncated = 0
        cells, before = [], None
        for turn in turns:
            _, role, text, later = turn
            core = text.rstrip(_SPACES)
            blank, duplicate, truncated = not core, later or turn[:3] == before, core[-1:] not in ".!?"
            before = turn[:3]
            self.blank += blank
            self.duplicate += duplicate and not blank
            cut = truncated and not blank and not duplicate
            self.truncated += cut
            cells.append(_TURNS[role[:1] if role[:1] in ("s", "u", "a") else "", cut, bool(blank or duplicate)])
        initials = [role[:1] for role, _ in self.turns]
        self.illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
        self.initials = [initials[0], initials[-1]]
        self.cell = span(cells)

    def facts(self) -> list[int | None]:
        return [self.first, self.last, self.distinct, self.blank, self.duplicate, self.truncated, self.illegal]


def _answer(cell: _Cell) -> _Entry:
    return min(cell[_AT[_START, q]] for q in _ENDS if cell[_AT[_START, q]] is not None)


def _gaps(first: int | None, last: int | None, distinct: int) -> int:
    return 0 if first is None else last - first + 1 - distinct


_SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_OUT = "kind string, conv long, part int, at long, role string, text string, numbers array<long>, audit string, initials array<string>, costs array<long>, audits array<string>"
_OUT_TYPES = [
    ("kind", pa.string()), ("conv", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("role", pa.string()), ("text", pa.string()),
    ("numbers", pa.list_(pa.int64())), ("audit", pa.string()), ("initials", pa.list_(pa.string())), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())),
]


def _in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs what lies inside a range; of its first and last conversation the turns and the cell."""
    part = TaskContext.get().partitionId()
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [()] * len(_OUT_TYPES)
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _OUT_TYPES)], [n for n, _ in _OUT_TYPES])
        out.clear()
        return made

    def close(conv: int | None, turns: list[tuple], is_open: bool) -> None:
        own = _Segment(turns)
        if is_open:
            out.append(("segment", conv, part, None, None, None, own.facts(), None, own.initials, [c[0] if c else None for c in own.cell], [c[1] if c else None for c in own.cell]))
            out.extend(("row", conv, part, k, role, text, *[None] * 5) for k, (role, text) in enumerate(own.turns))
            return
        cost, audit = _answer(own.cell)
        out.append(("summary", conv, part, None, None, None, [_gaps(*own.facts()[:3]), *own.facts()[3:], cost], audit, None, None, None))
        out.extend(("turn", conv, part, k, role, text, *[None] * 5) for k, (role, text) in enumerate(edited(own.turns, _START, audit)))

    current, turns, number = None, [], 0
    for batch in batches:
        for conv, *turn in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "later"))):
            if turns and conv != current:
                close(current, turns, number == 0)
                number, turns = number + 1, []
                if len(out) > 2000:
                    yield flush()
            current = conv
            turns.append(tuple(turn))
    if turns:
        close(current, turns, True)
    yield flush()


def _across(segments: pa.Table) -> pa.Table:
    """One conversation over several ranges: its summary and the place and audit of each range."""
    rows = sorted(segments.to_pylist(), key=lambda r: r["part"])
    cells = [[None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"])] for r in rows]
    # forward: the least (cost, audits so far) at each place, with the places on the way
    best: dict[int, tuple[int, str, tuple]] = {_START: (0, "", ())}
    for k, cell in enumerate(cells):
        reached: dict[int, tuple[int, str, tuple]] = {}
        for p, (cost, audit, way) in best.items():
            for q in range(4):
                entry = cell[_AT[p, q]] if (p, q) in _AT else None
                if entry is None:
                    continue
                new = (cost + entry[0], audit + entry[1], (way, p, entry[1]))
                if q not in reached or new[:2] < reached[q][:2]:
                    reached[q] = new
        best = reached
    cost, audit, way = min((best[q] for q in _ENDS if q in best), key=lambda x: x[:2])
    steps = []
    while way:
        way, p, own = way
        steps.append((p, own))
    facts = [r["numbers"] for r in rows]
    distinct = sum(f[2] for f in facts)
    turned = [f for f in facts if f[0] is not None]
    distinct -= sum(a[1] == b[0] for a, b in zip(turned, turned[1:]))
    illegal = sum(f[6] for f in facts) + sum(a["initials"][1] + b["initials"][0] not in _LEGAL for a, b in zip(rows, rows[1:]))
    gaps = _gaps(turned[0][0] if turned else None, turned[-1][1] if turned else None, distinct)
    numbers = [gaps, *(sum(f[k] for f in facts) for k in (3, 4, 5)), illegal, cost]
    made = [("summary", rows[0]["conv"], None, None, numbers, audit)]
    made += [("slice", r["conv"], r["part"], p, None, own) for r, (p, own) in zip(rows, reversed(steps))]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.string()]
    names = ["kind", "conv", "part", "place", "numbers", "audit"]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)


def _edit_range(rows: pa.Table, slices: pa.Table) -> pa.Table:
    """The repaired turns of one conversation in one range."""
    rows = rows.sort_by("at")
    turns = list(zip(rows.column("role").to_pylist(), rows.column("text").to_pylist()))
    conv, part, place, audit = (slices.column(c)[0].as_py() for c in ("conv", "part", "place", "audit"))
    made = list(edited(turns, place, audit))
    columns = [[conv] * len(made), [part] * len(made), list(range(len(made))), [r for r, _ in made], [t for _, t in made]]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv", "part", "at", "role", "text"])


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: the repaired turns and a row per conversation.

    The turns: (conv_id, part, at, role, text), in order of part and at. The conversations:
    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit). A turn's first fault
    counts: blank (no character but white space), duplicate (role and text seen earlier),
    truncated (the last such character is none of ``.!?``). ``gaps`` are numbers missing
    between the first and the last turn. ``audit`` has a letter for every edit in order: Keep,
    Rerole, Delete, Insert.

    A null role or text is read as one blank, a role of no letters fits nowhere. Turns
    without a number come first and are left out of ``gaps``; turns with one number go by
    role, then by text. Repeated rows are duplicates. Rows without a conversation are a
    conversation of their own. Conversations without rows are not there, and other columns
    are ignored. A task holds the turns of one conversation in one range of the order.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text")
    )
    rows = rows.withColumn("h1", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64("text", "role", F.lit(1)))
    number = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    again = rows.groupBy(F.col("conv").alias("c"), F.col("h1").alias("k1"), F.col("h2").alias("k2")).agg(F.count("*").alias("n"), F.min(number).alias("first")).where("n > 1")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    marked = rows.join(again, same, "left").withColumn("later", F.coalesce(F.col("first") != number, F.lit(False)))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = marked.select("conv", "turn", "role", "text", "later").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    made = stored(ranged.mapInArrow(_in_ranges, _OUT), "ranges", 4096)

    split = made.where("kind = 'segment'").select("conv", "part", "numbers", "initials", "costs", "audits")
    joined = stored(split.groupBy("conv").applyInArrow(_across, "kind string, conv long, part int, place int, numbers array<long>, audit string"), "across")
    slices = joined.where("kind = 'slice'").select("conv", "part", "place", "audit")
    loose = made.where("kind = 'row'").select("conv", "part", "at", "role", "text")
    later = loose.groupBy("conv", "part").cogroup(slices.groupBy("conv", "part")).applyInArrow(_edit_range, "conv long, part int, at long, role string, text string")
    turns = made.where("kind = 'turn'").select("conv", "part", "at", "role", "text").union(later)
    summary = made.where("kind = 'summary'").select("conv", "numbers", "audit").union(joined.where("kind = 'summary'").select("conv", "numbers", "audit"))
    return (
        turns.withColumnRenamed("conv", conv),
        summary.select(F.col("conv").alias(conv), *(F.col("numbers")[k].alias(name) for k, name in enumerate(_SUMMARY)), "audit"),
    )


def damaged(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of conversations with faults, by a checksum of conversation and turn."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    rows = df.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), what.alias("what")).where("what <> 0")
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("what") == 4, "user").otherwise(F.col("role"))
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("what") == 3, 2).otherwise(1))).alias("copy")
    ).drop("copy")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest per conversation of turns in order; a conversation's texts pass by and are not kept."""
    schema = pa.schema([("conv_id", pa.int64()), ("sha", pa.string())])
    current, digest = None, None
    for batch in batches:
        done = []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if digest is None or conv != current:
                if digest is not None:
                    done.append((current, digest.hexdigest()))
                current, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], schema.types[k]) for k in (0, 1)], schema=schema)
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([digest.hexdigest()])], schema=schema)


def digest_of(turns: DataFrame) -> DataFrame:
    """(conv_id, sha) of the repaired turns as ``role:text`` lines. A digest is made in order, so by one task."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = turns.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "at").select("conv_id", "role", "text")
    return ordered.mapInArrow(_digests, "conv_id long, sha string")


def _of(column: str, empty: Column) -> Column:
    return F.coalesce(F.col(column), empty).alias(column)


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    source = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    turns, summary = repair(damaged(source))
    digests = digest_of(turns).select(F.col("conv_id").alias("d"), "sha")
    everyone = source.select("conv_id").distinct()
    found = everyone.join(summary.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("d")), "left")
    return found.select(
        "conv_id", *(_of(c, F.lit(0).cast("long")) for c in _SUMMARY), _of("audit", F.lit("")), F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    )
