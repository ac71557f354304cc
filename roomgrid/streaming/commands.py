"""Approvals and level changes in one stream, with state by entry.

The commands, the facts joined to them and the outcomes are those of ``approvals``. A room's
state is not one row but entries of their own, in Spark's RocksDB state store:

* ``taken``: per room and span of ``DAYS`` days, the accepted intervals that touch it and their bookings.
  A request reads the spans it touches, so a command costs the same whatever the room has seen before.
* ``levels``: the records whose level was changed; ``reported``: the pairs of record and booking
  that were reported; both by room.
* ``last``: the last day in use, where a record without an end stops looking. It is there once anything is.

Rooms are dealt to ``BUCKETS`` keys, each worked on by one task at a time, room by room: what Spark does once
a key (calls, frames, Arrow batches) does not grow with the rooms. An entry is a call from the worker to
Spark. The commands of a room in a micro-batch share what they read, each entry once, and what they
changed is written at the end, each entry once. A bucket that is new has nothing to read. Nothing is dropped
for being late, so state is kept; ``approvals`` trims it by its lead rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.streaming.approvals import _NONE, OUTCOMES, _travelling, _without_null, prepare, run_available

DAY = 86_400
#: Days of an entry of ``taken``: fewer calls for many commands, against more intervals read for few.
DAYS = 128
#: Keys that rooms are dealt to. A checkpoint belongs to this number and to ``DAYS``.
BUCKETS = 1 << 16
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _processor(columns: list[str], none: int = _NONE, day: int = DAY, days_a_span: int = DAYS):
    """The processor for the workers; nested, so that it travels by value."""
    from pyspark.sql.streaming import StatefulProcessor

    given, outcomes = _travelling(columns, none)

    class Room(StatefulProcessor):
        def init(self, handle) -> None:
            self.taken = handle.getMapState("taken", "space bigint, place bigint, span bigint", "starts array<bigint>, ends array<bigint>, ids array<bigint>")
            self.levels = handle.getMapState("levels", "space bigint, place bigint, record bigint", "level string")
            self.reported = handle.getMapState("reported", "space bigint, place bigint, record bigint, booking bigint", "command bigint")
            self.last = handle.getValueState("last", "day bigint")

        def begin(self, room: tuple) -> None:
            """Forget what was read for another room."""
            self.room = room
            self.spans, self.days, self.known, self.pairs = {}, {}, {}, {}
            self.changed_spans, self.changed_levels, self.changed_pairs = set(), set(), set()

        def finish(self) -> None:
            for s in sorted(self.changed_spans):
                self.taken.updateValue((*self.room, s), self.spans[s])
            for record in sorted(self.changed_levels):
                self.levels.updateValue((*self.room, record), (self.known[record],))
            for pair in sorted(self.changed_pairs):
                self.reported.updateValue((*self.room, *pair), (self.pairs[pair],))
            self.changed |= bool(self.changed_spans or self.changed_levels)

        def touched(self, begin: int, end: int) -> range:
            return range(begin // day, max(begin, end - 1) // day + 1)

        def span(self, s: int) -> tuple:
            """Starts, ends and bookings of a span; nothing is stored after the last day in use."""
            if s not in self.spans:
                row = self.taken.getValue((*self.room, s)) if not self.new and s <= self.stored // days_a_span else None
                self.spans[s] = tuple(list(x) for x in row) if row else ([], [], [])
                for lo, hi, booking in zip(*self.spans[s]):
                    of_interval = self.touched(lo, hi)
                    for d in range(max(of_interval[0], s * days_a_span), min(of_interval[-1], (s + 1) * days_a_span - 1) + 1):
                        self.days.setdefault(d, []).append((lo, hi, booking))
            return self.spans[s]

        def held(self, d: int) -> list:
            """The accepted (start, end, booking) that touch a day."""
            self.span(d // days_a_span)
            return self.days.get(d, ())

        def level(self, record: int, given_level):
            if record not in self.known:
                row = None if self.new else self.levels.getValue((*self.room, record))
                self.known[record] = row[0] if row else None
            return given_level if self.known[record] is None else self.known[record]

        def told(self, pair: tuple) -> bool:
            if pair not in self.pairs:
                self.pairs[pair] = 0 if not self.new and self.reported.containsKey((*self.room, *pair)) else None
            return self.pairs[pair] is not None

        def between(self, begin: int, end: int, days: range):
            """Accepted (booking) that meet the time from ``begin`` to ``end``, each once, by start."""
            found = {}
            for d in days:
                for lo, hi, booking in self.held(d):
                    if lo < end and hi > begin:
                        found[booking] = lo
            return sorted(found, key=lambda b: (found[b], b))

        def accept(self, begin: int, end: int, booking: int) -> None:
            days = self.touched(begin, end)
            for s in range(days[0] // days_a_span, days[-1] // days_a_span + 1):
                for held, new in zip(self.span(s), (begin, end, booking)):
                    held.append(new)
                self.changed_spans.add(s)
            for d in days:
                self.days.setdefault(d, []).append((begin, end, booking))
            self.until = max(self.until, days[-1])

        def refusal(self, booking, acknowledge, raw_from, wide_from, wide_until, taken, met_records, met_levels) -> int:
            if any(b == booking for _, _, b in self.held(raw_from // day)):
                return 51036
            if taken or any(lo < wide_until and hi > wide_from for d in self.touched(wide_from, wide_until) for lo, hi, _ in self.held(d)):
                return 51041
            if met_records is None:
                return 0
            now = {self.level(int(record), level) for record, level in zip(met_records, met_levels)}
            if "out-of-service" in now:
                return 51042
            return 51043 if "advisory" in now and not acknowledge else 0

        def change(self, command: int, record: int, level: str, before: str, begin: int, end: int) -> Iterator[tuple]:
            if self.level(record, before) == level:
                yield "Unchanged", none
                return
            self.known[record] = level
            self.changed_levels.add(record)
            yield "Changed", none
            if level == "out-of-service" and self.until != none:
                for booking in self.between(begin, end, range(begin // day, min(max(begin, end - 1) // day, self.until) + 1)):
                    if not self.told((record, booking)):
                        self.pairs[record, booking] = command
                        self.changed_pairs.add((record, booking))
                        yield "Impact", booking

        def handleInputRows(self, key, rows, timerValues):
            columns, commands = given(key, rows)
            out, room = [], None
            if commands:
                row = self.last.get()
                self.new, self.changed = row is None, False
                self.until = self.stored = none if self.new else row[0]
            for (
                space, place, _, command, kind, booking, record, is_auto, acknowledge, new_level, record_level, record_from, record_until,
                raw_from, raw_until, wide_from, wide_until, taken, met_records, met_levels,
            ) in commands:
                if (space, place) != room:
                    if room:
                        self.finish()
                    room = (space, place)
                    self.begin(room)
                if kind == "level":
                    for result, hit in self.change(command, record, new_level, record_level, record_from, record_until):
                        out.append((space, command, kind, none, record, 0, result, hit))
                    continue
                code = self.refusal(booking, acknowledge, raw_from, wide_from, wide_until, taken, met_records, met_levels)
                if not code:
                    self.accept(raw_from, raw_until, booking)
                out.append((space, command, kind, booking, record, code, None if code else "AutoApproved" if is_auto else "Approved", none))
            if room:
                self.finish()
                if self.until != self.stored or self.new and self.changed:
                    self.last.update((self.until,))
            yield outcomes(columns, out)

        def close(self) -> None:
            pass

    return Room()


def s01_stream_commands(commands: DataFrame, t, standing: DataFrame) -> DataFrame:
    """A stream of commands to a stream of outcomes, as ``approvals.s01_stream_approvals`` without its lead rule.

    Start it through ``run_commands``, or with the RocksDB provider set.
    """
    names = [c.split()[0] for c in OUTCOMES.split(", ")]
    ready = _without_null(prepare(commands, t, standing).drop("at"))
    dealt = ready.withColumn("bucket", F.pmod(F.xxhash64("space_id", "place"), F.lit(BUCKETS)))
    return dealt.groupBy("bucket").transformWithStateInPandas(_processor(names), OUTCOMES, "append", "none")


@contextmanager
def _entries(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state by entry."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def run_commands(commands: DataFrame, t, standing: DataFrame, out: str, checkpoint: str) -> None:
    """Write the outcomes of all commands that the source holds now, then stop."""
    with _entries(commands.sparkSession):
        run_available(s01_stream_commands(commands, t, standing), out, checkpoint)
