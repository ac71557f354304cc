"""The approval workflow as a stream.

Commands are approvals and changes of a maintenance level, in one stream, so that those of
one room see each other. What does not change while the stream runs is joined to it: the
gate facts of each booking (``workflow.standing_facts``) and the maintenance records. The
rest is state: one per room, with the intervals accepted and the levels changed so far. A
key is worked on by one task at a time, which gives "one approval per room at a time".

Within a micro-batch the commands of a room are taken by (at, command_id). The size of a
micro-batch bounds what one task holds; set ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``
on the source. State grows with the accepted intervals of a room. It can be trimmed only
with ``lead_rule``, which refuses requests that reach back before their own submission:
then no later request can meet an interval that ended before the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from roomgrid.functions.exprs import epoch_second, open_end
from roomgrid.plans.workflow import _active_people, known_gates
from roomgrid.schema import ACTIVE_MAINTENANCE, PERSONNEL

# Fixed value: the code of the optional lead-time rule, next to the codes in use.
LEAD_CODE = 51050
# Stands for NULL in whole numbers on their way to Python, where a NULL would make doubles of the column.
_NONE = -(1 << 63)
# Keys that stand for no key, and copies of a maker's row: no task gets all commands without a booking, record or room.
_NO_KEY_PLACES = 4096
_MAKER_PLACES = 64

COMMANDS = (
    "command_id bigint, kind string, at timestamp_ntz, booking_id bigint, decision_maker_user_id bigint, is_auto boolean, "
    "acknowledge boolean, maintenance_id bigint, new_level string, note string"
)
OUTCOMES = (
    "command_id bigint, kind string, space_id bigint, booking_id bigint, maintenance_id bigint, code int, result string, "
    "impacted_booking_id bigint"
)
# intervals taken (from, until, booking), all bookings approved, levels changed (record, level), pairs reported
_STATE = (
    "starts array<bigint>, ends array<bigint>, ids array<bigint>, approved array<bigint>, "
    "records array<bigint>, levels array<string>, hit_records array<bigint>, hit_bookings array<bigint>"
)


def prepare(commands: DataFrame, t, standing: DataFrame) -> DataFrame:
    """Join the commands to what is known about their booking or maintenance record."""
    makers = _active_people(t, "maker", PERSONNEL)
    # commands that name no booking or no record are dealt to many places, those of a busy maker as well
    spread = F.pmod(F.xxhash64("command_id"), F.lit(_NO_KEY_PLACES))
    placed = commands.select(
        "*",
        F.coalesce("booking_id", -1 - spread).alias("_booking"),
        F.coalesce("maintenance_id", -1 - spread).alias("_record"),
        (spread % _MAKER_PLACES).cast("int").alias("_place"),
    )
    makers = makers.select("maker_found", F.explode(F.sequence(F.lit(0), F.lit(_MAKER_PLACES - 1))).alias("maker_place"))
    # times travel as one second and three lengths, which are small numbers
    second = [
        ("requested_start_time", "_from"),
        ("requested_end_time", "_until"),
        ("effective_start", "_wide_from"),
        ("effective_end", "_wide_until"),
    ]
    standing = standing.select("*", *[epoch_second(c).alias(name) for c, name in second])
    start = F.coalesce("raw_from", F.lit(0))
    facts = standing.select(
        F.col("booking_id").alias("known_booking"),
        "space_id",
        "gate",
        "auto_allowed",
        "taken",
        "met",
        F.col("_from").alias("raw_from"),
        (F.col("_until") - F.coalesce("_from", F.lit(0))).alias("_length"),
        (F.col("_from") - F.col("_wide_from")).alias("_before"),
        (F.col("_wide_until") - F.col("_until")).alias("_after"),
    )
    records = t["maintenance"].withColumn("_until", open_end("completion_time")).select(
        F.col("maintenance_id").alias("record"),
        F.col("space_id").alias("record_space"),
        F.when(F.col("maintenance_status").isin(*ACTIVE_MAINTENANCE), F.col("impact_level")).alias("record_level"),
        epoch_second("start_time").alias("record_from"),
        epoch_second("_until").alias("record_until"),
    )
    joined = (
        placed.join(makers, (F.col("decision_maker_user_id") == F.col("maker_found")) & (F.col("_place") == F.col("maker_place")), "left")
        .join(records, (F.col("_record") == F.col("record")) & F.col("maintenance_id").isNotNull(), "left")
        .join(facts, (F.col("_booking") == F.col("known_booking")) & F.col("booking_id").isNotNull(), "left")
        .withColumns({"raw_until": start + F.col("_length"), "wide_from": F.col("raw_from") - F.col("_before")})
        .withColumn("wide_until", F.col("raw_until") + F.col("_after"))
    )
    room = F.coalesce("space_id", "record_space")
    subject = F.coalesce(F.when(F.col("kind") == "level", F.col("maintenance_id")).otherwise(F.col("booking_id")), F.col("command_id"))
    level_code = (
        F.when(~F.col("new_level").isin("advisory", "out-of-service"), 51045)
        .when(F.col("record").isNull(), 51046)
        .when(F.col("record_level").isNull(), 51048)
        .when(F.col("maker_found").isNull(), 51049)
    )
    code = F.when(F.col("kind") == "level", level_code).otherwise(known_gates())
    coded = joined.select(
        "*",
        F.coalesce(room, F.lit(-1).cast("long")).alias("_room"),
        # without a room only the commands of one booking or record can meet
        F.when(room.isNull(), F.pmod(F.xxhash64(subject), F.lit(_NO_KEY_PLACES))).otherwise(F.lit(0)).cast("long").alias("place"),
        epoch_second("at").alias("at_second"),
        F.coalesce("taken", F.lit(False)).alias("_taken"),
        code.cast("int").alias("code"),
    )

    def looked_at(column: str, name: str | None = None):
        # of a command that is refused already nothing else counts
        return F.when(F.col("code").isNull(), F.col(column)).alias(name or column)

    return coded.select(
        "command_id",
        "kind",
        F.col("_room").alias("space_id"),
        "place",
        F.timestamp_seconds("at_second").alias("at"),  # the watermark counts as at_second does, in any session zone
        looked_at("at_second"),
        "booking_id",
        F.coalesce("is_auto", F.lit(False)).alias("is_auto"),
        F.coalesce("acknowledge", F.lit(False)).alias("acknowledge"),
        "maintenance_id",
        *[looked_at(c) for c in ("new_level", "record_level", "record_from", "record_until", "raw_from", "raw_until", "wide_from", "wide_until")],
        F.col("_taken").alias("taken"),
        looked_at("met.maintenance_id", "met_records"),
        looked_at("met.impact_level", "met_levels"),
        "code",
    )


def _without_null(df: DataFrame) -> DataFrame:
    """Whole numbers with ``_NONE`` for NULL; codes with 0."""
    marks = {"bigint": _NONE, "int": 0}
    return df.select(*[F.coalesce(c, F.lit(marks[kind]).cast(kind)).alias(c) if kind in marks else c for c, kind in df.dtypes])


def _travelling(outcome_columns: list[str], none: int = _NONE):
    """What the workers do with frames of commands and outcomes; nested, so that it travels by value."""
    # what is looked at of a command, and of one that is still open
    always = "space_id", "command_id", "kind", "booking_id", "maintenance_id", "code"
    fields = (
        "space_id, place, at_second, command_id, kind, booking_id, maintenance_id, is_auto, acknowledge, new_level, record_level, "
        "record_from, record_until, raw_from, raw_until, wide_from, wide_until, taken, met_records, met_levels"
    ).split(", ")

    def given(key, batches):
        """The columns of the commands, and the open ones by room and in order, as tuples of ``fields``.

        Frames without a room belong to that of the key.
        """
        import numpy as np

        frames = list(batches)
        room = dict(zip(("space_id", "place"), key))

        def read(c: str):
            parts = [f[c].to_numpy() if c in f else np.full(len(f), room[c]) for f in frames]
            return parts[0] if len(parts) == 1 else np.concatenate(parts)

        columns = {c: read(c) for c in always}
        free = np.flatnonzero(columns["code"] == 0)
        if not len(free):
            return columns, ()
        of = {c: (columns[c] if c in columns else read(c))[free] for c in fields}
        order = np.lexsort([of[c] for c in ("command_id", "at_second", "place", "space_id")])
        return columns, zip(*(of[c][order].tolist() for c in fields))

    def outcomes(columns, decided: list):
        """One frame: the commands refused before, and what came of the others.

        ``decided``: room, command, kind, booking, record, code, result, impacted booking; ``none`` or 0 for NULL.
        """
        import numpy as np
        import pandas as pd

        refused = columns["code"] != 0
        of = {c: values[refused] for c, values in columns.items()}
        nothing = np.full(len(of["code"]), none)
        early = [
            of["space_id"], of["command_id"], of["kind"], np.where(of["kind"] == "level", none, of["booking_id"]),
            of["maintenance_id"], of["code"], np.full(len(nothing), None, dtype=object), nothing,
        ]
        late = list(zip(*decided)) or [()] * 8
        kinds = ["int64", "int64", object, "int64", "int64", "int32", object, "int64"]
        room, command, kind, booking, record, code, result, impacted = (
            np.concatenate([a.astype(k, copy=False), np.array(b, dtype=k)]) for a, b, k in zip(early, late, kinds)
        )

        def whole(values, missing=None):
            return pd.arrays.IntegerArray(values, np.zeros(len(values), dtype=bool) if missing is None else values == missing)

        made = [whole(command), kind, whole(room), whole(booking, none), whole(record, none), whole(code, 0), result, whole(impacted, none)]
        return pd.DataFrame(dict(zip(outcome_columns, made)), copy=False)

    return given, outcomes


def _decider(lead_rule: bool, lead_code: int, outcome_columns: list[str], none: int = _NONE):
    """The function for the workers; nested, so that it travels by value."""
    from bisect import bisect_left

    given, outcomes = _travelling(outcome_columns, none)

    def decide(key, batches, state):
        columns, commands = given(key, batches)
        space = int(key[0])
        starts, ends, ids, approved, records, levels, hit_records, hit_bookings = (
            [list(x) for x in state.get] if state.exists else [[] for _ in range(8)]
        )
        approved, level_of, reported = set(approved), dict(zip(records, levels)), set(zip(hit_records, hit_bookings))
        out = []

        for (
            _, _, at, command, kind, booking, record, is_auto, acknowledge, new_level, record_level, record_from, record_until,
            raw_from, raw_until, wide_from, wide_until, taken, met_records, met_levels,
        ) in commands:
            if kind == "level":
                if level_of.get(record, record_level) == new_level:
                    out.append((space, command, kind, none, record, 0, "Unchanged", none))
                    continue
                level_of[record] = new_level
                out.append((space, command, kind, none, record, 0, "Changed", none))
                if new_level == "out-of-service":
                    for lo, hi, hit in zip(starts, ends, ids):
                        if lo < record_until and hi > record_from and (record, hit) not in reported:
                            reported.add((record, hit))
                            out.append((space, command, kind, none, record, 0, "Impact", hit))
                continue
            code, place = 0, bisect_left(starts, wide_until)
            if booking in approved:
                code = 51036
            elif lead_rule and wide_from < at:
                code = lead_code
            elif taken or (place and ends[place - 1] > wide_from):
                code = 51041
            elif met_records is not None:
                now = {level_of.get(m, level) for m, level in zip(met_records, met_levels)}
                if "out-of-service" in now:
                    code = 51042
                elif "advisory" in now and not acknowledge:
                    code = 51043
            if not code:
                place = bisect_left(starts, raw_from)
                starts.insert(place, raw_from)
                ends.insert(place, raw_until)
                ids.insert(place, booking)
                approved.add(booking)
            out.append((space, command, kind, booking, record, code, None if code else "AutoApproved" if is_auto else "Approved", none))
        if lead_rule and state.getCurrentWatermarkMs() > 0:
            line = state.getCurrentWatermarkMs() // 1000
            keep = [i for i, end in enumerate(ends) if end > line]
            starts, ends, ids = ([x[i] for i in keep] for x in (starts, ends, ids))
        pairs = sorted(reported)
        state.update(
            (
                starts,
                ends,
                ids,
                sorted(approved),
                list(level_of),
                list(level_of.values()),
                [record for record, _ in pairs],
                [booking for _, booking in pairs],
            )
        )
        yield outcomes(columns, out)

    return decide


def s01_stream_approvals(
    commands: DataFrame, t, standing: DataFrame, *, lead_rule: bool = False, delay: str = "1 hour"
) -> DataFrame:
    """A stream of commands (columns ``COMMANDS``) to a stream of outcomes (columns ``OUTCOMES``).

    A level change reports the bookings that this stream has approved before; for those that
    were active when it started, run the changes through ``escalations`` as well.
    """
    ready = _without_null(prepare(commands, t, standing))
    ready = ready.withWatermark("at", delay) if lead_rule else ready.drop("at")
    names = [c.split()[0] for c in OUTCOMES.split(", ")]
    return ready.groupBy("space_id", "place").applyInPandasWithState(
        _decider(lead_rule, LEAD_CODE, names), OUTCOMES, _STATE, "append", GroupStateTimeout.NoTimeout
    )


def run_available(outcomes: DataFrame, out: str, checkpoint: str) -> None:
    """Write all outcomes that the source holds now, then stop."""
    query = (
        outcomes.writeStream.format("parquet")
        .option("compression", "zstd")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
