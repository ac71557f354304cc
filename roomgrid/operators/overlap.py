"""Joins of intervals that overlap, without comparing all pairs of a group.

Intervals are half open and must end after they start (the domain check
``booking_time_order`` lists those that do not).

Two proper intervals overlap when one starts inside the other, so all pairs come from two
joins of points with intervals, each pair from exactly one of them. A point meets an
interval through a grid of time cells: the interval lies in at most two cells of the level
that fits its length (1 day, 32 days, 1024 days, ...), the point in one cell per level that
is in use. Open-ended intervals land on the coarsest level, so they cost no more rows than
short ones. The join is an equi join on (keys, level, cell); a busy room is spread over its
days, and Spark's adaptive skew handling can split what is still heavy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomgrid.functions.exprs import epoch_second, open_end
from roomgrid.operators.slices import ROWS_PER_SLICE, neighbour, running

# width of a cell: 1 day on level 0, 32 times as much on each next level; level 5 spans the calendar
_WIDTH = "shiftleft(86400L, 5 * _level)"
_LEVEL = "case " + " ".join(f"when {{length}} <= {86400 * 32**n} then {n}" for n in range(5)) + " else 5 end"


def _intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    timed = df.select("*", epoch_second(start).alias("_from"), epoch_second(end).alias("_to"))
    leveled = timed.select("*", F.expr(_LEVEL.format(length="(_to - _from)")).alias("_level"))
    cells = F.expr(f"explode(sequence(floor(_from / {_WIDTH}), floor((_to - 1) / {_WIDTH})))")
    return leveled.select(*df.columns, "_level", cells.alias("_cell"))


def _levels_of(intervals: DataFrame, start: str, end: str) -> Column:
    """The levels on which the intervals lie; finding them reads two columns."""
    length = intervals.select((epoch_second(end) - epoch_second(start)).alias("n"))
    return length.agg(F.expr(f"array_sort(collect_set({_LEVEL.format(length='n')}))")).scalar()


def _points(df: DataFrame, at: str, in_use: Column) -> DataFrame:
    """One row per level in use."""
    timed = df.select("*", epoch_second(at).alias("_at_second"), in_use.alias("_levels"))
    leveled = timed.select("*", F.explode("_levels").alias("_level"))
    return leveled.select(*df.columns, "_level", F.expr(f"floor(_at_second / {_WIDTH})").alias("_cell"))


def _on(keys: list[str]) -> list[str]:
    return [*keys, "_level", "_cell"]


def overlap_pairs(
    left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str], right_span: tuple[str, str]
) -> DataFrame:
    """All overlapping pairs, each once. Apart from ``keys`` the column names must differ.

    ``right`` should be the smaller table: its points go on every level, so that the levels
    in use need not be read from ``left``.
    """
    (ls, le), (rs, re) = left_span, right_span
    columns = [*left.columns, *[c for c in right.columns if c not in keys]]
    right_starts_inside = (
        _intervals(left, ls, le)
        .join(_points(right, rs, F.sequence(F.lit(0), F.lit(5))), _on(keys))
        .where((F.col(rs) >= F.col(ls)) & (F.col(rs) < F.col(le)))
    )
    left_starts_inside = (
        _points(left, ls, _levels_of(right, rs, re))
        .join(_intervals(right, rs, re), _on(keys))
        .where((F.col(ls) > F.col(rs)) & (F.col(ls) < F.col(re)))
    )
    return right_starts_inside.select(columns).unionByName(left_starts_inside.select(columns))


def self_overlap_pairs(df: DataFrame, keys: list[str], span: tuple[str, str], row_id: str, suffix: str = "_2") -> DataFrame:
    """All overlapping pairs of different rows of one table, each once.

    The row that starts first (lower id on equal starts) keeps its names, the other's columns
    get ``suffix``.
    """
    start, end = span
    other = df.select(*keys, *[F.col(c).alias(c + suffix) for c in df.columns if c not in keys])
    later = (F.col(start + suffix) > F.col(start)) | (
        (F.col(start + suffix) == F.col(start)) & (F.col(row_id + suffix) > F.col(row_id))
    )
    return (
        _intervals(df, start, end)
        .join(_points(other, start + suffix, _levels_of(df, start, end)), _on(keys))
        .where(later & (F.col(start + suffix) < F.col(end)))
        .drop("_level", "_cell")
    )


def overlap_flags(
    probes: DataFrame,
    blocks: dict[str, DataFrame],
    keys: list[str],
    probe_span: tuple[str, str],
    block_span: tuple[str, str],
    row_id: str,
    *,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add one boolean per entry of ``blocks``: does the probe overlap any of its rows? Emits no pairs.

    Probes stand at their end and blocks at their start in one order per group. A probe
    overlaps a block exactly when the latest end among the blocks that start before the
    probe ends lies after the probe's start. All entries share one scan.
    """
    (ps, pe), (bs, be) = probe_span, block_span
    events = probes.select(
        *keys,
        F.col(pe).alias("_at"),
        F.lit(0).alias("_kind"),
        F.col(row_id).cast("long").alias("_id"),
        F.lit(None).cast("timestamp_ntz").alias("_block_end"),
        F.struct(*probes.columns).alias("_row"),
    )
    no_row = F.lit(None).cast(events.schema["_row"].dataType)
    for kind, (name, rows) in enumerate(blocks.items(), start=1):
        # of the blocks that start together only the latest end matters
        per_start = (
            rows.select(*keys, F.col(bs).alias("_at"), open_end(be).alias("_end"))
            .groupBy(*keys, "_at")
            .agg(F.max("_end").alias("_block_end"))
        )
        events = events.unionByName(
            per_start.select(
                *keys, "_at", F.lit(kind).alias("_kind"), F.lit(0).cast("long").alias("_id"), "_block_end", no_row.alias("_row")
            )
        )
    latest = {
        f"_latest_{name}": ("max", F.when(F.col("_kind") == kind, F.col("_block_end")))
        for kind, name in enumerate(blocks, start=1)
    }
    scanned = running(events, keys, ["_at", "_kind", "_id"], latest, rows_per_slice=rows_per_slice)
    return scanned.where(F.col("_kind") == 0).select(
        "_row.*",
        *[F.coalesce(F.col(f"_latest_{name}") > F.col(f"_row.{ps}"), F.lit(False)).alias(name) for name in blocks],
    )


def self_overlap_flag(
    df: DataFrame, keys: list[str], span: tuple[str, str], row_id: str, name: str, *, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add a boolean: does the row overlap another row of its group? Emits no pairs.

    In start order, the row overlaps an earlier one when the latest end so far lies after
    its start, and a later one when the next row starts before it ends.
    """
    start, end = span
    order = [start, row_id]
    latest = running(df, keys, order, {"_latest": ("max", F.col(end))}, rows_per_slice=rows_per_slice)
    both = neighbour(latest, keys, order, start, "_next", following=True, rows_per_slice=rows_per_slice)
    hit = F.coalesce(F.col("_latest") > F.col(start), F.lit(False)) | F.coalesce(F.col("_next") < F.col(end), F.lit(False))
    return both.withColumn(name, hit).drop("_latest", "_next")


def at_least_pairs(values: DataFrame, floors: DataFrame, value: str, floor: str, bits: int = 31) -> DataFrame:
    """All pairs with ``value >= floor`` for whole numbers from 0 below 2**bits, as an equi join.

    The numbers from ``floor`` up fall into at most ``bits`` binary blocks; a value lies in
    exactly one of them.
    """
    inside = values.selectExpr("*", f"explode(sequence(0, {bits})) as _level").selectExpr(
        "*", f"shiftright(cast({value} as bigint), _level) as _block"
    )
    # a floor of zero or less accepts every value: the one block of the top level
    some = (
        floors.selectExpr("*", f"greatest(cast({floor} as bigint), 0L) - 1 as _below", f"explode(sequence(0, {bits})) as _level")
        .where(f"if(_below < 0, _level = {bits}, shiftright(_below, _level) % 2 = 0)")
        .selectExpr(*floors.columns, "_level", "shiftright(_below, _level) + 1 as _block")
    )
    return inside.join(some, ["_level", "_block"]).drop("_level", "_block")


def overlap_count(
    probes: DataFrame,
    blocks: DataFrame,
    keys: list[str],
    probe_span: tuple[str, str],
    block_span: tuple[str, str],
    row_id: str,
    name: str,
    *,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(row_id, number of blocks of its group that overlap the probe), for probes with any. Emits no pairs.

    A probe overlaps all blocks that start before it ends, less those that end by its start.
    """
    (ps, pe), (bs, be) = probe_span, block_span

    def events(df: DataFrame, at, kind: int, identity, started, ended) -> DataFrame:
        return df.groupBy(*keys, at.alias("_at"), F.lit(kind).alias("_kind"), identity.alias("_id")).agg(
            started.alias("_started"), ended.alias("_ended")
        )

    none, nobody = F.lit(0).cast("long"), F.lit(-1).cast("long")
    own = F.col(row_id).cast("long")
    # at equal times: ends, then probes, then starts
    line = (
        events(blocks, open_end(be), 0, nobody, F.sum(none), F.count("*"))
        .unionByName(events(probes, F.col(ps), 1, own, F.sum(none), F.sum(none)).withColumn("_sign", F.lit(-1)), True)
        .unionByName(events(probes, F.col(pe), 2, own, F.sum(none), F.sum(none)).withColumn("_sign", F.lit(1)), True)
        .unionByName(events(blocks, F.col(bs), 3, nobody, F.count("*"), F.sum(none)), True)
    )
    seen = running(
        line,
        keys,
        ["_at", "_kind", "_id"],
        {"_n_started": ("sum", F.col("_started")), "_n_ended": ("sum", F.col("_ended"))},
        rows_per_slice=rows_per_slice,
    )
    part = F.when(F.col("_sign") == 1, F.col("_n_started")).otherwise(-F.col("_n_ended"))
    return (
        seen.where(F.col("_sign").isNotNull()).groupBy(F.col("_id").alias(row_id)).agg(F.sum(part).alias(name)).where(F.col(name) > 0)
    )
