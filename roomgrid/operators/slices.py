"""Ordered scans inside groups of any size.

A Spark window puts a whole group into one task. Here one group may hold a third of all
rows, so a scan first cuts the order of large groups into slices:

1. A fixed hash picks about one row in ``rows_per_slice`` as a cut point of its group; every
   row stays. The choice depends on the row's keys alone, so a task that is run again finds
   the same slices. A small group has no cut point as a rule, a large one has many.
2. Each row gets the number of its group's cut points up to its own order key. The cut points
   are joined by group, so a row only meets those of its own group. There is one in about two
   million rows, so they are sent to the rows: the rows travel once, for the window.
3. The window runs per (group, slice). What a slice needs from the slices before it comes
   from one aggregate row per slice, made for cut groups only and joined back.

Group keys may be NULL; NULLs are one group.

A whole table has no group to join by. It is sorted into ranges instead (``in_ranges``); sums
over the ranges, one row each, are added up on the driver and sent back.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomgrid.session import cut_lineage

ROWS_PER_SLICE = 1 << 21
_CHUNK = 512
SLICE = "_slice"

_EDGE = {"max": F.max, "min": F.min, "sum": F.sum}


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def with_slices(df: DataFrame, keys: list[str], order: list[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Add ``_slice`` and ``_cut``, whether the group has cut points. ``order`` should end in a unique column."""
    key = F.struct(*order)
    own = [f"_key_{k}" for k in range(len(keys))]
    cuts = (
        df.where(F.pmod(F.xxhash64(*keys, *order), F.lit(rows_per_slice)) == 0)
        .groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own)])
        .agg(F.sort_array(F.collect_set(key)).alias("_cuts"))
        .withColumn("_heads", F.filter("_cuts", lambda _, i: i % _CHUNK == 0))
    )
    # two short searches instead of one long one: first the chunk, then the place in it
    chunk = F.size(F.filter("_heads", lambda cut: cut <= key))
    within = F.slice("_cuts", F.greatest(F.col("_chunk") - 1, F.lit(0)) * _CHUNK + 1, _CHUNK)
    number = F.when(F.col("_chunk") > 0, (F.col("_chunk") - 1) * _CHUNK + F.size(F.filter(within, lambda cut: cut <= key)))
    return (
        df.join(F.broadcast(cuts), _same(keys, own), "left")
        .withColumn("_cut", F.col("_cuts").isNotNull())
        .withColumn("_chunk", F.when(F.col("_cut"), chunk).otherwise(0))
        .withColumn(SLICE, F.coalesce(number, F.lit(0)))
        .drop("_cuts", "_heads", "_chunk", *own)
    )


def _with_carry(df: DataFrame, keys: list[str], edges: list[Column], carries: list[Column]) -> DataFrame:
    """Add what each slice takes over from those before it; NULL in groups that are not cut."""
    own = [f"_key_{k}" for k in range(len(keys) + 1)]
    per_slice = df.where("_cut").groupBy(*keys, SLICE).agg(*edges)
    found = per_slice.select(*[F.col(k).alias(o) for k, o in zip([*keys, SLICE], own)], *carries)
    return df.join(F.broadcast(found), _same([*keys, SLICE], own), "left").drop("_cut", *own)


def neighbour(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    name: str,
    *,
    following: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add the value of the previous (or following) row of the group; NULL at its end."""
    shift, pick = (F.lead, F.min_by) if following else (F.lag, F.max_by)
    boxed = F.struct(F.col(value).alias("v"))
    sliced = with_slices(df, keys, order, rows_per_slice)
    slices = Window.partitionBy(*keys).orderBy(SLICE)
    carried = _with_carry(
        sliced,
        keys,
        [pick(boxed, F.struct(*order)).alias("_edge")],
        [shift("_edge").over(slices).alias("_carry")],
    )
    rows = Window.partitionBy(*keys, SLICE).orderBy(*order)
    return carried.withColumn(name, F.coalesce(shift(boxed).over(rows), F.col("_carry"))["v"]).drop("_carry", SLICE)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, tuple[str, Column]],
    *,
    inclusive: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add running ``max``/``min``/``sum`` values over the rows before each row of its group.

    ``values`` maps a new column to (kind, expression); NULL expressions are skipped. With
    ``inclusive`` the row itself counts too.
    """
    sliced = with_slices(df, keys, order, rows_per_slice)
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = _with_carry(
        sliced,
        keys,
        [_EDGE[kind](value).alias(f"_edge_{name}") for name, (kind, value) in values.items()],
        [_EDGE[kind](f"_edge_{name}").over(before).alias(f"_carry_{name}") for name, (kind, _) in values.items()],
    )
    rows = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    out = {}
    for name, (kind, value) in values.items():
        here, carry = _EDGE[kind](value).over(rows), F.col(f"_carry_{name}")
        if kind == "sum":
            out[name] = F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0))
        elif kind == "max":
            out[name] = F.when(here.isNull() | (carry > here), carry).otherwise(here)
        else:
            out[name] = F.when(here.isNull() | (carry < here), carry).otherwise(here)
    return carried.withColumns(out).drop(SLICE, *[f"_carry_{name}" for name in values])


def in_ranges(df: DataFrame, order: list[str], *, slices: int | None = None) -> DataFrame:
    """The whole table stored in ranges of a total order: adds ``_slice`` and ``_in_slice``, a row's place in it from 0.

    The ranges come from a sample, so they are stored with the rows; a second look sees the same ones.
    """
    ranges = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    placed = ranges.sortWithinPartitions(*order).withColumn("_slice_row", F.monotonically_increasing_id())
    # Spark's number is the partition's above 33 bits and the row's below them
    parts = {SLICE: F.shiftright("_slice_row", 33), "_in_slice": F.col("_slice_row").bitwiseAND(F.lit((1 << 33) - 1))}
    return cut_lineage(placed.withColumns(parts).drop("_slice_row"))


def _with_total_before(stored: DataFrame, value: Column) -> DataFrame:
    """Add ``_slice_start``: the sum of ``value`` over all earlier slices. The driver sees one row a slice."""
    sums = stored.groupBy(SLICE).agg(F.sum(value).alias("total")).orderBy(SLICE).collect()
    starts = accumulate((r["total"] for r in sums), initial=0)
    offsets = stored.sparkSession.createDataFrame(
        [(r[SLICE], before) for r, before in zip(sums, starts)], f"{SLICE} bigint, _slice_start bigint"
    )
    return stored.join(F.broadcast(offsets), SLICE)


def total_before(df: DataFrame, order: list[str], name: str, value: str, *, slices: int | None = None) -> DataFrame:
    """Add the sum of a whole number over all rows before each one in a total order of the table."""
    within = Window.partitionBy(SLICE).orderBy("_in_slice").rowsBetween(Window.unboundedPreceding, -1)
    summed = _with_total_before(in_ranges(df, order, slices=slices), F.col(value))
    here = F.coalesce(F.sum(value).over(within), F.lit(0))
    return summed.withColumn(name, F.col("_slice_start") + here).drop(SLICE, "_in_slice", "_slice_start")


def numbered(df: DataFrame, order: list[str], name: str, *, start: int = 0, slices: int | None = None) -> DataFrame:
    """Number all rows from ``start + 1`` in a total order; the same rows always get the same numbers."""
    counted = _with_total_before(in_ranges(df, order, slices=slices), F.lit(1))
    return counted.withColumn(name, F.col("_slice_start") + F.col("_in_slice") + (start + 1)).drop(SLICE, "_in_slice", "_slice_start")
