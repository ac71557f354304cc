"""First come, first served: who gets a time slot when many ask for overlapping ones.

Within a group the requests are looked at in order; one is accepted unless its wide interval
overlaps the narrow interval of one accepted before. The rule is serial, but only among
requests that touch: the wide intervals of a group fall into islands that cannot influence
each other. Islands of one request are accepted at once, the others are decided island by
island in Python workers.

Rounds of set operations decide the rows of an island of more than ``max_island`` requests, each
exact:

1. A row that meets nobody earlier is accepted.
2. A row is plain if nobody earlier whom it meets starts after it. Among plain rows the accepted
   ones are linked: after one comes that which starts first among those that begin when it is
   over. Each row points to at most one other, so pointer doubling marks what can be reached
   from the rows of step 1, a line of n rows in log2(n) steps. A link is broken where the next
   row also waits for a row that is not plain.
3. Whoever meets an accepted row that came earlier is refused. The rest is turned round in
   time, so that the next round follows lines in the other direction.

A line that turns round in time goes on inside the gap between two accepted rows, which is at
most as long as the longest request, so few turns are to be expected. Rounds end when all is
decided, or when one in each direction decides less than a twentieth; that needs many rows that wait for both
sides. What is left then is small islands, or goes to the worker in order as a stream.

"Who is the first that this interval meets?" is asked with cells of 1, 2, 4, ... time units: an
interval is covered by two cells a size at most, a point lies in one of each, and only the
first row of a cell is kept. No pairs are formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomgrid.functions.exprs import epoch_second
from roomgrid.operators.slices import ROWS_PER_SLICE, numbered, running
from roomgrid.session import cut_lineage

MAX_ISLAND = 1 << 20
# two rounds, one in each direction, that decide less than this share of the open requests are the last
WORTHWHILE = 0.05
#: microseconds of the time units, largest first; all times must be multiples of the one taken
_UNITS = (3_600_000_000, 60_000_000, 1_000_000, 1)


def with_islands(
    df: DataFrame, keys: list[str], span: tuple[str, str], row_id: str, *, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Add ``island``: the id of the first row of the run of touching intervals."""
    start, end = span
    order = [start, row_id]
    reached = running(df, keys, order, {"_reached": ("max", F.col(end))}, rows_per_slice=rows_per_slice)
    opens = F.when(F.col("_reached").isNull() | (F.col("_reached") <= F.col(start)), F.struct(start, row_id))
    named = running(reached, keys, order, {"_opening": ("max", opens)}, inclusive=True, rows_per_slice=rows_per_slice)
    return named.withColumn("island", F.col(f"_opening.{row_id}")).drop("_reached", "_opening")


def _server():
    """The function for the workers; as a nested function it travels by value, so they need not have this package."""
    from bisect import bisect_left

    def serve(batches):
        # rows come sorted by group, island and order; only the accepted intervals of one island are kept
        current, starts, ends = None, [], []
        for batch in batches:
            verdicts = []
            for group, island, lo, hi, ws, we in zip(
                batch["_group"], batch["island"], batch["_ns"], batch["_ne"], batch["_ws"], batch["_we"]
            ):
                if (group, island) != current:
                    current, starts, ends = (group, island), [], []
                # accepted intervals are disjoint: only the last one that starts before the end can overlap
                place = bisect_left(starts, we)
                free = place == 0 or ends[place - 1] <= ws
                if free:
                    at = bisect_left(starts, lo)
                    starts.insert(at, lo)
                    ends.insert(at, hi)
                verdicts.append(free)
            yield batch[["_id"]].assign(accepted=verdicts)

    return serve


def _decide_islands(open_rows: DataFrame, keys, order, narrow, wide, row_id) -> DataFrame:
    lean = open_rows.select(
        F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("_group"),
        "island",
        *order,
        F.col(row_id).alias("_id"),
        epoch_second(narrow[0]).alias("_ns"),
        epoch_second(narrow[1]).alias("_ne"),
        epoch_second(wide[0]).alias("_ws"),
        epoch_second(wide[1]).alias("_we"),
    )
    schema = T.StructType([T.StructField("_id", T.LongType()), T.StructField("accepted", T.BooleanType())])
    return (
        lean.repartition("_group", "island")
        .sortWithinPartitions("_group", "island", *order)
        .mapInPandas(_server(), schema)
        .withColumnRenamed("_id", row_id)
    )


_TIMES = ["_ns", "_ne", "_ws", "_we"]


def _in_units(rows: DataFrame) -> tuple[DataFrame, int]:
    """Times in the largest unit that loses nothing, and how many sizes of cells the longest interval needs."""
    whole = [F.bool_and(F.greatest(*[F.pmod(F.col(c), F.lit(unit)) for c in _TIMES]) == 0) for unit in _UNITS]
    *fits, longest = rows.agg(*whole, F.max(F.col("_we") - F.col("_ws"))).first()
    unit = _UNITS[fits.index(True)]
    return rows.withColumns({c: F.expr(f"{c} div {unit}L") for c in _TIMES}), (longest // unit).bit_length()


def _cells_of_point(point: str, sizes: int):
    return F.expr(f"explode(transform(sequence(0, {sizes}), l -> struct(l as size, shiftright({point}, l) as cell)))")


def _cells_of_span(start: str, end: str, sizes: int):
    """The largest cells that lie inside [start, end) and do not overlap."""
    first, last = f"shiftright({start} + shiftleft(1L, l) - 1, l)", f"shiftright({end}, l)"
    at_start = f"if({first} < {last} and pmod({first}, 2) = 1, struct(l as size, {first} as cell), null)"
    at_end = f"if({first} < {last} and pmod({last}, 2) = 1, struct(l as size, {last} - 1 as cell), null)"
    cells = f"flatten(transform(sequence(0, {sizes}), l -> array({at_start}, {at_end})))"
    return F.expr(f"explode(filter({cells}, c -> c is not null))")


def _first(asking: DataFrame, asked_cells, given: DataFrame, given_cells) -> DataFrame:
    """(_place, _first): the least place among the given rows that share a cell with the asking one."""
    least = given.select("_group", "_place", given_cells.alias("_cell")).groupBy("_group", "_cell").agg(F.min("_place").alias("_least"))
    return (
        asking.select("_group", "_place", asked_cells.alias("_cell"))
        .join(least, ["_group", "_cell"])
        .groupBy("_place")
        .agg(F.min("_least").alias("_first"))
    )


def _marked(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Add whether the first row found comes before the row itself."""
    return rows.join(found, "_place", "left").withColumn(name, F.coalesce(F.col("_first") < F.col("_place"), F.lit(False))).drop("_first")


def _linked(plain: DataFrame, rows_per_slice: int) -> DataFrame:
    """(_place, _next, _on): the first plain row that starts when this one is over, unless it waits for others too."""
    later_first = [(-F.col("_ns")).alias("_start"), (-F.col("_place")).alias("_then")]
    starts = plain.select("_group", "_place", (-F.col("_ws")).alias("_t"), F.lit(0).alias("_asks"), *later_first, "_waits")
    ends = plain.select("_group", "_place", (-F.col("_ne")).alias("_t"), F.lit(1).alias("_asks"), "_on")
    start = F.when(F.col("_asks") == 0, F.struct("_start", "_then", "_waits"))
    scanned = running(
        starts.unionByName(ends, allowMissingColumns=True),
        ["_group"],
        ["_t", "_asks", "_place"],
        {"_found": ("max", start)},
        rows_per_slice=rows_per_slice,
    )
    following = F.when(~F.col("_found._waits"), -F.col("_found._then"))
    return scanned.where("_asks = 1").select("_place", following.alias("_next"), "_on")


def _reached(links: DataFrame) -> DataFrame:
    """(_place) of the rows that are on or can be reached from one, by pointer doubling."""
    links = cut_lineage(links)
    count = links.where("_on").count()
    while True:
        going = links.where("_next is not null")
        hit = going.where("_on").select(F.col("_next").alias("_place")).distinct().withColumn("_hit", F.lit(True))
        beyond = going.select(F.col("_place").alias("_next"), F.col("_next").alias("_beyond"))
        farther = going.join(beyond, "_next", "left").select("_place", F.col("_beyond").alias("_next"), "_on")
        moved = farther.unionByName(links.where("_next is null")).join(hit, "_place", "left")
        links = cut_lineage(moved.select("_place", "_next", (F.col("_on") | F.col("_hit").isNotNull()).alias("_on")))
        before, count = count, links.where("_on").count()
        if count == before:
            return links.where("_on").select("_place")


def _meets(asking: DataFrame, span: tuple[str, str], given: DataFrame, other: tuple[str, str], sizes: int, name: str) -> DataFrame:
    """Add whether ``span`` overlaps the other interval of a given row that comes earlier."""
    inside = _first(asking, _cells_of_span(*span, sizes), given, _cells_of_point(other[0], sizes))
    around = _first(asking, _cells_of_point(span[0], sizes), given, _cells_of_span(*other, sizes))
    return _marked(_marked(asking, inside, "_a"), around, "_b").withColumn(name, F.col("_a") | F.col("_b")).drop("_a", "_b")


def _round(rows: DataFrame, sizes: int, rows_per_slice: int) -> DataFrame:
    """Add ``verdict``; NULL where the round cannot tell. ``rows``: _group, _place and times as whole numbers."""
    narrow, wide = ("_ns", "_ne"), ("_ws", "_we")
    met = _meets(rows, wide, rows, wide, sizes, "_held")
    # an earlier row that starts after this one: within its wide interval, or beyond it but reaching back into it
    within = _first(rows, _cells_of_span("_ns + 1", "_we", sizes), rows, _cells_of_point("_ns", sizes))
    beyond = _first(rows, _cells_of_point("_we - 1", sizes), rows, _cells_of_span("_ws", "_ns", sizes))
    known = cut_lineage(
        _marked(_marked(met, within, "_a"), beyond, "_b").select(
            *rows.columns, (~F.col("_a") & ~F.col("_b")).alias("_plain"), (~F.col("_held")).alias("_on")
        )
    )
    waiting = _meets(known.where("_plain"), wide, known.where("not _plain"), narrow, sizes, "_waits")
    taken = _reached(_linked(waiting, rows_per_slice)).withColumn("_taken", F.lit(True))
    served = cut_lineage(
        known.join(taken, "_place", "left").select(*rows.columns, (F.col("_on") | F.col("_taken").isNotNull()).alias("_on"))
    )
    takers, rest = served.where("_on").drop("_on"), served.where("not _on").drop("_on")
    shut = _meets(rest, wide, takers, narrow, sizes, "_shut")
    return takers.withColumn("verdict", F.lit(True)).unionByName(
        shut.withColumn("verdict", F.when(F.col("_shut"), F.lit(False))).drop("_shut")
    )


def _turned(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_ns": -F.col("_ne"), "_ne": -F.col("_ns"), "_ws": -F.col("_we"), "_we": -F.col("_ws")})


def _microsecond(column: str):
    since = f"cast({column} - timestamp_ntz'1970-01-01 00:00:00' as interval second)"
    return F.expr(f"cast(cast({since} as decimal(20, 6)) * 1000000 as bigint)")


def first_come(
    requests: DataFrame,
    keys: list[str],
    order: list[str],
    narrow: tuple[str, str],
    wide: tuple[str, str],
    row_id: str,
    *,
    max_island: int = MAX_ISLAND,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(row_id, accepted). ``order`` must be total; the wide interval contains the narrow one, which ends after it starts."""
    columns = list(dict.fromkeys([*keys, *order, *narrow, *wide, row_id]))
    islands = cut_lineage(with_islands(requests.select(*columns), keys, wide, row_id, rows_per_slice=rows_per_slice))
    sizes = cut_lineage(islands.groupBy(*keys, "island").agg(F.count("*").alias("_n")))
    sized = islands.join(sizes, [*keys, "island"])
    out = sized.where("_n = 1").select(row_id, F.lit(True).alias("accepted"))
    middle = sized.where((F.col("_n") > 1) & (F.col("_n") <= max_island))
    out = out.unionByName(_decide_islands(middle, keys, order, narrow, wide, row_id))
    if sizes.where(F.col("_n") > max_island).isEmpty():
        return out
    times = [_microsecond(c).alias(t) for c, t in zip([*narrow, *wide], _TIMES)]
    group = F.to_json(F.struct(*keys)).alias("_group")
    open_rows = numbered(sized.where(F.col("_n") > max_island), order, "_place").select(group, "_place", F.col(row_id).alias("_id"), *times)
    open_rows, cells = _in_units(cut_lineage(open_rows))
    poor = 0
    while True:
        total = open_rows.count()
        decided = cut_lineage(_round(open_rows, cells, rows_per_slice))
        done = decided.where(F.col("verdict").isNotNull())
        out = out.unionByName(done.select(F.col("_id").alias(row_id), F.col("verdict").alias("accepted")))
        left = total - done.count()
        if not left:
            return out
        open_rows = _turned(decided.where(F.col("verdict").isNull()).drop("verdict"))
        poor = poor + 1 if total - left < WORTHWHILE * total else 0
        if poor == 2:  # in either direction
            rest = requests.select(*columns).join(open_rows.select(F.col("_id").alias(row_id)), row_id, "left_semi")
            rest = cut_lineage(with_islands(rest, keys, wide, row_id, rows_per_slice=rows_per_slice))
            return out.unionByName(_decide_islands(rest, keys, order, narrow, wide, row_id))
