"""RANK over sets of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomgrid.operators.slices import ROWS_PER_SLICE, running, total_before


def ranked(
    df: DataFrame,
    order: list[str],
    name: str,
    *,
    within: list[str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    slices: int | None = None,
) -> DataFrame:
    """Add RANK() over ``order`` ascending (use a negated column for descending).

    The rows are first counted per distinct order key, so ties never travel; the rank of a
    key is one plus the running count before it, and is joined back on the key. NULL keys
    are no problem: they are compared null-safe. Without ``within`` the keys are scanned in
    ``slices`` ranges of the whole table, by default as many as Spark makes.
    """
    groups = within or []
    keys = df.groupBy(*groups, *order).agg(F.count("*").alias("_n"))
    if groups:
        ranks = running(keys, groups, order, {name: ("sum", F.col("_n"))}, rows_per_slice=rows_per_slice)
    else:
        ranks = total_before(keys, order, name, "_n", slices=slices)
    ranks = ranks.select(*[F.col(c).alias(f"_k_{c}") for c in [*groups, *order]], (F.col(name) + 1).alias(name))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*groups, *order]]
    return df.join(ranks, same, "left").drop(*[f"_k_{c}" for c in [*groups, *order]])
