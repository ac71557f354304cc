"""Keyed inserts that can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def absent_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The source rows whose key the target does not hold, one per key.

    NULL equals NULL in a key. Of several source rows with one key the smallest row stays,
    so a repeated run adds the same one.
    """
    # rows with one key differ in the other columns only, so one grouping finds the smallest and whether the key is held
    rest = F.struct(F.lit(False).alias("_held"), *[c for c in source.columns if c not in keys])
    rows = source.select(*keys, rest.alias("_row"))
    known = target.select(*keys).distinct().withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType))
    found = rows.unionByName(known).groupBy(*keys).agg(F.min("_row").alias("_row"), F.bool_or(F.col("_row").isNull()).alias("_known"))
    kinds = dict(source.dtypes)
    return found.where(~F.col("_known")).select(
        *[F.col(c).cast(kinds[c]).alias(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in source.columns]
    )


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target with those source rows added whose key it does not hold."""
    return target.unionByName(absent_rows(target, source, keys))
