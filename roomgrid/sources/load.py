"""A load that can be repeated: rows are known by natural keys, new ones get ids of the target's own."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomgrid.operators.slices import numbered
from roomgrid.operators.upsert import absent_rows
from roomgrid.schema import FOREIGN_KEYS, NATURAL_KEYS, PRIMARY_KEYS, SCHEMAS, TABLES
from roomgrid.session import cut_lineage
from roomgrid.sources.tables import Tables, conform

#: Tables the load knows, parents before their children.
LOADED = tuple(name for name in TABLES if name in NATURAL_KEYS)
_NO_KEY_PLACES = 4096


def id_column(name: str) -> str | None:
    """The column that numbers the rows of a table, None where its natural key is its primary key."""
    key = PRIMARY_KEYS[name]
    return None if key == NATURAL_KEYS[name] else key[0]


class _Load:
    """One load; what several tables need of a parent is stored when the first asks for it."""

    def __init__(self, target: Mapping[str, DataFrame], source: Mapping[str, DataFrame]):
        self._target, self._source = target, source
        self._given: dict[str, DataFrame] = {}
        self._added: dict[str, DataFrame] = {}
        self._ids: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        """The source rows, with references to the target's rows."""
        if name not in self._given:
            rows = conform(self._source[name], name)
            references = [(column, parent) for child, column, parent, _ in FOREIGN_KEYS if child == name]
            for column, parent in references:
                rows = self._referring(rows, name, column, parent)
            self._given[name] = cut_lineage(rows) if references else rows
        return self._given[name]

    def _referring(self, rows: DataFrame, name: str, column: str, parent: str) -> DataFrame:
        held = F.col(column)
        if SCHEMAS[name][column].nullable:
            # rows that may lack a reference and do so need not travel
            return self._found(rows.where(held.isNotNull()), name, column, parent).unionByName(rows.where(held.isNull()))
        return self._found(rows, name, column, parent)

    def _found(self, rows: DataFrame, name: str, column: str, parent: str) -> DataFrame:
        held = F.col(column)
        # rows without a reference find no parent; they are dealt to many places, not to one
        spread = F.pmod(F.xxhash64(*PRIMARY_KEYS[name]), F.lit(_NO_KEY_PLACES))
        lost = F.concat(F.lit(f"{name}.{column} names no row of the given {parent}: "), held.cast("string"))
        return (
            rows.withColumn("_from", F.coalesce(held, -1 - spread))
            .join(self.ids(parent), F.col("_from") == F.col("_source_id"), "left")
            .withColumn(column, F.when(held.isNotNull(), F.coalesce("_target_id", F.raise_error(lost).cast("long"))))
            .drop("_from", "_source_id", "_target_id")
        )

    def added(self, name: str) -> DataFrame:
        """The rows the target lacks, one per natural key, numbered in the order of that key."""
        if name not in self._added:
            target, keys, number = self._target[name], NATURAL_KEYS[name], id_column(name)
            rows = absent_rows(target, self.given(name), keys)
            if number:
                highest = target.agg(F.coalesce(F.max(number), F.lit(0).cast("long"))).scalar()
                rows = numbered(rows, keys, "_number").withColumn(number, F.col("_number") + highest)
            self._added[name] = cut_lineage(conform(rows, name))
        return self._added[name]

    def table(self, name: str) -> DataFrame:
        return conform(self._target[name], name).unionByName(self.added(name))

    def ids(self, name: str) -> DataFrame:
        """The target's id of each source row; of target rows that share a natural key, the least."""
        if name not in self._ids:
            keys, number = NATURAL_KEYS[name], id_column(name)
            held = self.table(name).groupBy(*[F.col(k).alias(f"_t_{k}") for k in keys]).agg(F.min(number).alias("_target_id"))
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys])
            twice = F.concat(F.lit(f"{name} is given two natural keys under one id: "), F.col("_source_id").cast("string"))
            self._ids[name] = cut_lineage(
                self.given(name)
                .join(held, same)
                .groupBy(F.col(number).alias("_source_id"))
                .agg(F.min("_target_id").alias("_target_id"), F.max("_target_id").alias("_last"))
                .select(
                    "_source_id",
                    F.when(F.col("_target_id") == F.col("_last"), F.col("_target_id"))
                    .otherwise(F.raise_error(twice).cast("long"))
                    .alias("_target_id"),
                )
            )
        return self._ids[name]


def load_absent(target: Mapping[str, DataFrame], source: Mapping[str, DataFrame]) -> Tables:
    """The target with those source rows added whose natural key it does not hold.

    The source numbers its rows in its own way: users, spaces, facilities and bookings are
    found in the target by natural key, and the references of other tables follow. New rows
    get ids after the target's highest, in the order of their natural key, so a second run
    adds nothing. NULL equals NULL in a key (a policy for all rooms). Of source rows with one
    key the one with the smallest id is taken. A reference to a row the source does not hold, and
    one source id for two natural keys, are errors. A table is loaded when it is first read,
    its parents before it; the others stay as they are in the target.
    """
    load = _Load(target, source)

    def table(name: str):
        return lambda: load.table(name) if name in LOADED else target[name]

    return Tables({name: table(name) for name in target})
