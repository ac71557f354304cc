"""Typed reading and writing of the twelve tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.schema import SCHEMAS, TABLES


class Tables(Mapping[str, DataFrame]):
    """The tables by name; each is built on first use, so a job reads only what it needs."""

    def __init__(self, build: Mapping[str, Callable[[], DataFrame] | DataFrame]):
        self._build = dict(build)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            made = self._build[name]
            self._built[name] = made if isinstance(made, DataFrame) else made()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)

    def replace(self, **tables: DataFrame) -> "Tables":
        return Tables({**self._build, **self._built, **tables})


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns of the table's schema, in order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]])


def load_tables(spark: SparkSession, folder: str) -> Tables:
    """The twelve tables from Parquet, read with their declared schema."""

    def reader(name: str):
        return lambda: spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    return Tables({name: reader(name) for name in TABLES})


def write_tables(tables: Mapping[str, DataFrame], folder: str, names=TABLES) -> None:
    """Write tables as Parquet, one new folder per run; an existing table is an error."""
    for name in names:
        conform(tables[name], name).write.mode("errorifexists").parquet(f"{folder}/{name}.parquet")


def append_rows(df: DataFrame, name: str, folder: str) -> None:
    """Append rows to one of the history tables of a folder."""
    conform(df, name).write.mode("append").parquet(f"{folder}/{name}.parquet")


def table_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, and how many values of its nullable columns are filled."""
    parts = []
    for name in TABLES:
        optional = [f.name for f in SCHEMAS[name] if f.nullable]
        filled = sum((F.count(c) for c in optional), F.lit(0).cast("long"))
        parts.append(
            tables[name].agg(F.count("*").alias("row_count"), filled.alias("filled_optional_values")).withColumn(
                "table_name", F.lit(name)
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("table_name", "row_count", "filled_optional_values")
