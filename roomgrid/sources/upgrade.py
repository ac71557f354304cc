"""From the first version of the tables to the second."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomgrid.schema import OUT_OF_SERVICE
from roomgrid.sources.tables import Tables


def _defaulted(df: DataFrame, column: str, value) -> DataFrame:
    """Fill the column's gaps, or add it if it is not there."""
    return df.withColumn(column, F.coalesce(F.col(column), value) if column in df.columns else value)


def with_impact_level(maintenance: DataFrame) -> DataFrame:
    return _defaulted(maintenance, "impact_level", F.lit(OUT_OF_SERVICE))


def with_auto_approval(policies: DataFrame) -> DataFrame:
    return _defaulted(policies, "auto_approval_enabled", F.lit(False))


def with_advisory_times(bookings: DataFrame) -> DataFrame:
    missing = F.lit(None).cast("timestamp_ntz")
    absent = [c for c in ("advisories_presented_at", "advisory_acknowledged_at") if c not in bookings.columns]
    return bookings.withColumns({c: missing for c in absent})


def upgrade_phase1(tables: Mapping[str, DataFrame]) -> Tables:
    """Add impact level, advisory times and auto approval. A second run changes nothing."""
    return Tables(
        {
            **{name: (lambda n=name: tables[n]) for name in tables},
            "maintenance": lambda: with_impact_level(tables["maintenance"]),
            "booking_policy": lambda: with_auto_approval(tables["booking_policy"]),
            "booking": lambda: with_advisory_times(tables["booking"]),
        }
    )
