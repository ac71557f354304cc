"""Level changes of maintenance records as a stream, one set job per micro-batch.

Every micro-batch writes its history and its impact rows below its own batch number, with
overwrite, so a retried batch replaces what it wrote before. What earlier batches wrote is
read back: levels go on from there, and a known pair of record and booking is not repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomgrid.plans.workflow import w08_change_impact_level, w08_impact_history, w09_escalation_impacts
from roomgrid.schema import SCHEMAS
from roomgrid.session import cut_lineage
from roomgrid.sources.tables import conform

CHANGES = "change_id bigint, at timestamp_ntz, maintenance_id bigint, new_level string, user_id bigint, note string"
_ORDER = ["at", "change_id"]


def written(spark, table: str, folder: str, before: int | None = None) -> DataFrame:
    """What the stream has written so far, up to a batch."""
    schema = T.StructType([*SCHEMAS[table].fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{folder}/{table}")
    return (rows if before is None else rows.where(F.col("batch") < before)).drop("batch")


def _with_levels(maintenance: DataFrame, history: DataFrame) -> DataFrame:
    latest = history.groupBy("maintenance_id").agg(
        F.max_by("new_impact_level", F.struct("changed_at", "impact_history_id")).alias("_level")
    )
    joined = maintenance.join(latest, "maintenance_id", "left")
    return joined.withColumn("impact_level", F.coalesce("_level", "impact_level")).select(*maintenance.columns)


def apply_changes(t, changes: DataFrame, batch: int, folder: str) -> None:
    """One micro-batch: history rows, then one follow-up row per newly hit booking."""
    spark = changes.sparkSession
    history, impacts = (written(spark, name, folder, batch) for name in ("impact_history", "booking_impact"))
    now = t.replace(
        maintenance=_with_levels(t["maintenance"], history),
        impact_history=t["impact_history"].unionByName(history),
        booking_impact=t["booking_impact"].unionByName(impacts),
    )
    outcomes = cut_lineage(w08_change_impact_level(now, changes, order=_ORDER))
    made = w08_impact_history(now, outcomes, F.col("at"), order=_ORDER)
    conform(made, "impact_history").write.mode("overwrite").parquet(f"{folder}/impact_history/batch={batch}")
    hit = w09_escalation_impacts(now, outcomes)
    conform(hit, "booking_impact").write.mode("overwrite").parquet(f"{folder}/booking_impact/batch={batch}")


def s02_stream_escalations(changes: DataFrame, t, folder: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Run the changes the source holds now; returns (history rows, impact rows) written so far."""
    spark = changes.sparkSession
    for table in ("impact_history", "booking_impact"):
        # so that the first batch finds a table
        spark.createDataFrame([], SCHEMAS[table]).write.mode("overwrite").parquet(f"{folder}/{table}/batch=-1")
    query = (
        changes.writeStream.foreachBatch(lambda rows, batch: apply_changes(t, rows, batch, folder))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return written(spark, "impact_history", folder), written(spark, "booking_impact", folder)
