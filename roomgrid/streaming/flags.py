"""Flags on pending bookings that maintenance of their room stands against, as either side arrives.

A booking and a maintenance record meet when the later of the two arrives. Each micro-batch
joins the new rows of either side with what is stored of the other and with each other, and then
stores them. Stored rows are sorted by room and start and are read with filters on the batch's
rooms and span of time, which Parquet answers from its statistics; what lies elsewhere is
skipped. Every micro-batch writes below its own number with overwrite, so a retried one replaces
what it wrote. The flags do not depend on how the arrivals are split into batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomgrid.functions.exprs import open_end
from roomgrid.operators.overlap import overlap_pairs
from roomgrid.plans.reports import active_maintenance
from roomgrid.plans.workflow import pending_bookings
from roomgrid.schema import OUT_OF_SERVICE
from roomgrid.session import cut_lineage

ARRIVALS = "at timestamp_ntz, kind string, id bigint, space_id bigint, start_time timestamp_ntz, end_time timestamp_ntz"
FLAGS = "booking_id bigint, maintenance_id bigint, flagged_at timestamp_ntz"
_KINDS = ("booking", "maintenance")


def arrivals_of(t, levels: tuple[str, ...] = (OUT_OF_SERVICE,)) -> DataFrame:
    """Pending bookings and active maintenance of the levels that block, as ``ARRIVALS``."""
    booked = pending_bookings(t).select(
        F.col("submitted_at").alias("at"),
        F.lit("booking").alias("kind"),
        F.col("booking_id").alias("id"),
        "space_id",
        F.col("requested_start_time").alias("start_time"),
        F.col("requested_end_time").alias("end_time"),
    )
    repairs = active_maintenance(t, levels).select(
        F.col("start_time").alias("at"),
        F.lit("maintenance").alias("kind"),
        F.col("maintenance_id").alias("id"),
        "space_id",
        "start_time",
        F.col("completion_time").alias("end_time"),
    )
    return booked.unionByName(repairs)


def _side(rows: DataFrame, kind: str) -> DataFrame:
    """One kind's rows with names of its own; a missing end lies in the far future."""
    return rows.where(F.col("kind") == kind).select(
        "space_id",
        F.col("id").alias(f"{kind}_id"),
        F.col("at").alias(f"{kind}_at"),
        F.col("start_time").alias(f"{kind}_start"),
        open_end("end_time").alias(f"{kind}_end"),
    )


def _meeting(booked: DataFrame, repairs: DataFrame) -> DataFrame:
    spans = [(f"{kind}_start", f"{kind}_end") for kind in _KINDS]
    pairs = overlap_pairs(booked, repairs, ["space_id"], *spans)
    return pairs.select("booking_id", "maintenance_id", F.greatest("booking_at", "maintenance_at").alias("flagged_at"))


def w13_pending_flags(t, levels: tuple[str, ...] = (OUT_OF_SERVICE,)) -> DataFrame:
    """(booking_id, maintenance_id, flagged_at): a pending booking and each record it cannot be approved against."""
    rows = arrivals_of(t, levels)
    return _meeting(*(_side(rows, kind) for kind in _KINDS))


def _earlier(spark, folder: str, kind: str, batch: int, new: DataFrame) -> DataFrame:
    """What is stored of a kind that may meet the new rows of the other."""
    rows = spark.read.schema(f"{ARRIVALS}, batch bigint").parquet(f"{folder}/{kind}").where(F.col("batch") < batch).drop("batch")
    span = new.agg(F.min("start_time"), F.max(open_end("end_time")), F.min("space_id"), F.max("space_id")).first()
    if span[0] is None:
        return rows.where(F.lit(False))
    first, last = (F.lit(value).cast("timestamp_ntz") for value in span[:2])
    near = (F.col("start_time") < last) & (F.col("end_time").isNull() | (F.col("end_time") > first))
    rooms = new.select("space_id").distinct()
    return rows.where(near & F.col("space_id").between(*span[2:])).join(rooms, "space_id", "left_semi")


def flag_batch(rows: DataFrame, batch: int, folder: str) -> None:
    """One micro-batch: flags of the new rows, then the rows themselves."""
    spark = rows.sparkSession
    arrived = cut_lineage(rows)
    new = {kind: arrived.where(F.col("kind") == kind) for kind in _KINDS}
    old = {kind: _earlier(spark, folder, kind, batch, new[other]) for kind, other in zip(_KINDS, reversed(_KINDS))}
    booked, repairs = ({"new": _side(new[kind], kind), "old": _side(old[kind], kind)} for kind in _KINDS)
    flags = _meeting(booked["new"].unionByName(booked["old"]), repairs["new"]).unionByName(_meeting(booked["new"], repairs["old"]))
    flags.write.mode("overwrite").parquet(f"{folder}/flags/batch={batch}")
    for kind in _KINDS:
        ordered = new[kind].repartitionByRange("space_id", "start_time").sortWithinPartitions("space_id", "start_time")
        ordered.write.mode("overwrite").parquet(f"{folder}/{kind}/batch={batch}")


def s03_stream_pending_flags(arrivals: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """Take the arrivals the source holds now; returns all flags written so far."""
    spark = arrivals.sparkSession
    for kind in _KINDS:
        # so that the first batch finds a table
        spark.createDataFrame([], ARRIVALS).write.mode("overwrite").parquet(f"{folder}/{kind}/batch=-1")
    query = (
        arrivals.writeStream.foreachBatch(lambda rows, batch: flag_batch(rows, batch, folder))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(f"{FLAGS}, batch bigint").parquet(f"{folder}/flags").drop("batch")
