"""The most specific booking policy of a request.

A policy names a room, a role and a purpose, each of which may be open. Instead of a join
on open conditions, the policies are folded into one short list per room (there are at most
56 pairs of role and purpose, open ones included) and one list for policies without a room.
A request then needs one equi join on its room, and the choice happens inside the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CHOSEN = ["policy_id", "minimum_lead_minutes", "cancellation_lead_minutes", "pre_buffer_minutes", "post_buffer_minutes"]


def _folded(policies: DataFrame) -> DataFrame:
    """One row per scope: its newest policy, and whether any policy of the scope allows auto approval."""
    return policies.groupBy("space_id", "applicable_role", "applicable_purpose").agg(
        F.max(F.struct(*_CHOSEN)).alias("best"), F.bool_or("auto_approval_enabled").alias("auto")
    )


def with_policy(requests: DataFrame, policies: DataFrame, role: str = "role", purpose: str = "purpose") -> DataFrame:
    """Add the chosen policy's columns (NULL without a match) and ``auto_allowed``.

    Order of choice: names the room, names the role, names the purpose, highest id. Auto
    approval needs the flag on any matching policy, not only on the chosen one.
    """
    scopes = _folded(policies)
    entry = F.struct("applicable_role", "applicable_purpose", "best", "auto")
    per_space = (
        scopes.where(F.col("space_id").isNotNull())
        .groupBy(F.col("space_id").alias("_policy_space"))
        .agg(F.collect_list(entry).alias("_own"))
    )
    anywhere = scopes.where(F.col("space_id").isNull()).agg(F.collect_list(entry)).scalar()

    def fits(p):
        return (p["applicable_role"].isNull() | (p["applicable_role"] == F.col(role))) & (
            p["applicable_purpose"].isNull() | (p["applicable_purpose"] == F.col(purpose))
        )

    def scored(names_space: int):
        return lambda p: F.struct(
            F.lit(names_space).alias("a"),
            p["applicable_role"].isNotNull().alias("b"),
            p["applicable_purpose"].isNotNull().alias("c"),
            p["best"].alias("best"),
            p["auto"].alias("auto"),
        )

    joined = requests.join(per_space, requests["space_id"] == per_space["_policy_space"], "left").withColumn("_any", anywhere)
    matching = F.concat(
        F.transform(F.filter(F.coalesce("_own", F.array().cast(per_space.schema["_own"].dataType)), fits), scored(1)),
        F.transform(F.filter("_any", fits), scored(0)),
    )
    chosen = joined.withColumn("_fit", matching).withColumn("_best", F.array_max("_fit")["best"])
    return chosen.select(
        *requests.columns,
        *[F.col(f"_best.{c}").alias(c) for c in _CHOSEN],
        F.exists("_fit", lambda p: F.coalesce(p["auto"], F.lit(False))).alias("auto_allowed"),
    )
