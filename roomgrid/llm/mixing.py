"""Mixing sources to target weights: each document repeats a Poisson number of times."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import table

LARGEST_RATE = 64  # a larger rate is a sum of independent draws of at most this rate
SEED = 20240229
#: Production weights: shares of the mixture by source; OTHER is shared by all sources not named.
WEIGHTS = {"src0": 0.10, "src1": 0.10, "src2": 0.08, "src3": 0.08}
OTHER = 0.64


def poisson_steps(rate: float) -> list[float]:
    """P(count <= k) for k = 0, 1, ... up to where no double below 1 lies beyond."""
    term, total, k, steps = math.exp(-rate), 0.0, 0, []
    while True:
        total += term
        steps.append(min(total, 1.0))
        k += 1
        term *= rate / k
        if k > rate and term < 2**-60:
            return steps


def _uniform(*parts: Column) -> Column:
    """A double between 0 and 1 that depends on the parts only."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def repetition_rates(df: DataFrame, weights: dict[str, float], other: float, source: str, text: str, epochs: float) -> dict[str | None, float]:
    """Mean repeats per named source, and under None of all others.

    The mixture has ``epochs`` times the code points of the input. Weights of sources that
    have no text are left out and the others scaled to 1. At most one row per weight comes
    to the driver.
    """
    named = F.when(F.col(source).isin(*weights), F.col(source)) if weights else F.lit(None).cast("string")
    rows = df.groupBy(named.alias("s")).agg(F.sum(F.length(text)).alias("n")).where("n > 0").collect()
    sizes = {r["s"]: r["n"] for r in rows}
    share = {s: other if s is None else weights[s] for s in sizes}
    whole = sum(share.values())
    if sizes and whole <= 0:
        raise ValueError("no source that has text has a weight above 0")
    total = sum(sizes.values())
    return {s: share[s] / whole * total * epochs / n for s, n in sizes.items()}


def mix(
    df: DataFrame,
    weights: dict[str, float] = WEIGHTS,
    other: float = OTHER,
    doc: str = "doc_id",
    source: str = "source",
    text: str = "text",
    epochs: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """All columns of the documents of the mixture, with ``_copy`` from 1 on and ``_order``.

    How often a document comes is the inverse Poisson distribution, with its source's mean
    repetition rate, at a number that a hash of the seed and its id picks; without an id, a
    hash of its text. So the same input gives the same mixture on any cluster, and rows with
    the same id repeat alike. Sources that are null or not named share ``other``, each by its
    size. A text without code points counts nothing and repeats like others of its source; if
    a source has no text at all, its documents come once. An empty table gives no rows.

    The copies are dealt to partitions and sorted there by ``_order``, a hash of seed, id
    and copy, which is a random order of the whole; writing in order of ``_order`` keeps it.
    """
    rates = repetition_rates(df, weights, other, source, text, epochs)
    row = F.col("row")
    id_of = F.coalesce(row[doc].cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(row[text], F.lit("")).cast("binary"))))
    rows = df.select(F.struct("*").alias("row")).withColumn("id", id_of)

    def repeats(rate: float) -> Column:
        draws = max(1, math.ceil(rate / LARGEST_RATE))
        steps = F.array(*[F.lit(x) for x in poisson_steps(rate / draws)])
        draw = lambda j: F.size(F.filter(steps, lambda step: step <= _uniform(F.lit(str(seed)), F.col("id"), j.cast("string"))))
        if draws == 1:  # the uniform number once, not once per step
            u = _uniform(F.lit(str(seed)), F.col("id"), F.lit("1"))
            return F.element_at(F.transform(F.array(u), lambda x: F.size(F.filter(steps, lambda step: step <= x))), 1)
        return F.aggregate(F.sequence(F.lit(1), F.lit(draws)), F.lit(0), lambda acc, j: acc + draw(j))

    name = F.coalesce(row[source].isin(*weights), F.lit(False)) if weights else F.lit(False)
    count = F.lit(1)
    for s, rate in rates.items():
        mine = ~name if s is None else name & (row[source] == s)
        count = F.when(mine, repeats(rate)).otherwise(count)
    copies = rows.withColumn("count", count).where("count > 0").select("row", "id", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    order = F.md5(F.concat_ws("|", F.lit(f"{seed} order"), "id", F.col("copy").cast("string")).cast("binary"))
    placed = copies.select("row.*", F.col("copy").cast("long").alias("_copy"), order.alias("_order"))
    return placed.repartition("_order").sortWithinPartitions("_order")


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return found.select("doc_id", "source", "text", F.col("_copy").alias("copy"), F.col("_order").alias("shuffle_key"))


#: (doc_id, copy) in ``copies``; {documents} names the table.
MIX_SQL = f"""
mixed_weights(source, weight) as (values {", ".join(f"('{s}', {w})" for s, w in WEIGHTS.items())}),
mixed_sizes as (
  select w.source as s, coalesce(any_value(w.weight), {OTHER}) as weight, sum(length(d.text)) as n
  from {{documents}} d left join mixed_weights w on w.source = d.source group by w.source having sum(length(d.text)) > 0
), mixed_rates as (
  select s, weight / sum(weight) over () * sum(n) over () / n as rate, greatest(1, ceil(weight / sum(weight) over () * sum(n) over () / n / {LARGEST_RATE})) as draws
  from mixed_sizes
), mixed_steps as (
  select s, k, sum(exp(-rate / draws + k * ln(rate / draws) - lgamma(k + 1))) over (partition by s order by k) as upto
  from mixed_rates, range(200) r(k)
), mixed_draws as (
  select d.doc_id, d.source, w.source as s, j, (cast('0x' || substr(md5('{SEED}|' || d.doc_id || '|' || j), 1, 13) as bigint) + 0.5) / 4503599627370496.0 as u
  from {{documents}} d left join mixed_weights w on w.source = d.source
  join mixed_rates t on t.s is not distinct from w.source, range(1, 1000) q(j) where j <= draws
), mixed_counts as (
  select doc_id, j, count(*) filter (upto <= u) as n from mixed_draws m join mixed_steps p on m.s is not distinct from p.s group by doc_id, j
), copies as (
  select doc_id, unnest(range(1, cast(sum(n) as bigint) + 1)) as copy from mixed_counts group by doc_id
)"""
OP5_SQL = f"""
with {MIX_SQL.replace("{documents}", "documents")}
select d.doc_id, d.source, d.text, copy, md5('{SEED} order|' || d.doc_id || '|' || copy) as shuffle_key from copies join documents d using (doc_id)
"""
