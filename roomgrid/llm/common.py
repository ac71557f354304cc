"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.session import shared_dir

# White space of the word rules: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
_SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Bytes of a batch of rows that goes to Python, but for one row that is larger.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` mentions it.

    The optimizer may paste an expression into every place that names it, and into a lambda
    it is then computed once per element. A lambda's own argument is never pasted.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text, in order; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE_RUN), "")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """Hand rows to Python in batches that stay small when each holds a long text or list.

    Steps of one job share the number of rows, so batches are also bounded by ``BATCH_BYTES``: many rows of
    a few numbers are a batch, as many texts are several.
    """
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def stored(df: DataFrame, purpose: str = "step", batch_rows: int = 256) -> DataFrame:
    """Write the rows into the shared folder and read them from there.

    What follows does not repeat the work when an executor is lost, and jobs that read the
    rows several times compute them once. Python steps in between get ``batch_rows`` rows at
    a time.
    """
    path = shared_dir(df.sparkSession, purpose)
    with small_batches(df.sparkSession, batch_rows):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component: smallest node it reaches.

    Alternates two steps until nothing changes: each node hands the least of its neighbours
    to its larger neighbours, then to its smaller ones. Every round halves long chains, and a
    round is two sums by node and two joins, so a node with any number of edges is no group
    in one task. Rows with a null end are left out; so are loops.
    """
    edges = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    while True:
        large = _hand_down(edges.union(edges.select("b", "a")), larger=True)
        small = stored(_hand_down(large, larger=False), "edges")
        if _same(edges, small):
            break
        edges = small
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(found.select("component", "component").distinct())


def _hand_down(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (a, b), a > b, in which neighbours of a node hang on the least of them."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = edges.join(least, "a")
    if larger:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.where("m < a").select("a", F.col("m").alias("b"))
    else:
        moved = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
    return moved.union(own).where("a > b").distinct()


def _same(left: DataFrame, right: DataFrame) -> bool:
    """Whether two sets of edges agree: by their number and two sums of hashes."""

    def sign(df: DataFrame):
        h = F.xxhash64("a", "b").cast("decimal(38,0)")
        return df.agg(F.count("*").alias("n"), F.sum(h).alias("s"), F.sum(F.hash("a", "b").cast("long")).alias("t")).first()

    return sign(left) == sign(right)
