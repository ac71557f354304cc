"""Session settings and the shared folder for data that outlives one job."""

from __future__ import annotations

import atexit
import gc
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Only what the jobs rely on for right results or for skewed keys. Memory, cores and
# the number of shuffle partitions belong to whoever runs the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "roomgrid") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Local runs without a setting: one temporary folder per application.
_LOCAL: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors can reach.

    It is the one named in ``spark.checkpoint.dir``. Where that is unset, a run whose only
    process is the driver (``local`` or ``local[n]``) gets a temporary folder; on a cluster
    that would scatter the files over the executors' own disks, so it is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = context.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="roomgrid-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def shared_paths(spark: SparkSession) -> list[str]:
    """What this application has put into the shared folder and not removed, oldest first."""
    return list(_MADE.get(spark.sparkContext.applicationId, []))


def drop_paths(spark: SparkSession, paths: list[str]) -> int:
    """Remove some of ``shared_paths``; returns how many."""
    made = _MADE.get(spark.sparkContext.applicationId, [])
    configuration, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    gone = [name for name in paths if name in made]
    for name in gone:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(configuration).delete(path, True)
        made.remove(name)
    return len(gone)


def drop_shared(spark: SparkSession) -> int:
    """Remove everything this application has put into the shared folder; returns how many paths.

    Call it when the results of the jobs have been stored: frames that still read a step
    table cannot be computed afterwards.
    """
    return drop_paths(spark, shared_paths(spark))


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs whose frames are out of use.

    Spark does so when the driver's collector finds them, which may be long after their
    disk space is wanted.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Places to which a stored step deals its rows at least.
FINE = 256


@contextmanager
def finely_dealt(spark: SparkSession) -> Iterator[None]:
    """Deal rows to many places, of which Spark puts small neighbours together: large tables are sorted in memory.

    A number that the session has set itself stays.
    """
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    given = spark.conf.get(name, None)
    if given is None:
        spark.conf.set(name, str(max(FINE, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(name)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store the rows as a table in the shared folder and go on from there.

    A lost executor then reads them again instead of replaying the plan, jobs that read them
    several times compute them once, and the planner knows their size.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "step")
    with finely_dealt(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """Store the rows of what ``build`` returns, then remove the steps it has stored on the way and their shuffles."""
    before = shared_paths(spark)
    df = cut_lineage(build())
    drop_paths(spark, [path for path in shared_paths(spark)[:-1] if path not in before])
    release_shuffles(spark)
    return df
