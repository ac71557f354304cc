"""Tables that are replaced or added to as one step, with readers that stay on what they began with.

Rows go to new Parquet folders and are never changed. A version is one small file that lists
the folders of every table; it gets its name by a rename that fails if the name is taken.
Until then nobody sees the new rows, so a write that was cut off shows nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from roomgrid.schema import SCHEMAS, TABLES
from roomgrid.sources.tables import Tables, conform

_VERSIONS = "_versions"


class VersionTaken(RuntimeError):
    """Another run has written the version that was to follow."""


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _file_system(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _name(folder: str, version: int) -> str:
    return f"{folder}/{_VERSIONS}/{version:012}.json"


def _read(spark: SparkSession, folder: str, version: int) -> dict:
    if version == 0:
        return {"run": None, "tables": {}}
    jvm = spark.sparkContext._jvm
    stream = _file_system(spark, folder).open(_path(spark, _name(folder, version)))
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, folder: str, version: int, content: dict) -> bool:
    """Give the version its file; False if it has one."""
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    draft = _path(spark, f"{folder}/{_VERSIONS}/.{uuid.uuid4().hex}")
    stream = _file_system(spark, folder).create(draft, False)
    try:
        stream.write(json.dumps(content).encode())
    finally:
        stream.close()
    taken = jvm.org.apache.hadoop.fs.FileAlreadyExistsException
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), configuration)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, _path(spark, _name(folder, version)), options)
    except Exception as error:
        _file_system(spark, folder).delete(draft, False)
        cause = getattr(error, "java_exception", None)
        if cause is None or cause.getClass().getName() != taken._fqn:
            raise
        return False
    return True


def latest_version(spark: SparkSession, folder: str) -> int:
    """The number of the last version, 0 if there is none."""
    system, place = _file_system(spark, folder), _path(spark, f"{folder}/{_VERSIONS}")
    if not system.exists(place):
        return 0
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)


def read_version(spark: SparkSession, folder: str, version: int | None = None) -> Tables:
    """The twelve tables as of a version (the last one by default), whatever is written later.

    A table that was never written is empty.
    """
    held = _read(spark, folder, latest_version(spark, folder) if version is None else version)["tables"]

    def reader(name: str):
        def rows() -> DataFrame:
            if not held.get(name):
                return spark.createDataFrame([], SCHEMAS[name])
            return spark.read.schema(SCHEMAS[name]).parquet(*[f"{folder}/{part}" for part in held[name]])

        return rows

    return Tables({name: reader(name) for name in TABLES})


def write_version(
    spark: SparkSession,
    folder: str,
    base: int,
    run: str,
    replaced: Mapping[str, DataFrame] | None = None,
    appended: Mapping[str, DataFrame] | None = None,
) -> int:
    """Make version ``base + 1``: some tables replaced as a whole, rows added to others.

    The frames may read version ``base``; its folders stay as they are. ``run`` names the work:
    if the version is there already and is of the same run, nothing is written, so a job
    may be repeated. If it is another run's, ``VersionTaken`` is raised and nothing is changed: read
    again and decide anew. The tables not named are taken over.

    A rename that fails if the name is taken is what HDFS gives; on storage without one, writers
    of one folder have to take turns. Folders of a writer that lost stay, but no version names them.
    """
    replaced, appended = replaced or {}, appended or {}
    both = sorted(set(replaced) & set(appended))
    if both:
        raise ValueError(f"replaced and appended at once: {', '.join(both)}")
    version = base + 1

    def outcome() -> int:
        if _read(spark, folder, version)["run"] != run:
            raise VersionTaken(f"version {version} of {folder} was written by another run")
        return version

    last = latest_version(spark, folder)
    if last < base:
        raise ValueError(f"{folder} has no version {base}")
    if last > base:
        return outcome()
    tables = dict(_read(spark, folder, base)["tables"])
    for name, df in {**replaced, **appended}.items():
        part = f"{name}/{uuid.uuid4().hex}"
        conform(df, name).write.mode("errorifexists").parquet(f"{folder}/{part}")
        tables[name] = [part] if name in replaced else [*tables.get(name, []), part]
    return version if _publish(spark, folder, version, {"run": run, "tables": tables}) else outcome()
