"""Session settings and the staging of intermediate tables."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Seconds of a job after which what it left on disk is worth a collection of garbage.
COLLECT_AFTER = 2.0

_local_roots: dict[str, str] = {}
_staged: dict[str, list[str]] = {}


def build_session(app: str = "narrata", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tuned for. ``conf`` keys use ``__`` for dots."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a private temporary one only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="narrata-")
    return _local_roots[app]


def stage(df: DataFrame, partition_by: list[str] | None = None, file_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    This cuts the lineage, survives lost executors, and gives Catalyst the true size of the
    table, so that it broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = owned_path(spark, "stage")
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    began = time.monotonic()
    writer.parquet(path)
    if time.monotonic() - began > COLLECT_AFTER:
        clean_shuffles(spark)
    made = spark.read.schema(df.schema).parquet(path)
    made._staged_path = path
    return made


def clean_shuffles(spark: SparkSession) -> None:
    """Spark deletes shuffle files of finished jobs once the driver has collected its garbage, which it may not do for the rest
    of a session: the disk would hold all steps of a query at once."""
    spark.sparkContext._jvm.System.gc()


def drop(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        spark, name = table.sparkSession, table._staged_path
        _delete(spark, name)
        _staged.get(spark.sparkContext.applicationId, []).remove(name)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def owned_path(spark: SparkSession, kind: str) -> str:
    """A new folder name under the staging root, which ``release`` deletes with the staged tables."""
    path = f"{staging_root(spark)}/{kind}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the tables this session has staged so far; returns their number. Call it once results are written:
    what reads a staged table fails from then on."""
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        _delete(spark, name)
    return len(paths)


def small_rows(df: DataFrame):
    """Rows of a summary table on the driver: one row a class, or a fixed number of rows for each of a few values."""
    return df.collect()
