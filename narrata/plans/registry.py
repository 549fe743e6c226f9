"""The catalogue of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.session import release

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}

_shared: dict[tuple, object] = {}


def query(name: str, twin: str | None = None):
    """Register ``fn(spark, sf_dir)``; every double of the result is rounded to 6 decimals."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return six_decimals(fn(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if twin is not None:
            TWINS[name] = twin
        return fn

    return add


def six_decimals(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def forget(spark: SparkSession) -> int:
    """Drop all shared tables of the session and delete what it has staged."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _shared if k[0] == app]:
        del _shared[key]
    return release(spark)


def state_of(spark: SparkSession, folder: str) -> int:
    """A number that changes when files of ``folder`` come, go or change."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hash(tuple(sorted(found)))


def shared(spark: SparkSession, sf_dir: str, key, build):
    """One staged table or fitted model per session and state of the folder, used by many queries."""
    full = (spark.sparkContext.applicationId, sf_dir, state_of(spark, sf_dir), key)
    if full not in _shared:
        _shared[full] = build()
    return _shared[full]
