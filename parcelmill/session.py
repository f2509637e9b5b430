"""Session defaults and staged tables.

``stage`` is the one way this library cuts lineage: it writes a table to the
shared folder of the cluster and reads it back, so a lost executor never
costs more than the tasks it was running.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: One process on one machine; ``local-cluster`` is a cluster.
LOCAL = re.compile(r"local(\[.*)?$")


def build_session(name: str = "parcelmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. Pass extra settings as
    ``build_session(**{"spark.sql.shuffle.partitions": "4000"})``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # A relation named by a file path must not be readable from guarded SQL.
        "spark.sql.runSQLOnFiles": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster the setting is required, because a folder of one machine cannot be
    read by the others.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not LOCAL.match(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="parcelmill-"))
        folder = context.getCheckpointDir()
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_scopes: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Drop at the end of the block what was staged inside it. For work that
    writes its results; DataFrames that still read a staged table stop working."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return a scan of it.

    For inputs that several passes read and that are costly to rebuild, such
    as a join of large tables. Select the needed columns first.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path among the staged tables, for what is no DataFrame. What nobody
    drops earlier goes when the application ends."""
    path = f"{_staged_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    if _scopes:
        _scopes[-1].append(path)
    return path


def is_staged(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place))


def _staged_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/staged/{spark.sparkContext.applicationId}"


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application has staged. Call it when all results are
    written; DataFrames that still read a staged table stop working."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_staged_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: A table above this size is never spread; it has pieces enough.
SPREAD_BYTES = 512 << 20


def spread(df: DataFrame, key: str) -> DataFrame:
    """A small ``df`` in at least as many pieces as there are cores, by hash of
    ``key``, so that one Parquet row group does not keep all but one core idle.

    The bytes of the scan decide first: a table above ``SPREAD_BYTES`` is
    returned as it is and never shuffled, however many cores there are."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) > SPREAD_BYTES:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
