"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.packaging import ship
from parcelmill.session import shared_folder

#: A record batch sent to Python ends at either bound, so that very long texts
#: do not pile up in one batch.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package and bound the batches sent to Python."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_shared(df: DataFrame, name: str) -> str:
    """Write ``df`` to the shared folder and return its path. The folder goes
    when the application ends; ``drop_shared`` deletes it earlier."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place, system = _place(spark, path)
    system.deleteOnExit(place)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read back."""
    path = write_shared(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_shared(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return bool(system.exists(place))


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``mapInArrow`` with the batch bounds of this folder."""
    prepare(df.sparkSession)
    return df.mapInArrow(work, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a string column; null counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column without decoding; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def learn_row(doc_id: str, divisor: int, held: int):
    """True unless crc32 of the id as text leaves ``held`` when divided."""
    return F.crc32(F.col(doc_id).cast("string")) % divisor != held


def held_out(doc_id: str, divisor: int, held: int):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % divisor == held, F.lit(False))
