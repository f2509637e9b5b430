"""Writers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Parquet; monthly facts are partitioned by their month key.

    The rebalance hint gathers the rows of a month into few files and splits a
    month that holds very many rows over several tasks."""
    writer = df.write
    if partition_by:
        writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by)
    writer.mode("overwrite").parquet(path)


def write_facts(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """The facts as a table of the catalogue, its files in ``path`` by hash of
    ``key`` and sorted by it. Grouping by the key and joins with another table
    of as many buckets then need no shuffle, each time the table is read.

    For keys that are nearly unique: all rows of a key are in one file, so a key
    with a large share of the rows is better grouped from a plain table, where
    rows combine before the shuffle. Rows without a key are refused."""
    key_column = F.coalesce(F.col(key), F.raise_error(F.lit(f"a row has no {key}")).cast(df.schema[key].dataType))
    keyed = df.withColumn(key, key_column).repartition(buckets, key)
    keyed.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header="true", escape='"', quote='"').csv(path)


def write_records(df: DataFrame, path: str) -> None:
    """Nested records as JSON lines; null fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
