"""Contiguous shards of equal bytes (operator 3).

Rows are put in order of an id by a range shuffle. Each range partition gets
the byte and row totals of the partitions before it, so a running sum inside a
partition becomes a global prefix sum without a global sort in one task. A row
goes to the shard in whose equal share of all bytes the middle of the row lies,
which makes shards contiguous and their sizes differ from the share by at most
one row at either end. Texts never take part in the shuffle; only the id, the
size and the checksum do.

Defined cases: a null text has size 1 and no checksum; null ids come first;
repeated ids and repeated rows keep the order in which the source gives them,
and the range shuffle cuts through them, so one very common id does not fill a
task; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.llm.common import stage

LAW = "bytes"


def assign_shards(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard`` (0 to shards-1),
    ``slot`` (gapless within the shard from 0) and ``grown_shard`` (null)."""
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.col(text), "UTF-8")).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("seq"),
    )
    # The bounds of a range shuffle come from a sample, so the layout is written once and then only read.
    ranged = sized.repartitionByRange(F.col("doc_id").asc_nulls_first(), "seq").withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "ranged")
    # One row per partition; their running totals stay small whatever the table.
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
    )
    total = totals.agg(F.sum("bytes")).first()[0] or 1
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "seq")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(F.broadcast(offsets), "part").select(
        "doc_id", "size", "text_crc32",
        (F.col("bytes_before") + F.sum("size").over(upto)).alias("upto"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("index"),
    )
    # The middle of the row, doubled to stay in whole numbers.
    placed = placed.withColumn("shard", F.expr(f"cast((2 * upto - size) * {shards} div {2 * total} as int)"))
    first = placed.groupBy("shard").agg(F.min("index").alias("first_index"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("index") - F.col("first_index")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, shards: DataFrame, path: str) -> None:
    """Write ``docs`` as one folder per shard. ``shards`` comes from
    ``assign_shards`` on the same rows; ids must be unique. One task writes one
    range of a shard, so a shard may have several files, in slot order."""
    spread = docs.join(shards.select("doc_id", "shard", "slot"), "doc_id")
    spread.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
