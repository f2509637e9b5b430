"""Random samples and row numbers that do not depend on the layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.session import stage

#: Rows that one task numbers, and copies of a row that one task makes.
PIECE_ROWS = 10_000
#: The draw of a key is 13 hexadecimal digits of a digest, below this number.
DRAWS = 1 << 52


def random_rows(df: DataFrame, n: int, seed: int, name: str = "sample", key: Sequence[str] = ()) -> DataFrame:
    """``n`` rows (all when there are fewer) drawn without replacement, staged,
    with a number ``_row`` from 0 in random order.

    The draw is an MD5 digest of the seed and the ``key`` columns, so it does not
    depend on how the rows are laid out, and any engine can make it. Without a key, or when rows agree in
    it, the draw is a hash of all columns and a number within equal rows.

    Rows are thinned to about three times the size where they are drawn, so the
    sort that picks exactly ``n`` stays small for a table of any size."""
    rows = df.count()
    share = min(1.0, 3 * (n + 100) / max(rows, 1))
    key = key if key and not _repeated(df, key) else ()
    drawn = _drawn(df, seed, key)
    # A digest of a key is uniform, so its smallest values are thinned by a limit.
    thin = drawn.filter(F.col("_draw") < int(share * DRAWS)) if key else drawn.filter(
        F.pmod(F.xxhash64("_draw"), F.lit(1 << 30)) < int(share * (1 << 30)))
    picked = thin.orderBy("_draw", *key).limit(n)
    # At most n rows, so the numbering may be one task.
    numbered = picked.withColumn("_row", F.row_number().over(Window.orderBy("_draw", *key)) - 1)
    return stage(numbered.drop("_draw"), name)


def numbered_rows(df: DataFrame, seed: int, name: str = "numbered") -> DataFrame:
    """All rows, staged, with a number ``_row`` from 0 in random order. Rows are
    dealt by their draw to pieces of a bounded size, numbered one by one."""
    drawn = stage(_drawn(df, seed), f"{name}-drawn")
    pieces = drawn.count() // PIECE_ROWS + 1
    dealt = drawn.withColumn("_piece", F.pmod(F.xxhash64("_draw"), F.lit(pieces)))
    # One row per piece.
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_piece").count().select(
        "_piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_piece").orderBy("_draw")) - 1
    numbered = dealt.withColumn("_inside", inside).join(F.broadcast(sizes), "_piece")
    return stage(numbered.select(*df.columns, (F.col("_before") + F.col("_inside")).alias("_row")), name)


def _drawn(df: DataFrame, seed: int, key: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``_draw``, a hash of the seed and the unique ``key``; without
    one, of all columns and a number within equal rows.

    Equal rows are counted, which combines before the shuffle, and made again in
    bounded pieces, so a row value of any share of the table is spread."""
    if key:
        told = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
        return df.withColumn("_draw", F.conv(F.substring(told, 1, 13), 16, 10).cast("bigint"))
    last = F.floor((F.col("_copies") - 1) / PIECE_ROWS)
    some = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_part"))
    first = F.col("_part") * PIECE_ROWS
    copies = some.repartition(*df.columns, "_part").select(
        *df.columns, F.explode(F.sequence(first, F.least(first + PIECE_ROWS, F.col("_copies")) - 1)).alias("_copy"))
    # A hash passes over nulls, so where they stand goes into it as well.
    nulls = [F.col(c).isNull() for c in df.columns]
    return copies.select(*df.columns, F.xxhash64(F.lit(seed), *df.columns, *nulls, "_copy").alias("_draw"))


def _repeated(df: DataFrame, key: Sequence[str]) -> bool:
    return not df.groupBy(F.xxhash64(*key).alias("_key")).count().filter("count > 1").isEmpty()
