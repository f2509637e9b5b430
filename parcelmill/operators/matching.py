"""Comparison of query results as sets, and scores of attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.constants import OUTCOMES, SOLVED_AT


def _cell(df: DataFrame, column: str) -> Column:
    """Number-like cells rounded to one decimal, others trimmed text."""
    text = F.col(f"`{column}`").cast("string")
    number = text.try_cast("double")
    return F.coalesce(F.round(number, 1).cast("string"), F.trim(text), F.lit("nan"))


def _cells(df: DataFrame) -> Column:
    return F.array_sort(F.array_distinct(F.array(*[_cell(df, c) for c in df.columns])))


def row_sets(df: DataFrame) -> DataFrame:
    """Each row as the sorted set of its cells; equal rows once. Names and
    order of columns, order of rows and repeats do not matter."""
    return df.select(_cells(df).alias("cells")).distinct()


def compare_results(left: DataFrame, right: DataFrame, tasks: int | None = None) -> DataFrame:
    """(left_only, right_only, shared, same) of two results as row sets. With
    ``tasks`` the rows are dealt into so many before they are grouped."""
    sides = left.select(_cells(left).alias("cells"), F.lit(1).alias("_side")).unionByName(
        right.select(_cells(right).alias("cells"), F.lit(2).alias("_side")))
    if tasks:
        sides = sides.repartition(tasks, "cells")
    seen = sides.groupBy("cells").agg(F.bit_or("_side").alias("seen"))
    return seen.agg(
        F.count_if(F.col("seen") == 1).alias("left_only"),
        F.count_if(F.col("seen") == 2).alias("right_only"),
        F.count_if(F.col("seen") == 3).alias("shared"),
    ).withColumn("same", (F.col("left_only") == 0) & (F.col("right_only") == 0))


#: Most buckets of a fingerprint, so that it fits the driver whatever the rows.
BUCKETS = 4096
#: Rows that one task compares, so that its memory does not grow with the results.
TASK_ROWS = 100_000


def _bucket(df: DataFrame, buckets: int) -> Column:
    return F.pmod(F.xxhash64(_cells(df)), F.lit(buckets))


def fingerprints(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, four sums of hash halves), one row per bucket that has
    rows. The sums do not depend on the order of the rows and are made in each
    task before the shuffle; of two results with the same fingerprint, the rows
    are the same up to a collision of 128-bit hashes. Halves of 32 bits keep the
    sums exact up to two billion rows a bucket."""
    one, two = F.xxhash64("_cells"), F.xxhash64(F.lit(1), "_cells")
    half, low = (1 << 32), F.lit((1 << 32) - 1)
    rows = df.select(_cells(df).alias("_cells")).select(
        F.pmod(one, F.lit(buckets)).alias("bucket"), one.alias("one"), two.alias("two"))
    return rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(part).alias(name) for h in ("one", "two") for name, part in (
            (f"{h}_low", F.col(h).bitwiseAND(low)), (f"{h}_high", F.floor(F.col(h) / half)))])


def _uneven(left: DataFrame, right: DataFrame, buckets: int) -> dict[int, int]:
    """Rows of both sides in each bucket whose rows are not the same."""
    sides = fingerprints(left, buckets).unionByName(fingerprints(right, buckets))
    facts = [c for c in sides.columns if c != "bucket"]
    seen = sides.groupBy("bucket").agg(F.count(F.lit(1)).alias("_sides"), F.sum("rows").alias("_rows"), *[
        (F.min(c) != F.max(c)).alias(c) for c in facts])
    found = seen.filter((F.col("_sides") == 1) | F.greatest(*[F.col(c).cast("int") for c in facts]).cast("boolean"))
    return {r["bucket"]: r["_rows"] for r in found.select("bucket", "_rows").collect()}


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Buckets whose rows are not the same with the same repeats. The list is
    no longer than ``buckets``."""
    return sorted(_uneven(left, right, buckets))


def differences(left: DataFrame, right: DataFrame, buckets: int = BUCKETS, task_rows: int = TASK_ROWS) -> DataFrame:
    """(left_only, right_only, same) as ``compare_results`` gives them. Only
    buckets with another fingerprint are compared row by row, so equal results
    shuffle no rows; repeats alone make a bucket differ, and comparing it then
    finds nothing. The rows compared are dealt into tasks of about ``task_rows``."""
    uneven = _uneven(left, right, buckets)
    sides = left, right
    if not uneven:
        sides = [df.limit(0) for df in sides]
    elif len(uneven) < buckets:
        sides = [df.filter(_bucket(df, buckets).isin(sorted(uneven))) for df in sides]
    tasks = sum(uneven.values()) // task_rows + 1
    return compare_results(*sides, tasks).select("left_only", "right_only", "same")


def score_attempts(attempts: DataFrame) -> DataFrame:
    """Per model: accuracy, counts of each outcome, questions solved by a
    majority and questions with one outcome in all trials.

    ``attempts`` has (model, question, trial, outcome)."""
    per_question = attempts.groupBy("model", "question").agg(
        F.count(F.lit(1)).alias("trials"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES],
        F.count_distinct("outcome").alias("kinds"),
    )
    totals = per_question.groupBy("model").agg(
        F.sum("trials").alias("total_trials"),
        *[F.sum(o).alias(o) for o in OUTCOMES],
        F.count(F.lit(1)).alias("n_questions"),
        F.count_if(F.col("correct") >= SOLVED_AT).alias("solved_questions"),
        F.count_if(F.col("kinds") == 1).alias("stable_questions"),
    )
    share = F.try_divide(F.col("correct").cast("double"), F.col("total_trials").cast("double"))
    return totals.withColumn("accuracy", F.round(share, 3))
