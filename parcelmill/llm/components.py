"""Connected components of a graph of any size, with DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.llm.common import stage


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component``, the smallest node it is joined with, for each
    node of ``edges`` (``a``, ``b``).

    Alternates the large and the small star: every node tells its neighbours the
    smallest node it knows, until the graph is a set of stars. Minima combine
    before each shuffle and a node with very many neighbours is a skewed join,
    not a group in one task. Each round is written to the shared folder, so
    lineage stays short. Rounds grow with the logarithm of the longest chain.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    print_before = _print(now)
    for _ in range(most_rounds):
        now = stage(_small_star(_large_star(now)), "edges")
        print_after = _print(now)
        if print_after == print_before:
            both = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return both.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        print_before = print_after
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _print(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(h, F.lit(1 << 31))), F.sum(F.pmod(F.shiftright(h, 20), F.lit(1 << 31)))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    told = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return told.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    told = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return told.unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()
