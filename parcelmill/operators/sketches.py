"""Quantiles of any span of months from stored sketches.

Rows are read once: ``month_sketches`` keeps one KLL sketch per group, month
and value, whose size depends on ``k`` and not on the rows behind it. Months
are merged to any span afterwards without reading a row again, and a new month
only adds its own sketches. A result's rank is off by at most ``rank_error(k)``
of the rows, 99 times in 100; a span of no more than ``k`` rows is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 2000


def rank_error(k: int = K) -> float:
    """Share of the rows by which a rank may be off, at 99 % confidence."""
    return 2.296 / k**0.9723


def month_sketches(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                   month: str = "yr_mo", k: int = K) -> DataFrame:
    """(keys, month, rows, one sketch per value). Null and NaN values are left
    out; rows without a month belong to no span and are left out too.

    The sketches combine before the shuffle, so a group with a third of all
    rows is one sketch per task there."""
    def known(c: str):
        number = F.col(c).cast("double")
        return F.when(~F.isnan(number), number)

    return df.filter(F.col(month).isNotNull()).groupBy(*keys, month).agg(
        F.count(F.lit(1)).alias("rows"), *[F.kll_sketch_agg_double(known(c), k).alias(c) for c in values])


def span_quantiles(sketches: DataFrame, keys: Sequence[str], wanted: dict[str, tuple[str, float]],
                   first: str | None = None, last: str | None = None, month: str = "yr_mo") -> DataFrame:
    """(keys, rows, one column per entry of ``wanted``: name -> (value, share))
    of the months from ``first`` to ``last``; null where no value is known."""
    if first is not None:
        sketches = sketches.filter(F.col(month) >= first)
    if last is not None:
        sketches = sketches.filter(F.col(month) <= last)
    values = list(dict.fromkeys(value for value, _ in wanted.values()))
    merged = sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), *[F.kll_merge_agg_double(c).alias(f"_{c}") for c in values])

    def quantile(c: str, share: float):
        sketch = F.col(f"_{c}")
        return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))

    return merged.select(*keys, "rows", *[quantile(c, share).alias(name) for name, (c, share) in wanted.items()])
