"""Top lists and market selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.constants import TOP_MARKETS, TOP_PARTIES, TOP_PARTIES_PER_MARKET
from parcelmill.functions.quantiles import median, summarise
from parcelmill.functions.scalar import exact_sum


def top_groups_by_median(df: DataFrame, key: str, value: str, n: int = 10) -> DataFrame:
    """The n groups with the highest median; the count includes null values."""
    groups = summarise(df, [key], [F.count(F.lit(1)).alias("rows")], [median(value, "median_value")])
    return groups.orderBy(F.col("median_value").desc_nulls_last(), key).limit(n)


def top_by_volume_then_median(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The n largest groups, listed from low to high median."""
    groups = summarise(df, [key], [F.count(value).alias("rows")], [median(value, "median_value")])
    return groups.orderBy(F.col("rows").desc(), key).limit(n).orderBy("median_value", key)


def top_markets(kpi: DataFrame, n: int = TOP_MARKETS, market: str = "market") -> DataFrame:
    """The n markets with the most sales over all months."""
    totals = kpi.groupBy(market).agg(F.sum("closed_sales").alias("closed_sales"))
    return totals.orderBy(F.col("closed_sales").desc(), market).limit(n)


def rows_of_markets(df: DataFrame, markets: DataFrame, market: str = "market") -> DataFrame:
    return df.join(markets.select(market), market, "left_semi")


def top_parties(df: DataFrame, party: str, n: int = TOP_PARTIES) -> DataFrame:
    """(name, volume, units) of the n parties with the most sales value."""
    return _volumes(df, [], party).orderBy(F.col("volume").desc_nulls_last(), "name").limit(n)


def top_parties_per_market(df: DataFrame, market: str, party: str,
                           n: int = TOP_PARTIES_PER_MARKET) -> DataFrame:
    """The n parties of every market. Spark keeps n rows per task before the
    shuffle, because the rank is filtered by a constant."""
    best = Window.partitionBy(market).orderBy(F.col("volume").desc_nulls_last(), "name")
    ranked = _volumes(df, [market], party).withColumn("place", F.row_number().over(best))
    return ranked.filter(F.col("place") <= n)


def _volumes(df: DataFrame, keys: Sequence[str], party: str) -> DataFrame:
    return summarise(
        df.withColumn("name", F.col(party)), [*keys, "name"],
        [exact_sum("ClosePrice").alias("volume"), F.count(F.lit(1)).alias("units")],
    )


def growth_leaders(df: DataFrame, key: str, before: str, after: str, n: int = 5) -> DataFrame:
    """The n groups with the largest rise in rows between two months."""
    rows = df.filter(F.col("yr_mo").isin(before, after))
    change = F.count_if(F.col("yr_mo") == after) - F.count_if(F.col("yr_mo") == before)
    groups = summarise(rows, [key], [change.alias("change")])
    return groups.orderBy(F.col("change").desc(), key).limit(n)


def distinct_markets(df: DataFrame, market: str) -> DataFrame:
    return df.filter(F.col(market).isNotNull()).select(market).distinct()


def select_market(df: DataFrame, market: str, value: str) -> DataFrame:
    """Rows of one market; an unknown name is an error that lists known ones."""
    chosen = df.filter(F.col(market) == value)
    if not chosen.limit(1).take(1):
        known = [r[0] for r in distinct_markets(df, market).orderBy(market).take(20)]
        raise ValueError(f"no rows with {market} = {value!r}; known are: {', '.join(known)}")
    return chosen
