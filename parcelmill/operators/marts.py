"""Grouped tables: months, segments, markets, postal codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.constants import MARKET_FILTERS
from parcelmill.functions.quantiles import median, summarise


def _rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


# --- filters ahead of every mart and ranking -------------------------------

def filter_market(df: DataFrame, months: Sequence[str] | None = None, **wanted: Sequence[str] | str) -> DataFrame:
    """Rows of the wanted cities, counties, postal codes, subtypes and months.

    ``filter_market(df, City=["A", "B"], months=["1997-04"])``. Apply it
    before a ranking, so that the ranking is within the selection."""
    for column, values in wanted.items():
        if column not in MARKET_FILTERS:
            raise ValueError(f"no market filter on {column}; use one of {', '.join(MARKET_FILTERS)}")
        values = [values] if isinstance(values, str) else list(values)
        df = df.filter(F.col(column).isin(*values))
    if months is not None:
        df = df.filter(F.col("yr_mo").isin(*months))
    return df


def from_month(df: DataFrame, first: str) -> DataFrame:
    return df.filter(F.col("yr_mo") >= first)


# --- monthly marts ---------------------------------------------------------

def monthly_market(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per closing month; sales count rows that have a price."""
    return summarise(
        df, ["yr_mo"],
        [
            F.count("ClosePrice").alias("closed_sales"),
            F.avg("ClosePrice").alias("avg_close_price"),
            F.avg("DaysOnMarket").alias("avg_dom"),
            F.avg("close_to_original_list_ratio").alias("avg_close_to_orig_ratio"),
            F.avg("price_ratio").alias("avg_price_ratio"),
        ],
        [
            median("ClosePrice", "median_close_price"),
            median("price_per_sqft", "median_price_per_sqft"),
            median("DaysOnMarket", "median_dom"),
        ],
        exact,
    ).orderBy("yr_mo")


def monthly_new_listings(df: DataFrame, exact: bool = True) -> DataFrame:
    return summarise(
        df, ["yr_mo"],
        [F.count("ListPrice").alias("new_listings")],
        [median("ListPrice", "median_list_price"), median("list_price_per_sqft", "median_list_per_sqft")],
        exact,
    ).orderBy("yr_mo")


def market_month_kpi(df: DataFrame, market: str | None = None, exact: bool = True) -> DataFrame:
    """Monthly figures per market, for any market column; sales count every
    row. Without ``market`` the whole table is one market named 'all'."""
    rows = df.withColumn("market", F.col(market) if market else F.lit("all"))
    return summarise(
        rows, ["market", "yr_mo"],
        [
            _rows("closed_sales"),
            F.avg("close_to_original_list_ratio").alias("avg_close_to_orig_ratio"),
        ],
        [
            median("ClosePrice", "median_close_price"),
            median("DaysOnMarket", "median_dom"),
            median("price_per_sqft", "median_price_per_sqft"),
        ],
        exact,
    )


def market_month_listings(df: DataFrame, market: str | None = None) -> DataFrame:
    rows = df.withColumn("market", F.col(market) if market else F.lit("all"))
    return summarise(rows, ["market", "yr_mo"], [_rows("new_listings")])


def month_parity(sold_months: DataFrame, listed_months: DataFrame) -> DataFrame:
    """First and last month of both marts, and whether they agree."""
    def ends(df, name):
        return df.agg(F.min("yr_mo").alias(f"{name}_first"), F.max("yr_mo").alias(f"{name}_last"))

    other = ends(listed_months, "listed").first()
    both = ends(sold_months, "sold").select("*", *[F.lit(v).cast("string").alias(n)
                                                   for n, v in other.asDict().items()])
    same = (F.col("sold_first") == F.col("listed_first")) & (F.col("sold_last") == F.col("listed_last"))
    return both.withColumn("same", same)


def supply_demand(sold_kpi: DataFrame, new_listings: DataFrame) -> DataFrame:
    """The month list of the sales side with the new listings of each month;
    a month without listings has null."""
    return sold_kpi.join(new_listings, "yr_mo", "left")


def price_and_sqft_by_month(df: DataFrame) -> DataFrame:
    return summarise(
        df, ["yr_mo"], (),
        [median("ClosePrice", "median_close_price"), median("price_per_sqft", "median_price_per_sqft")],
    )


def market_trends(sold: DataFrame, listed: DataFrame, first: str, **wanted) -> DataFrame:
    """The five monthly trends of a selection, from row level: median price,
    mean days, mean ratio, new listings and closed sales."""
    sales = summarise(
        from_month(filter_market(sold, **wanted), first), ["yr_mo"],
        [
            F.avg("DaysOnMarket").alias("avg_dom"),
            F.avg("close_to_original_list_ratio").alias("avg_close_to_orig_ratio"),
            _rows("closed_sales"),
        ],
        [median("ClosePrice", "median_close_price")],
    )
    fresh = summarise(
        from_month(filter_market(listed, **wanted), first), ["yr_mo"], [_rows("new_listings")]
    )
    return sales.join(fresh, "yr_mo", "full")


# --- segments --------------------------------------------------------------

def sold_segments(df: DataFrame, by: str) -> DataFrame:
    rows = df.withColumn("segment", F.col(by))
    return summarise(
        rows, ["segment"],
        [F.count("ClosePrice").alias("transaction_count")],
        [
            median("ClosePrice", "median_close_price"),
            median("price_per_sqft", "median_price_per_sqft"),
            median("price_ratio", "median_price_ratio"),
            median("DaysOnMarket", "median_dom"),
            median("listing_to_contract_days", "median_listing_to_contract"),
            median("contract_to_close_days", "median_contract_to_close"),
        ],
    )


def listed_segments(df: DataFrame, by: str) -> DataFrame:
    rows = df.withColumn("segment", F.col(by))
    return summarise(
        rows, ["segment"],
        [F.count("ListPrice").alias("listing_count")],
        [
            median("ListPrice", "median_list_price"),
            median("list_price_per_sqft", "median_list_price_per_sqft"),
            median("price_reduction_ratio", "median_price_reduction"),
            median("DaysOnMarket", "median_dom"),
            median("listing_to_contract_days", "median_listing_to_contract"),
        ],
    )


def stacked(df: DataFrame, keys: Sequence[str], report) -> DataFrame:
    """``report(df, key)`` for several keys in one pass: the rows are listed
    once per key under (dimension, segment) before they are grouped."""
    pairs = F.array(*[
        F.struct(F.lit(k).alias("dimension"), F.col(k).cast("string").alias("segment")) for k in keys
    ])
    return report(df.select("*", F.inline(pairs)))


def sold_segments_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``sold_segments`` for several keys at once."""
    return _segments_by(df, keys, sold_segments)


def listed_segments_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _segments_by(df, keys, listed_segments)


def _segments_by(df, keys, report):
    def one(rows):
        tagged = rows.filter(F.col("segment").isNotNull()).withColumn(
            "_tag", F.struct("dimension", "segment")
        )
        out = report(tagged.drop("segment"), "_tag")
        return out.select(
            F.col("segment.dimension").alias("dimension"), F.col("segment.segment").alias("segment"),
            *[c for c in out.columns if c != "segment"],
        )

    return stacked(df, keys, one)


# --- geography and parties -------------------------------------------------

def zip_layers(df: DataFrame, months: Sequence[str] | None = None, **wanted) -> DataFrame:
    """Median price and units of every postal code."""
    return summarise(
        filter_market(df, months=months, **wanted), ["PostalCode"],
        [_rows("units")], [median("ClosePrice", "median_close_price")],
    )


def mean_by(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    return summarise(df, [key], [F.avg(value).alias(alias), _rows("units")])


def list_price_comparison(df: DataFrame) -> DataFrame:
    """Sales above, below and at list price, with shares of the rows that have
    both prices; and the rows listed after they closed."""
    close, asked = F.col("ClosePrice"), F.col("ListPrice")
    row = df.agg(
        F.count_if(close > asked).alias("above"), F.count_if(close < asked).alias("below"),
        F.count_if(close == asked).alias("level"),
        F.count_if(F.col("ListingContractDate") > F.col("CloseDate")).alias("date_issues"),
    )
    total = F.col("above") + F.col("below") + F.col("level")
    return row.withColumns({
        f"{c}_pct": F.try_divide(F.col(c), total) * 100 for c in ("above", "below", "level")
    })
