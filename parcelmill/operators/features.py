"""Price, calendar and timeline columns of the two feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.constants import LISTED_EXTRACT, RATIO_BAND, SOLD_EXTRACT
from parcelmill.functions.quantiles import Quantile, median, summarise
from parcelmill.functions.scalar import day_span, month_text, ratio, within
from parcelmill.operators.profile import rows_from_one

_SPANS = {
    "listing_to_contract_days": ("ListingContractDate", "PurchaseContractDate"),
    "contract_to_close_days": ("PurchaseContractDate", "CloseDate"),
}


def _with_calendar(df: DataFrame, day: str, prefix: str) -> DataFrame:
    spans = {name: day_span(*ends) for name, ends in _SPANS.items()}
    return df.withColumns({
        f"{prefix}_year": F.year(day), f"{prefix}_month": F.month(day), "yr_mo": month_text(day),
        **spans,
    })


def sold_features(df: DataFrame) -> DataFrame:
    priced = df.withColumns({
        "price_ratio": ratio("ClosePrice", "ListPrice"),
        "close_to_original_list_ratio": ratio("ClosePrice", "OriginalListPrice"),
        "price_per_sqft": ratio("ClosePrice", "LivingArea"),
    })
    return _with_calendar(priced, "CloseDate", "close")


def listed_features(df: DataFrame) -> DataFrame:
    priced = df.withColumns({
        "list_price_per_sqft": ratio("ListPrice", "LivingArea"),
        "price_reduction_ratio": ratio("ListPrice", "OriginalListPrice"),
        "close_to_list_ratio": ratio("ClosePrice", "ListPrice"),
    })
    return _with_calendar(priced, "ListingContractDate", "list")


def guard_ratio(df: DataFrame, column: str = "close_to_original_list_ratio",
                band: tuple[float, float] = RATIO_BAND) -> DataFrame:
    """Null the ratio where it is outside the closed band."""
    return df.withColumn(column, within(column, *band))


def guard_report(df: DataFrame, column: str = "close_to_original_list_ratio",
                 band: tuple[float, float] = RATIO_BAND) -> DataFrame:
    """(rows, present, nulled): only rows that had a value count as nulled."""
    inside = F.col(column).between(*band)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count(column).alias("present"),
        F.count_if(~inside).alias("nulled"),
    )


def ratio_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, count, mean, median, above_one, below_one, below_pct); the
    share is of all rows."""
    measures = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        measures += [
            F.count(c).alias(f"{c}|count"), F.avg(c).alias(f"{c}|mean"),
            F.count_if(F.col(c) > 1).alias(f"{c}|above"),
            F.count_if(F.col(c) < 1).alias(f"{c}|below"),
        ]
    row = summarise(df, (), measures, [median(c, f"{c}|median") for c in columns])
    row = row.withColumns({
        f"{c}|pct": F.try_divide(F.col(f"{c}|below"), F.col("_rows")) * 100 for c in columns
    })
    return rows_from_one(row, columns, {
        "count": "{}|count", "mean": "{}|mean", "median": "{}|median",
        "above_one": "{}|above", "below_one": "{}|below", "below_pct": "{}|pct",
    })


def timeline_summary(df: DataFrame) -> DataFrame:
    """(field, count, mean, median, p25, p75) of the two day spans."""
    measures, quantiles = [], []
    for c in _SPANS:
        measures += [F.count(c).alias(f"{c}|count"), F.avg(c).alias(f"{c}|mean")]
        quantiles += [
            median(c, f"{c}|median"), Quantile(c, 0.25, f"{c}|p25"), Quantile(c, 0.75, f"{c}|p75"),
        ]
    row = summarise(df, (), measures, quantiles)
    return rows_from_one(
        row, list(_SPANS), {n: "{}|" + n for n in ["count", "mean", "median", "p25", "p75"]}
    )


def calendar_coverage(df: DataFrame, year: str, month: str) -> DataFrame:
    """Years seen, first and last month number, first and last month key and
    the number of months."""
    months = df.filter(F.col("yr_mo").isNotNull()).groupBy("yr_mo", year, month).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return months.agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_set(year)), lambda y: y.cast("string")))
        .alias("years"),
        F.min(month).alias("min_month"), F.max(month).alias("max_month"),
        F.min("yr_mo").alias("first_month"), F.max("yr_mo").alias("last_month"),
        F.count(F.lit(1)).alias("n_months"),
    )


def lean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def sold_extract(df: DataFrame) -> DataFrame:
    return lean(guard_ratio(df), SOLD_EXTRACT)


def listed_extract(df: DataFrame) -> DataFrame:
    return lean(df, LISTED_EXTRACT)


def preview(df: DataFrame, columns: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """First n rows by ``order``, then by all shown columns."""
    shown = [c for c in columns if c in df.columns]
    return df.orderBy(*order, *shown).select(*shown).limit(n)
