"""Casts, column removal and rule flags of the cleaning step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.constants import (
    DATE_COLUMNS, DATE_FLAGS, GEO_FLAGS, HOME_TYPE, LATITUDE_RANGE, LONGITUDE_RANGE,
    NUMBER_COLUMNS, SPARSE_PERCENT, VALUE_FLAGS,
)
from parcelmill.functions.quantiles import median, summarise
from parcelmill.functions.scalar import flag, lenient_date, lenient_double, yes_no_flag
from parcelmill.operators.profile import missing_profile, rows_from_one


def homes_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("PropertyType") == HOME_TYPE)


# --- casts -----------------------------------------------------------------

def cast_dates(df: DataFrame, columns: Sequence[str] = tuple(DATE_COLUMNS)) -> DataFrame:
    return df.withColumns({c: lenient_date(c) for c in columns if c in df.columns})


def cast_numbers(df: DataFrame, columns: Sequence[str] = tuple(NUMBER_COLUMNS)) -> DataFrame:
    return df.withColumns({c: lenient_double(c) for c in columns if c in df.columns})


def _cast_report(df: DataFrame, columns: Sequence[str], cast) -> DataFrame:
    columns = [c for c in columns if c in df.columns]
    row = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}|before") for c in columns],
        *[F.count_if(cast(c).isNull()).alias(f"{c}|after") for c in columns],
    )
    report = rows_from_one(row, columns, {"nulls_before": "{}|before", "nulls": "{}|after"})
    return report.select("field", "nulls", (F.col("nulls") - F.col("nulls_before")).alias("coerced"))


def date_cast_report(df: DataFrame, columns: Sequence[str] = tuple(DATE_COLUMNS)) -> DataFrame:
    """(field, nulls, coerced): nulls after the cast, and how many of them the
    cast made."""
    return _cast_report(df, columns, lenient_date)


def number_cast_report(df: DataFrame, columns: Sequence[str] = tuple(NUMBER_COLUMNS)) -> DataFrame:
    """(field, type_before, type_after, nulls, coerced)."""
    before, after = dict(df.dtypes), dict(cast_numbers(df, columns).dtypes)
    present = [c for c in columns if c in before]

    def type_of(types: dict[str, str]) -> Column:
        pairs = [F.lit(x) for c in present for x in (c, types[c])]
        return F.element_at(F.create_map(*pairs), F.col("field"))

    return _cast_report(df, columns, lenient_double).select(
        "field", type_of(before).alias("type_before"), type_of(after).alias("type_after"),
        "nulls", "coerced",
    )


def sparse_columns(df: DataFrame, percent: float = SPARSE_PERCENT) -> list[str]:
    """Columns whose missing share is above ``percent`` (strict)."""
    gaps = missing_profile(df).filter(
        F.try_divide(F.col("missing"), F.col("rows")) * 100 > percent
    )
    # At most one short row per column of the table.
    wanted = {r["field"] for r in gaps.select("field").collect()}
    return [c for c in df.columns if c in wanted]


def drop_sparse(df: DataFrame, percent: float = SPARSE_PERCENT) -> DataFrame:
    """Without the sparse columns. Run it after ``cast_dates`` and before
    ``cast_numbers``: nulls from date coercion count, from numbers do not."""
    return df.drop(*sparse_columns(df, percent))


def fill_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls of each column by its exact median."""
    columns = [c for c in columns if c in df.columns]
    numbers = cast_numbers(df, columns)
    middle = summarise(numbers, (), (), [median(c, c) for c in columns]).first()
    return numbers.withColumns({
        c: F.coalesce(F.col(c), F.lit(middle[c]).cast("double")) for c in columns
    })


def coerce_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({c: yes_no_flag(c, types[c]) for c in columns if c in types})


# --- rule flags ------------------------------------------------------------

def add_value_flags(df: DataFrame, price: str = "ClosePrice") -> DataFrame:
    """``price`` is ClosePrice for sales and ListPrice for listings."""
    rules = [
        F.col(price) <= 0, F.col("LivingArea") <= 0, F.col("DaysOnMarket") < 0,
        F.col("BedroomsTotal") < 0, F.col("BathroomsTotalInteger") < 0,
    ]
    return df.withColumns({name: flag(rule) for name, rule in zip(VALUE_FLAGS, rules)})


def add_date_flags(df: DataFrame) -> DataFrame:
    listing_late = F.col("ListingContractDate") > F.col("CloseDate")
    contract_late = F.col("PurchaseContractDate") > F.col("CloseDate")
    first, second = flag(listing_late), flag(contract_late)
    return df.withColumns(dict(zip(DATE_FLAGS, [first, second, F.greatest(first, second)])))


def add_geo_flags(
    df: DataFrame,
    latitude_range: tuple[float, float] = LATITUDE_RANGE,
    longitude_range: tuple[float, float] = LONGITUDE_RANGE,
) -> DataFrame:
    lat, lon = F.col("Latitude"), F.col("Longitude")
    missing = lat.isNull() | lon.isNull()
    zero = (lat == 0) | (lon == 0)
    outside = ~(lat.between(*latitude_range) & lon.between(*longitude_range))
    rules = [missing, ~missing & zero, lon > 0, ~missing & ~zero & outside]
    return df.withColumns({name: flag(rule) for name, rule in zip(GEO_FLAGS, rules)})


def add_rule_flags(df: DataFrame, price: str = "ClosePrice") -> DataFrame:
    return add_geo_flags(add_date_flags(add_value_flags(df, price)))


def flag_summary(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(flag, hits, pct) of the flag columns that exist, from one aggregate."""
    flags = [f for f in flags if f in df.columns]
    row = df.agg(*[F.sum(f).alias(f) for f in flags], F.count(F.lit(1)).alias("_rows"))
    hits = row.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("flag"), F.coalesce(F.col(f), F.lit(0)).alias("hits"),
                 F.col("_rows").alias("rows"))
        for f in flags
    ])))
    return hits.select(
        "flag", "hits", (F.try_divide(F.col("hits"), F.col("rows")) * 100).alias("pct")
    )


def geo_issue_share(df: DataFrame) -> DataFrame:
    """(rows, geo_issues, pct): rows with any of the coordinate flags."""
    any_issue = F.greatest(*GEO_FLAGS) == 1
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(any_issue).alias("geo_issues")
    ).withColumn("pct", F.try_divide(F.col("geo_issues"), F.col("rows")) * 100)


def cleaning_summary(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """(item, value): rows and columns before and after, then the hits of each
    rule flag and of any coordinate flag."""
    flags = [f for f in VALUE_FLAGS + DATE_FLAGS + GEO_FLAGS if f in cleaned.columns]
    row = cleaned.agg(
        F.count(F.lit(1)).alias("rows_after"),
        *[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in flags],
        F.count_if(F.greatest(*GEO_FLAGS) == 1).alias("any_geo_issue"),
    )
    rows_before = raw.agg(F.count(F.lit(1))).scalar()
    items = [
        ("rows_before", rows_before),
        ("rows_after", F.col("rows_after")),
        ("columns_before", F.lit(len(raw.columns)).cast("long")),
        ("columns_after", F.lit(len(cleaned.columns)).cast("long")),
        *[(f, F.col(f)) for f in flags],
        ("any_geo_issue", F.col("any_geo_issue")),
    ]
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("item"), value.cast("long").alias("value"))
        for name, value in items
    ])))
