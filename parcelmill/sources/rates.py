"""The rate series: weekly points, monthly means, join by month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.functions.scalar import lenient_date, lenient_double, month_text
from parcelmill.sources.files import CSV_OPTIONS

RATE = "rate_30yr_fixed"


def tidy_rates(df: DataFrame) -> DataFrame:
    """(date, value) from the first two columns; a '.' marks a missing value
    and its row is dropped."""
    day, value = df.columns[:2]
    return df.select(
        lenient_date(day).alias("date"), lenient_double(value).alias("value")
    ).dropna(subset=["date", "value"])


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    return tidy_rates(spark.read.options(header="true", **CSV_OPTIONS).csv(path))


def first_source(spark: SparkSession, paths: Sequence[str]) -> tuple[str, DataFrame] | None:
    """(path, rates) of the first path that exists, has the columns and has
    rows; else None. Only a missing path or a table of another form leads on to
    the next one; a failing cluster raises."""
    for path in paths:
        try:
            rates = read_rates(spark, path)
        except (AnalysisException, ValueError):  # no such path; fewer than two columns
            continue
        if rates.take(1):
            return path, rates
    return None


def first_readable(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """Rates from the first usable path, see ``first_source``."""
    found = first_source(spark, paths)
    return found[1] if found else None


def monthly_rates(rates: DataFrame, name: str = RATE) -> DataFrame:
    """(yr_mo, rate): the mean of the points of each month."""
    return rates.groupBy(month_text("date").alias("yr_mo")).agg(F.avg("value").alias(name))


def enrich(df: DataFrame, day: str, rates: DataFrame | None, name: str = RATE) -> DataFrame:
    """``df`` with the mean rate of the month of ``day``; null where there is
    none. The rate side has one row per month, so no row of ``df`` is repeated,
    and it is small however long the series: the calendar from year 1 to 9999
    has 119,988 months."""
    if rates is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    monthly = monthly_rates(rates, name).withColumnRenamed("yr_mo", "_rate_month")
    return df.join(
        F.broadcast(monthly), month_text(day) == F.col("_rate_month"), "left"
    ).drop("_rate_month")


def enrich_report(df: DataFrame, enriched: DataFrame, name: str = RATE) -> DataFrame:
    """(rows_before, rows_after, unmatched, min_rate, max_rate)."""
    before = df.agg(F.count(F.lit(1))).scalar()
    return enriched.agg(
        F.count(F.lit(1)).alias("rows_after"), F.count_if(F.col(name).isNull()).alias("unmatched"),
        F.min(name).alias("min_rate"), F.max(name).alias("max_rate"),
    ).select(before.alias("rows_before"), "*")


def mean_rate_by_month(enriched: DataFrame, name: str = RATE) -> DataFrame:
    return enriched.filter(F.col("yr_mo").isNotNull()).groupBy("yr_mo").agg(F.avg(name).alias(name))
